import random

import pytest

from cellscope.operators.joins import asof_join


def brute(rows, versions):
    out = []
    for k, t, i in rows:
        at = [(f, v) for c, f, v in versions if c == k and k is not None and f is not None and t is not None and f <= t]
        out.append((k, t, i, max(at, key=lambda x: (x[0], x[1] or ""))[1] if at else None))
    return sorted(out, key=str)


def run(spark, rows, versions, parts):
    left = spark.createDataFrame(rows, "cell string, t long, id long")
    right = spark.createDataFrame(versions, "cell string, valid_from long, region string")
    got = asof_join(left, right, ["cell"], "t", ["region"], num_partitions=parts)
    return sorted(map(tuple, got.select("cell", "t", "id", "region").collect()), key=str)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_equals_brute_force_with_a_hot_cell(spark, parts):
    rng = random.Random(parts)
    cell = lambda: rng.choice(["hot", "hot", *"abcdefgh"])
    rows = [(cell(), rng.randrange(300), i) for i in range(700)]
    versions = [(cell(), rng.randrange(300), f"r{i}") for i in range(60)]
    assert run(spark, rows, versions, parts) == brute(rows, versions)


def test_edges(spark):
    rows = [("a", 5, 1), ("a", 4, 2), (None, 5, 3), ("a", None, 4), ("z", 9, 5), ("a", 5, 1)]
    versions = [("a", 5, "x"), ("a", 5, "y"), (None, 1, "n"), ("a", None, "m"), ("z", 10, "late"), ("a", 1, None)]
    assert run(spark, rows, versions, 3) == brute(rows, versions)
    assert run(spark, rows, [], 3) == brute(rows, [])
    assert run(spark, [], versions, 3) == []


def test_one_exchange_and_no_window(spark):
    left = spark.createDataFrame([("a", 5)], "cell string, t long")
    right = spark.createDataFrame([("a", 1, "x")], "cell string, valid_from long, region string")
    plan = asof_join(left, right, ["cell"], "t", ["region"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan      # after the range exchange, which is written

import random

import pytest

from cellscope.functions import bitmap, containers
from cellscope.functions.containers import ARRAY, BITMAP, RUNS

B = 32768


def sets(seed=0):
    """Sets of every kind, over bucket edges: few ids, runs, many scattered ids, all, every second."""
    rng = random.Random(seed)
    out = {
        "one": [0], "edge": [B - 1, B, 2 * B - 1, 2 * B], "few": rng.sample(range(3 * B), 50),
        "runs": [*range(100, 9000), *range(20_000, 20_003), *range(B - 5, B + 700)],
        "many": rng.sample(range(B), 9000), "all": range(B), "second": range(0, B, 2),
        "mixed": [*range(B, B + 4000), *rng.sample(range(3 * B, 4 * B), 6000), 7],
    }
    return {k: sorted(set(v)) for k, v in out.items()}


@pytest.fixture(scope="module")
def built(spark):
    rows = [(k, i) for k, ids in sets().items() for i in ids] + [("few", sets()["few"][0]), ("null", None)]
    df = spark.createDataFrame(rows, "k string, bitmap_id long").repartition(3)
    return containers.build(df, ["k"]).cache()


def decoded(df, keys=("k",)):
    out = {}
    for r in containers.decode(df, list(keys)).collect():
        out.setdefault(r[0], []).append(r[1])
    return {k: sorted(v) for k, v in out.items()}


def test_decode_gives_the_ids_back(built):
    assert decoded(built) == sets()


def test_kind_is_the_smallest(built):
    rows = {(r.k, r.bucket): r for r in built.withColumn("bytes", containers.stored_bytes(built)).collect()}
    for (k, bucket), r in rows.items():
        if bucket is None:
            assert (k, r.n, r.kind, list(r.vals)) == ("null", 0, ARRAY, [])
            continue
        at = [i % B for i in sets()[k] if i // B + 1 == bucket]
        n_runs = sum(p == 0 or at[p] != at[p - 1] + 1 for p in range(len(at)))
        assert r.n == len(at) and r.bytes == min(2 * len(at), 4 * n_runs, B // 8)
    assert {r.kind for r in rows.values()} == {ARRAY, RUNS, BITMAP}


def test_dense_build_and_bitmaps_give_the_same_containers(spark, built):
    rows = [(k, i) for k, ids in sets().items() for i in ids] + [("null", None)]
    df = spark.createDataFrame(rows, "k string, bitmap_id long")
    dense = containers.build(df, ["k"], sparse=False)
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(dense.collect()) == order(built.collect())
    assert order(containers.from_bitmaps(bitmap.build(df, ["k"]), ["k"]).collect()) == order(built.collect())


def test_every_two_kinds_intersect(built):
    """All pairs of sets, so all pairs of kinds, on both sides."""
    left = built.withColumnRenamed("k", "x").where("bucket IS NOT NULL")
    right = built.withColumnRenamed("k", "y").where("bucket IS NOT NULL")
    both = containers.prefixed(left, "_l").join(containers.prefixed(right, "_r"), "bucket")
    got = {}
    for r in both.select("x", "y", "bucket", containers.common("_l", "_r").alias("p")).collect():
        assert list(r.p) == sorted(r.p)
        got.setdefault((r.x, r.y), set()).update((r.bucket - 1) * B + p for p in r.p)
    for a, x in sets().items():
        for b, y in sets().items():
            assert got.get((a, b), set()) == set(x) & set(y)


def test_intersect_of_repeated_rows(built):
    one = built.where("k IN ('runs', 'many')").drop("k")
    two = built.where("k = 'second'").drop("k")
    got = containers.decode(containers.intersect(one.unionByName(one), two.unionByName(two)), [])
    s = sets()
    assert sorted(r.bitmap_id for r in got.collect()) == sorted((set(s["runs"]) | set(s["many"])) & set(s["second"]))


@pytest.mark.parametrize("names", [("few", "runs"), ("few", "many"), ("all", "second"), ("runs", "many", "mixed"), ("one",)])
def test_merge_of_kinds(built, names):
    from pyspark.sql import functions as F

    rows = built.where(F.col("k").isin(*names)).withColumn("k", F.lit("u"))
    merged = containers.merge(rows.unionByName(rows), ["k"])
    want = sorted(set().union(*[sets()[n] for n in names]))
    assert decoded(merged) == {"u": want}
    assert [r.user_count for r in containers.cardinality(merged, ["k"]).collect()] == [len(want)]


def test_null_and_empty(spark, built):
    nulls = containers.merge(built.where("k = 'null'"), ["k"])
    assert [(r.k, r.bucket, r.n) for r in nulls.collect()] == [("null", None, 0)]
    empty = containers.build(spark.createDataFrame([], "k string, bitmap_id long"), ["k"])
    assert empty.collect() == [] and containers.decode(empty, ["k"]).collect() == []
    assert containers.intersect(empty, empty).collect() == []
    with pytest.raises(Exception, match=">= 0"):
        containers.build(spark.createDataFrame([("a", -1)], "k string, bitmap_id long"), ["k"]).collect()


def test_no_python_in_any_operation(built):
    for df in (containers.decode(built, ["k"]), containers.merge(built, ["k"]), containers.intersect(built, built)):
        assert "Python" not in df._jdf.queryExecution().toString()

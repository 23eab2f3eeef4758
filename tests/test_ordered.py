import random

from pyspark.sql import Window
from pyspark.sql import functions as F

import pytest

from cellscope.operators.ordered import (lag_columns, lag_tagged, range_tagged, running_sums, running_tagged,
                                         unique_row_ids, with_row_index)


def _skewed(spark, n=600):
    # One key holds a third of the rows.
    rnd = random.Random(7)
    rows = [("hot" if i % 3 == 0 else f"k{rnd.randint(0, 40)}", i, rnd.choice("ABC"))
            for i in range(n)]
    return spark.createDataFrame(rows, "k string, t long, v string")


def test_row_index_equals_row_number(spark):
    df = _skewed(spark)
    got = with_row_index(df, ["k", "t"], "rid", num_partitions=5)
    want = df.withColumn("rid", F.row_number().over(Window.orderBy("k", "t")) - 1)
    assert sorted(got.select("k", "t", "rid").collect()) == \
        sorted(want.select("k", "t", "rid").collect())


@pytest.mark.parametrize("parts", [1, 6, 40])
def test_lag_equals_window_lag(spark, parts):
    df = _skewed(spark)
    got = lag_columns(df, ["k"], ["t"], ["v"], num_partitions=parts)
    want = df.withColumn("prev_v", F.lag("v").over(Window.partitionBy("k").orderBy("t")))
    assert sorted(got.select("k", "t", "prev_v").collect()) == \
        sorted(want.select("k", "t", "prev_v").collect())


def test_lag_over_a_subset_of_the_slices(spark):
    """A hot key's partitions without a row of the subset are passed over."""
    df = _skewed(spark)
    tagged = range_tagged(df, ["k", "t"], 12)
    keep = (F.col("t") < 60) | (F.col("t") > 540)
    got = lag_tagged(tagged.where(keep), ["k"], ["t"])
    want = df.where(keep).withColumn("prev_t", F.lag("t").over(Window.partitionBy("k").orderBy("t")))
    assert sorted((r.k, r.t, r.prev_t or -1) for r in got.collect()) == \
        sorted((r.k, r.t, r.prev_t or -1) for r in want.collect())


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_running_sums_equal_window_sum(spark, parts):
    df = _skewed(spark).withColumn("x", F.when(F.col("v") == "A", 1).otherwise(0))
    got = running_sums(df, ["k"], ["t"], {"run": F.col("x")}, num_partitions=parts)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("run", F.sum("x").over(w).cast("long"))
    assert sorted(got.select("k", "t", "run").collect()) == \
        sorted(want.select("k", "t", "run").collect())


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_running_xors_and_wrapping_sums(spark, parts):
    df = _skewed(spark).withColumn("x", F.xxhash64("t"))
    tagged = range_tagged(df, ["k", "t"], parts)
    got = running_tagged(tagged, ["k"], {"s": "x"}, {"r": "x"}).select("k", "t", "x", "s", "r").collect()
    s, r = {}, {}
    for row in sorted(got):
        s[row.k] = (s.get(row.k, 0) + row.x + 2**63) % 2**64 - 2**63
        r[row.k] = r.get(row.k, 0) ^ row.x
        assert (row.s, row.r) == (s[row.k], r[row.k])


def test_flows_exchange_rows_once_after_their_order(spark):
    tagged = range_tagged(_skewed(spark), ["k", "t"], 6)
    once = lag_tagged(tagged, ["k"], ["v"])
    twice = lag_tagged(once.where("prev_v <> v"), ["k"], ["t"], "left_")
    plan = twice._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and plan.count("Scan ExistingRDD") == 1


def test_a_hot_null_key_is_no_special_case(spark):
    df = spark.createDataFrame([(None if i % 2 else "a", i) for i in range(60)], "k string, t long")
    got = lag_columns(df, ["k"], ["t"], ["t"], num_partitions=5)
    assert sorted((str(r.k), r.t, r.prev_t) for r in got.collect() if r.prev_t is not None) == \
        sorted((str(None if i % 2 else "a"), i, i - 2) for i in range(2, 60))


def test_hot_key_spreads_over_partitions(spark):
    tagged = range_tagged(_skewed(spark), ["k", "t"], 6)
    parts = {r._part for r in tagged.where(F.col("k") == "hot").select("_part").distinct()
             .collect()}
    assert len(parts) >= 2


def test_unique_row_ids_formula(spark):
    df = spark.range(0, 10, numPartitions=3).select(F.col("id").cast("string").alias("s"))
    ids = {r.s: r.row_id for r in unique_row_ids(df).collect()}
    assert len(set(ids.values())) == 10
    # k-th row of partition i of n gets k*n+i, exactly like RDD.zipWithUniqueId.
    want = {row.s: i for row, i in df.rdd.zipWithUniqueId().collect()}
    assert ids == want


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None)
@given(keys=st.lists(st.sampled_from(["a", "b", "hot", "hot", "hot", "z"]), min_size=1,
                     max_size=80),
       parts=st.integers(1, 7))
def test_range_paths_match_windows_property(spark, keys, parts):
    rows = [(k, i, i % 3) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k string, t long, x int")
    w = Window.partitionBy("k").orderBy("t")
    want = {(r.k, r.t): (r.p, r.s) for r in df.select(
        "k", "t", F.lag("x").over(w).alias("p"),
        F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long").alias("s"))
        .collect()}
    lag = {(r.k, r.t): r.prev_x for r in
           lag_columns(df, ["k"], ["t"], ["x"], num_partitions=parts).collect()}
    run = {(r.k, r.t): r.s for r in
           running_sums(df, ["k"], ["t"], {"s": F.col("x")}, num_partitions=parts).collect()}
    assert lag == {k: v[0] for k, v in want.items()}
    assert run == {k: v[1] for k, v in want.items()}

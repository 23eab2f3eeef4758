import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cellscope.functions import bitmap

EDGE_IDS = [0, 1, 32767, 32768, 32769, 65535, 65536, 65537, 100000]
ids_strategy = st.lists(st.one_of(st.sampled_from(EDGE_IDS), st.integers(0, 140000)),
                        max_size=60)


def _df(spark, rows):
    return spark.createDataFrame(rows, "k string, bitmap_id long")


def _sets(rows):
    out = {}
    for k, i in rows:
        out.setdefault(k, set())
        if i is not None:
            out[k].add(i)
    return out


def test_edge_ids_encode_decode(spark):
    rows = [("a", i) for i in EDGE_IDS]
    bm = bitmap.build(_df(spark, rows), ["k"])
    got = sorted(r.bitmap_id for r in bitmap.decode(bm, ["k"]).collect())
    assert got == EDGE_IDS
    card = bitmap.cardinality(bm, ["k"]).collect()
    assert card[0].user_count == len(EDGE_IDS)


def test_buckets_never_mix(spark):
    # ids 0..9 span buckets 1 only; 32768 starts bucket 2.
    rows = [("a", i) for i in range(10)] + [("a", 32768)]
    bm = bitmap.build(_df(spark, rows), ["k"]).collect()
    assert sorted(r.bucket for r in bm) == [1, 2]


def test_all_null_group_keeps_row_with_zero(spark):
    rows = [("a", None), ("a", None), ("b", 5)]
    bm = bitmap.build(_df(spark, rows), ["k"])
    card = {r.k: r.user_count for r in bitmap.cardinality(bm, ["k"]).collect()}
    assert card == {"a": 0, "b": 1}


def test_duplicates_collapse_and_sparse_equals_dense(spark):
    rows = [("a", 7)] * 5 + [("a", 8), ("b", 7)]
    dense = bitmap.cardinality(bitmap.build(_df(spark, rows), ["k"]), ["k"])
    sparse = bitmap.cardinality(bitmap.build(_df(spark, rows), ["k"], sparse=True), ["k"])
    assert sorted(dense.collect()) == sorted(sparse.collect())
    assert {r.k: r.user_count for r in dense.collect()} == {"a": 2, "b": 1}


def test_negative_id_rejected(spark):
    with pytest.raises(Exception, match="bitmap ids must be >= 0"):
        bitmap.build(_df(spark, [("a", -1)]), ["k"]).collect()


@settings(max_examples=15, deadline=None)
@given(a=ids_strategy, b=ids_strategy)
def test_and_or_card_match_python_sets(spark, a, b):
    rows = [("x", i) for i in a] + [("y", i) for i in b]
    if not rows:
        return
    bm = bitmap.build(_df(spark, rows), ["k"])
    left, right = bm.where(F.col("k") == "x"), bm.where(F.col("k") == "y")
    inter = bitmap.decode(bitmap.intersect(left.drop("k"), right.drop("k")), [])
    assert sorted(r.bitmap_id for r in inter.collect()) == sorted(set(a) & set(b))
    union = bitmap.merge(bm.drop("k"), [])
    assert sorted(r.bitmap_id for r in bitmap.decode(union, []).collect()) == \
        sorted(set(a) | set(b))


def test_from_ids_and_id_sets_roundtrip(spark):
    rows = [("a", i) for i in EDGE_IDS] + [("b", 3), ("b", 3)]
    sets = bitmap.id_sets(_df(spark, rows), ["k"])
    assert all(len(r.bitmap_ids) <= bitmap.BITS_PER_BUCKET for r in sets.collect())
    bm = bitmap.from_ids(sets, ["k"], "bitmap_ids")
    got = _sets([(r.k, r.bitmap_id) for r in bitmap.decode(bm, ["k"]).collect()])
    assert got == _sets(rows)


def test_merge_hours_to_day(spark):
    rows = spark.createDataFrame([("r", "2024010100", 1), ("r", "2024010101", 1),
                                  ("r", "2024010101", 40000)],
                                 "region_id string, produce_hour string, bitmap_id long")
    bm = bitmap.build(rows, ["region_id", "produce_hour"])
    day = bitmap.merge(bm.withColumn("day", F.substring("produce_hour", 1, 8)),
                       ["region_id", "day"])
    assert bitmap.cardinality(day, ["region_id", "day"]).collect()[0].user_count == 2

from pyspark.sql import Row
from pyspark.sql import functions as F

from cellscope.functions import containers
from cellscope.operators import persona, portrait, segments, stay
from cellscope.operators.index import build_user_index


def test_filter_on_a_number(spark):
    rows = spark.createDataFrame([(i, 20 + i) for i in range(7)], "id int, age int")
    assert [r.id for r in rows.where(F.col("id") > 3).collect()] == [4, 5, 6]


def test_dense_index_distinct_bytewise(spark):
    users = spark.createDataFrame([("b",), ("a",), ("10",), ("2",), ("a",), ("",), (None,)],
                                  "imsi string")
    idx = {r.imsi: r.bitmap_id for r in build_user_index(users, num_partitions=3).collect()}
    assert idx == {"10": 0, "2": 1, "a": 2, "b": 3}


def _inputs(spark):
    signals = spark.createDataFrame([
        ("u1", "c1", 0), ("u1", "c1", 1000), ("u2", "c2", 0), ("u3", "c9", 0),
        ("u4", "c1", 3_600_000)],
        "imsi string, laccell string, procedureStartTime long")
    cells = spark.createDataFrame([("r1", "c1"), ("r2", "c2")], "region_id string, laccell string")
    users = spark.createDataFrame([("u1", "1", 15), ("u2", "0", 25), ("u3", "1", 5),
                                   ("u4", "2", 45)], "imsi string, gender string, age int")
    index = build_user_index(spark.createDataFrame([("u1",), ("u2",), ("u4",)], "imsi string"))
    return signals, cells, users, index


def test_stay_counts_keep_null_region_and_unindexed(spark):
    signals, cells, _, index = _inputs(spark)
    bm = stay.region_hour_stay(signals, cells, index)
    counts = {(r.region_id, r.produce_hour): r.user_count
              for r in stay.stay_user_count(bm).collect()}
    # u3 sits on an unknown cell and has no index: NULL region group, 0 users.
    assert counts == {("r1", "1970010100"): 1, ("r2", "1970010100"): 1,
                      (None, "1970010100"): 0, ("r1", "1970010101"): 1}


def test_portraits_drop_minors_and_unknown_gender(spark):
    _, _, users, index = _inputs(spark)
    card = {r.portrait_id: r.user_count for r in
            containers.cardinality(portrait.portrait_bitmaps(users, index),
                               ["portrait_id"]).collect()}
    # u1 male 15 -> {1,3}; u2 female 25 -> {2,4}; u4 gender '2' 45 -> {5}; u3 not indexed.
    assert card == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1}
    rejects = portrait.portrait_rejects(users, index).collect()
    assert [r.portrait_value for r in rejects] == ["2"]


def test_segment_lookup_edge_cases(spark):
    signals, cells, users, index = _inputs(spark)
    sbm = stay.region_hour_stay(signals, cells, index)
    pbm = portrait.portrait_bitmaps(users, index)
    assert segments.segment_count(sbm, pbm, "r1", "1970010100", 1).first().cnt == 1
    assert segments.segment_count(sbm, pbm, "r1", "1970010100", 9).first().cnt == 0
    assert segments.segment_count(sbm, pbm, "nowhere", "1970010100", 1).first().cnt == 0
    # Duplicate (region, hour) rows are OR-merged, not dropped or doubled.
    dup = sbm.unionByName(sbm)
    assert segments.segment_count(dup, pbm, "r1", "1970010100", 1).first().cnt == 1
    users_ = segments.segment_users(sbm, pbm, "r1", "1970010100", 3).collect()
    assert [r.bitmap_id for r in users_] == [0]


def test_region_flow_profile_edit_keeps_counters_balanced(spark):
    from pyspark.sql import types as T
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [Row(imsi="u", ts=t0 + dt.timedelta(minutes=i), event_id=i, region_id=r,
                gender=g, age=a)
            for i, (r, g, a) in enumerate([("A", "1", 15), ("A", "1", 15), ("B", "1", 15),
                                          ("A", "0", 30), ("B", "0", 30)])]
    schema = T.StructType([T.StructField("imsi", T.StringType()),
                           T.StructField("ts", T.TimestampType()),
                           T.StructField("event_id", T.LongType()),
                           T.StructField("region_id", T.StringType()),
                           T.StructField("gender", T.StringType()),
                           T.StructField("age", T.IntegerType())])
    enriched = spark.createDataFrame(rows, schema)
    flows = persona.region_flow(enriched, num_partitions=3)
    got = sorted((r.event_id, r.is_in, r.region_id) for r in flows.collect())
    whole = persona.region_flow(enriched, num_partitions=1)   # no user spans partitions
    assert sorted(tuple(r) for r in whole.collect()) == sorted(tuple(r) for r in flows.collect())
    assert got == [(0, 1, "A"), (2, 0, "A"), (2, 1, "B"), (3, 0, "B"), (3, 1, "A"),
                   (4, 0, "A"), (4, 1, "B")]
    head = {r.region_id: r for r in persona.region_headcount(flows).collect()}
    assert (head["A"].man, head["A"].women, head["A"].age_20_40) == (0, 0, 0)
    assert (head["B"].women, head["B"].age_20_40, head["B"].man) == (1, 1, 0)


def test_persona_cells_roundtrip_and_json(spark):
    p = spark.createDataFrame([("r1", 1, 2, 3, 4, 5)],
                              "region_id string, man long, women long, age_10_20 long, "
                              "age_20_40 long, age_40 long")
    cells = persona.persona_cells(p)
    assert cells.count() == 5
    back = persona.persona_from_cells(cells).first()
    assert (back.man, back.age_40) == ("1", "5")
    doc = persona.persona_json(p).first().doc
    assert doc == '{"man":"1","women":"2","age_10_20":"3","age_20_40":"4","age_40":"5"}'


def test_cell_in_two_regions_fans_out_in_batch(spark):
    signals = spark.createDataFrame([("u1", "c1", 0)],
                                    "imsi string, laccell string, procedureStartTime long")
    cells = spark.createDataFrame([("r1", "c1"), ("r2", "c1")], "region_id string, laccell string")
    index = build_user_index(spark.createDataFrame([("u1",)], "imsi string"))
    counts = {r.region_id: r.user_count for r in
              stay.stay_user_count(stay.region_hour_stay(signals, cells, index)).collect()}
    assert counts == {"r1": 1, "r2": 1}


def test_extend_index_keeps_known_ids(spark):
    from cellscope.operators.index import extend_user_index
    day1 = build_user_index(spark.createDataFrame([("b",), ("d",)], "imsi string"))
    day2_users = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("d",)], "imsi string")
    day2 = {r.imsi: r.bitmap_id for r in extend_user_index(day1, day2_users).collect()}
    assert day2 == {"b": 0, "d": 1, "a": 2, "c": 3}
    empty = spark.createDataFrame([], "imsi string, bitmap_id long")
    fresh = {r.imsi: r.bitmap_id for r in extend_user_index(empty, day2_users).collect()}
    assert fresh == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_locality_ordered_index_groups_home_regions(spark):
    from cellscope.operators.index import home_regions
    signals = spark.createDataFrame(
        [("a", "c2"), ("a", "c2"), ("a", "c1"), ("b", "c1"), ("c", "c2"), ("d", "c9")],
        "imsi string, laccell string")
    cells = spark.createDataFrame([("r1", "c1"), ("r2", "c2")], "region_id string, laccell string")
    home = {r.imsi: r.home_region for r in home_regions(signals, cells).collect()}
    assert home == {"a": "r2", "b": "r1", "c": "r2"}
    users = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "imsi string")
    idx = {r.imsi: r.bitmap_id for r in
           build_user_index(users, locality=home_regions(signals, cells)).collect()}
    # NULL group (d, never on a known cell) sorts first, then r1 users, then r2 users.
    assert idx == {"d": 0, "b": 1, "a": 2, "c": 3}


def test_under_ten_counts_in_gender_only_for_persona(spark):
    import datetime as dt
    rows = [("k", "c1", dt.datetime(2024, 1, 1, 0, 0, 5), 1, 0, "A", "0", 5)]
    enriched = spark.createDataFrame(
        rows, "imsi string, laccell string, ts timestamp, event_id long, "
              "procedureStartTime long, region_id string, gender string, age int")
    r = persona.persona_window(enriched).first()
    assert (r.women, r.man, r.age_10_20, r.age_20_40, r.age_40) == (1, 0, 0, 0, 0)
    users = spark.createDataFrame([("k", "0", 5)], "imsi string, gender string, age int")
    index = build_user_index(spark.createDataFrame([("k",)], "imsi string"))
    assert portrait.portrait_bitmaps(users, index).count() == 0


def test_hour_bucket_follows_session_time_zone(spark):
    from cellscope.functions.scalar import hour_bucket
    df = spark.createDataFrame([(1670468511000,)], "ms long")   # 2022-12-08 03:01:51 UTC
    assert df.select(hour_bucket("ms").alias("h")).first().h == "2022120803"
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert df.select(hour_bucket("ms").alias("h")).first().h == "2022120811"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_preaggregated_window_equals_signal_window(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 8, 0, 5)
    rows = [("u1", "c1", t0, 1), ("u1", "c1", t0 + dt.timedelta(seconds=20), 2),
            ("u1", "c1", t0 + dt.timedelta(seconds=40), 3), ("u2", "c1", t0, 4),
            ("u2", "c2", t0 + dt.timedelta(minutes=1), 5), ("u3", "c1", t0, 6)]
    signals = spark.createDataFrame(rows, "imsi string, laccell string, ts timestamp, "
                                          "event_id long").withColumn("procedureStartTime",
                                                                      F.lit(0).cast("long"))
    users = spark.createDataFrame([("u1", "1", 15), ("u2", "0", 45)],
                                  "imsi string, gender string, age int")
    cells = spark.createDataFrame([("A", "c1"), ("B", "c2")], "region_id string, laccell string")
    a = persona.persona_window(persona.enrich(signals, users, cells))
    b = persona.persona_window_preagg(signals, users, cells)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    first = {r.region_id: r for r in b.collect()}["A"]
    assert (first.man, first.women, first.age_10_20, first.age_40) == (3, 1, 3, 1)

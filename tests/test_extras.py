import pytest
from pyspark.sql import functions as F

from cellscope.operators import persona, segments
from cellscope.operators.index import unique_id_index
from cellscope.sources.jdbc import jdbc_options
from cellscope.streaming import jobs


def test_jdbc_options_partitioned_scan():
    opts = jdbc_options(url="jdbc:x://h/db", table="USER_INDEX", user="u", password="p",
                        partition_column="BITMAP_ID", lower_bound=0, upper_bound=1000,
                        num_partitions=8)
    assert opts["numPartitions"] == "8" and opts["dbtable"] == "USER_INDEX"
    with pytest.raises(ValueError):
        jdbc_options(url="jdbc:x://h/db", table="T", partition_column="ID")


def test_id_overflow_fails(spark):
    big = spark.createDataFrame([("a", (1 << 32) + 5)], "imsi string, bitmap_id long")
    from cellscope.operators.index import _checked
    with pytest.raises(Exception, match="unsigned 32-bit"):
        big.select(_checked("bitmap_id")).collect()


def test_unique_id_index_is_unique(spark):
    users = spark.createDataFrame([(str(i),) for i in range(50)], "imsi string").repartition(4)
    ids = [r.bitmap_id for r in unique_id_index(users).collect()]
    assert len(set(ids)) == 50


def test_lookup_json_missing_region_is_empty_object(spark):
    p = spark.createDataFrame([("r1", 1, 2, 3, 4, 5)],
                              "region_id string, man long, women long, age_10_20 long, "
                              "age_20_40 long, age_40 long")
    assert persona.persona_lookup_json(p, "nope").first().doc == "{}"
    assert persona.persona_lookup_json(p, "r1").first().doc.startswith('{"man":"1"')


def test_count_json(spark):
    row = spark.createDataFrame([(7,)], "cnt long")
    assert segments.count_json(row).first().doc == '{"cnt":7}'


def test_processing_time_trigger_and_state_ttl_run(spark, workdir):
    import os
    from cellscope.streaming.sources import signal_stream, text_lines
    os.makedirs(f"{workdir}/src")
    with open(f"{workdir}/src/a.txt", "w") as fh:
        fh.write("u1|c1|0|0|1704067200000\nu1|c2|0|0|1704067260000\n")
    users = spark.createDataFrame([("u1", "1", 20)], "imsi string, gender string, age int")
    cells = spark.createDataFrame([("A", "c1"), ("B", "c2")], "region_id string, laccell string")
    enriched = jobs.enrich_static(signal_stream(text_lines(spark, f"{workdir}/src")), users, cells)
    flows = jobs.flows_stream(enriched, ttl_ms=86_400_000)
    q = jobs.start_upsert(jobs.headcount_stream(flows), f"{workdir}/snap", ["region_id"],
                          ["man"], f"{workdir}/chk", trigger={"processingTime": "1 second"})
    # TTL runs the processor in processing-time mode, which keeps scheduling
    # eviction batches: poll the sink, then stop the query.
    import time
    from cellscope.operators.sinks import latest_snapshot
    try:
        for _ in range(60):
            time.sleep(1)
            if os.path.exists(f"{workdir}/snap/_done/0"):
                break
    finally:
        q.stop()
    got = {r.region_id: r.man for r in latest_snapshot(spark, f"{workdir}/snap").collect()}
    assert got == {"A": 0, "B": 1}
    assert F is not None


def test_dimension_snapshot_follows_its_files(spark, workdir):
    import os
    from cellscope.sources.dimensions import DimensionSnapshot
    os.makedirs(f"{workdir}/users")
    with open(f"{workdir}/users/a.txt", "w") as fh:
        fh.write("u1|1|20\nu2|0|30\n")
    snap = DimensionSnapshot(spark, f"{workdir}/users", "user", "imsi", name="dimtest")
    first = snap.get()
    assert snap.get() is first and snap.version == 1          # unchanged folder: reused
    with open(f"{workdir}/users/b.txt", "w") as fh:           # a new file
        fh.write("u2|0|31\n")
    assert {r.imsi: r.age for r in snap.get().collect()} == {"u1": 20, "u2": 31}
    with open(f"{workdir}/users/b.txt", "w") as fh:           # the same file, written anew
        fh.write("u2|0|55\n")
    os.utime(f"{workdir}/users/b.txt", (4e9, 4e9))
    assert {r.imsi: r.age for r in snap.get().collect()} == {"u1": 20, "u2": 55}
    assert snap.version == 3


def test_dimension_snapshot_expires(spark, workdir):
    import os
    import time
    from cellscope.sources.dimensions import DimensionSnapshot
    os.makedirs(f"{workdir}/users")
    for name, age in (("a", 20), ("b", 30)):
        with open(f"{workdir}/users/{name}.txt", "w") as fh:
            fh.write(f"{name}|1|{age}\n")
    snap = DimensionSnapshot(spark, f"{workdir}/users", "user", "imsi", ttl_seconds=1000)
    assert snap.get().count() == 2
    past = time.time() - 2000
    os.utime(f"{workdir}/users/a.txt", (past, past))
    assert [r.imsi for r in snap.get().collect()] == ["b"]


def test_console_sink_starts_and_stops(spark, workdir):
    import os
    os.makedirs(f"{workdir}/src")
    with open(f"{workdir}/src/a.txt", "w") as fh:
        fh.write("x\n")
    lines = spark.readStream.format("text").load(f"{workdir}/src")
    q = jobs.start_console(lines, output_mode="append", trigger={"availableNow": True})
    q.awaitTermination(60)
    assert not q.isActive and q.exception() is None


def test_dimension_snapshot_missing_folder_is_empty(spark, workdir):
    from cellscope.sources.dimensions import DimensionSnapshot
    snap = DimensionSnapshot(spark, f"{workdir}/not-yet", "user", "imsi")
    assert snap.get().count() == 0
    assert snap.get().columns == ["imsi", "gender", "age"]

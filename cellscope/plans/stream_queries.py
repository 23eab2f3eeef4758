"""Streaming queries over mapping M1, run to completion with ``availableNow``.

Each query streams the events table (or files Spark derives from it),
writes through the streaming sink under test into the shared checkpoint
folder, and returns a batch read of what the sink holds at the end.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cellscope.operators.sinks import latest_snapshot
from cellscope.plans.batch_queries import _IND, _ts_text, flows_oracle, headcount_oracle
from cellscope.plans.catalog import query
from cellscope.schemas import PERSONA_COLUMNS
from cellscope.session import scratch_path
from cellscope.sources import fixtures
from cellscope.sources.delimited import write_lines
from cellscope.sources.fixtures import oracle
from cellscope.streaming import jobs
from cellscope.streaming.sources import signal_stream, text_lines


FILES = 5


def _event_signals(spark: SparkSession, sf_dir: str, shuffled: bool = False):
    """The events table as a stream of FILES micro-batches: in time order (rows without a time
    first), or ``shuffled`` so that every one holds all times.  A micro-batch's rows are spread
    over as many files as the input has partitions for it."""
    events = fixtures.table(spark, sf_dir, "events")
    path = scratch_path(spark, "event-files")
    spread = -(-events.rdd.getNumPartitions() // FILES)
    if shuffled:
        part = F.col("event_id") % FILES
    else:
        first, last = events.agg(F.min("ts"), F.max("ts")).first()
        step = (last - first) / FILES
        part = sum(F.coalesce((F.col("ts") >= F.lit(first + step * k)).cast("int"), F.lit(0)) for k in range(1, FILES))
    tagged = events.withColumn("_part", part)
    for k in range(FILES):      # one after the other: the stream reads files by age
        tagged.where(F.col("_part") == k).drop("_part").repartition(spread).write.mode("append").parquet(path)
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", str(spread))
    return fixtures.events_as_signals(reader.parquet(path))


def _static_dims(spark: SparkSession, sf_dir: str):
    return fixtures.m1_user_info(spark, sf_dir), fixtures.m1_region_cell(spark, sf_dir)


def _enriched_static(spark: SparkSession, sf_dir: str, shuffled: bool = False):
    users, cells = _static_dims(spark, sf_dir)
    return jobs.enrich_static(_event_signals(spark, sf_dir, shuffled), users, cells)


def _append_and_read(spark: SparkSession, df, name: str):
    base = scratch_path(spark, name)
    jobs.run_to_end(jobs.start_append(df, f"{base}/out", f"{base}/chk"))
    return spark.read.parquet(f"{base}/out")


@query("stream_signals", oracle("""
SELECT imsi, laccell, procedureStartTime FROM signals"""))
def q_stream_signals(spark, sf_dir):
    src = scratch_path(spark, "signal-lines")
    write_lines(fixtures.m1_signals(spark, sf_dir), src,
                ["imsi", "laccell", "latitude", "longitude", "procedureStartTime"])
    parsed = signal_stream(text_lines(spark, src))
    out = _append_and_read(spark, parsed.select("imsi", "laccell", "procedureStartTime"),
                           "stream-signals")
    return out


@query("stream_enrich_users", oracle("""
SELECT s.event_id, s.imsi, u.gender, u.age
FROM signals s JOIN user_info u ON s.imsi = u.imsi"""))
def q_stream_enrich_users(spark, sf_dir):
    users, _cells = _static_dims(spark, sf_dir)
    joined = (_event_signals(spark, sf_dir).select("event_id", "imsi")
              .join(users, "imsi", "inner"))
    return _append_and_read(spark, joined, "stream-enrich-users")


@query("stream_enrich_regions", oracle("""
SELECT s.event_id, s.laccell, rc.region_id
FROM signals s JOIN region_cell rc ON s.laccell = rc.laccell"""))
def q_stream_enrich_regions(spark, sf_dir):
    _users, cells = _static_dims(spark, sf_dir)
    joined = (_event_signals(spark, sf_dir).select("event_id", "laccell")
              .join(cells, "laccell", "inner"))
    return _append_and_read(spark, joined, "stream-enrich-regions")


def _write_dimension_folders(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    users, cells = _static_dims(spark, sf_dir)
    upath, cpath = scratch_path(spark, "dim-users"), scratch_path(spark, "dim-cells")
    write_lines(users, upath, ["imsi", "gender", "age"])
    write_lines(cells, cpath, ["region_id", "laccell"])
    return upath, cpath


@query("stream_parse_rejects", oracle("""
SELECT imsi || '|' || laccell || '|bad' AS line FROM signals WHERE event_id % 3 = 0"""))
def q_stream_parse_rejects(spark, sf_dir):
    """The live feed's malformed lines are kept by a query of their own."""
    s = fixtures.m1_signals(spark, sf_dir)
    good = F.concat_ws("|", *[F.col(c).cast("string") for c in
                              ("imsi", "laccell", "latitude", "longitude", "procedureStartTime")])
    line = F.when(F.col("event_id") % 3 == 0, F.concat_ws("|", "imsi", "laccell", F.lit("bad"))).otherwise(good)
    src, base = scratch_path(spark, "live-lines"), scratch_path(spark, "live-rejects")
    write_lines(s.select(line.alias("value")), src)
    jobs.run_to_end(jobs.start_rejects(text_lines(spark, src), f"{base}/out", f"{base}/chk"))
    return spark.read.schema("line string").parquet(f"{base}/out")


# The dimension changes while the stream runs: before the second half of the files the
# users' file is written anew in place (ages one up), and a new one adds a region's cells.
@query("stream_dim_refresh", oracle(f"""
SELECT e.event_id, e.imsi, e.region_id, e.gender, CAST(e.age + (e.event_id % {FILES} >= 3)::INT AS INTEGER) AS age
FROM enriched e WHERE e.event_id % {FILES} >= 3 OR CAST(e.laccell AS BIGINT) % 2 = 0"""))
def q_stream_dim_refresh(spark, sf_dir):
    users, cells = _static_dims(spark, sf_dir)
    base, even = scratch_path(spark, "stage-a"), F.col("laccell").cast("long") % 2 == 0
    upath, cpath = f"{base}/users", f"{base}/cells"
    write_lines(users, upath, ["imsi", "gender", "age"])
    write_lines(cells.where(even), cpath, ["region_id", "laccell"])
    events, src = fixtures.table(spark, sf_dir, "events"), f"{base}/events"

    def add_and_run(part):
        events.where(part).write.mode("append").parquet(src)
        signals = fixtures.events_as_signals(spark.readStream.schema(events.schema).parquet(src))
        jobs.run_to_end(jobs.start_enrich_stage(signals, upath, cpath, f"{base}/enriched", f"{base}/rejects",
                                                f"{base}/chk", ttl_seconds=86400))
    for k in range(3):
        add_and_run(F.col("event_id") % FILES == k)
    write_lines(users.withColumn("age", F.col("age") + 1), upath, ["imsi", "gender", "age"])
    write_lines(cells.where(~even), cpath, ["region_id", "laccell"], mode="append")
    for k in range(3, FILES):
        add_and_run(F.col("event_id") % FILES == k)
    out = spark.read.schema(jobs.ENRICHED).parquet(f"{base}/enriched")
    return out.select("event_id", "imsi", "region_id", "gender", "age")


@query("stream_persona_window_late", oracle(f"""
SELECT region_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('minute', ts) + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
       {_IND}
FROM enriched GROUP BY ALL"""))
def q_stream_persona_window_late(spark, sf_dir):
    """Files in no time order: every signal counts, however late."""
    base = scratch_path(spark, "late-windows")
    jobs.run_to_end(jobs.start_window_counts(_enriched_static(spark, sf_dir, shuffled=True),
                                             f"{base}/parts", f"{base}/chk"))
    out = jobs.read_window_counts(spark, f"{base}/parts")
    return out.select("region_id", _ts_text("window_start").alias("window_start"),
                      _ts_text("window_end").alias("window_end"), *PERSONA_COLUMNS)


@query("stream_persona_window", oracle(f"""
SELECT region_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('minute', ts) + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
       {_IND}
FROM enriched GROUP BY ALL"""))
def q_stream_persona_window(spark, sf_dir):
    counts = jobs.persona_window_stream(_enriched_static(spark, sf_dir))
    base = scratch_path(spark, "persona-window")
    jobs.run_to_end(jobs.start_upsert(counts, f"{base}/snap", ["region_id", "window_start"],
                                      ["window_end"], f"{base}/chk"))
    snap = latest_snapshot(spark, f"{base}/snap")
    return snap.select("region_id", _ts_text("window_start").alias("window_start"),
                       _ts_text("window_end").alias("window_end"), *PERSONA_COLUMNS)


@query("stream_upsert", oracle(f"""
SELECT region_id, window_start, {", ".join(PERSONA_COLUMNS)} FROM (
  SELECT region_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
         {_IND},
         row_number() OVER (PARTITION BY region_id ORDER BY date_trunc('minute', ts) DESC) AS rn
  FROM enriched GROUP BY region_id, date_trunc('minute', ts)) w
WHERE rn = 1"""))
def q_stream_upsert(spark, sf_dir):
    counts = jobs.persona_window_stream(_enriched_static(spark, sf_dir))
    base = scratch_path(spark, "persona-latest")
    jobs.run_to_end(jobs.start_upsert(counts, f"{base}/snap", ["region_id"],
                                      ["window_start"], f"{base}/chk"))
    snap = latest_snapshot(spark, f"{base}/snap")
    return snap.select("region_id", _ts_text("window_start").alias("window_start"),
                       *PERSONA_COLUMNS)


@query("stream_region_flow", flows_oracle("""
SELECT imsi, event_id, CAST(is_in AS INTEGER) AS is_in, region_id, gender, age FROM flows"""))
def q_stream_region_flow(spark, sf_dir):
    flows = jobs.flows_stream(_enriched_static(spark, sf_dir))
    out = _append_and_read(spark, flows, "stream-flows")
    return out.select("imsi", "event_id", "is_in", "region_id", "gender", "age")


@query("stream_region_headcount", headcount_oracle("SELECT * FROM headcount"))
def q_stream_region_headcount(spark, sf_dir):
    counts = jobs.headcount_stream(jobs.flows_stream(_enriched_static(spark, sf_dir)))
    base = scratch_path(spark, "headcount")
    jobs.run_to_end(jobs.start_upsert(counts, f"{base}/snap", ["region_id"], [],
                                      f"{base}/chk"))
    return latest_snapshot(spark, f"{base}/snap").select("region_id", *PERSONA_COLUMNS)



@query("stream_two_stage_headcount", headcount_oracle("SELECT * FROM headcount"))
def q_stream_two_stage_headcount(spark, sf_dir):
    """Production chain: stage A (dimension folders, enrichment per micro-batch)
    feeding stage B (per-user enter/leave state, per-region counters, upsert)."""
    upath, cpath = _write_dimension_folders(spark, sf_dir)
    base = scratch_path(spark, "two-stage")
    jobs.run_to_end(jobs.start_enrich_stage(_event_signals(spark, sf_dir), upath, cpath,
                                            f"{base}/enriched", f"{base}/rejects",
                                            f"{base}/chkA"))
    counts = jobs.headcount_stream(jobs.flows_stream(jobs.enriched_stream(spark,
                                                                          f"{base}/enriched")))
    jobs.run_to_end(jobs.start_upsert(counts, f"{base}/snap", ["region_id"], [],
                                      f"{base}/chkB"))
    return latest_snapshot(spark, f"{base}/snap").select("region_id", *PERSONA_COLUMNS)

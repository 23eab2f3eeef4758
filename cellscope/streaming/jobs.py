"""Structured Streaming jobs: live persona counters per region.

Two-stage layout (dimensions refresh while stateful operators run):

* **Stage A** (:func:`start_enrich_stage`): ``foreachBatch`` re-reads the user
  and cell dimension folders each micro-batch (last write wins per key,
  optional TTL), joins the batch (broadcast when the dimension is small,
  shuffle join otherwise), and writes enriched rows to
  ``<out>/batch_id=<n>`` plus the dropped rows to ``<rejects>/batch_id=<n>``.
  A replayed batch whose folder is already committed is skipped.
* **Stage B** streams the enriched folder into

  - :func:`persona_window_stream` -- per-region signal counts per tumbling
    window (event time, processing time on request), or
  - :func:`start_window_counts` -- the same counts without state or cut-off,
    late signals included, or
  - :func:`flows_stream` + :func:`headcount_stream` -- per-user enter/leave
    flows from keyed state (``transformWithStateInPandas``), summed into
    net per-region counters;

  and upserts the result by key with :func:`start_upsert`.

When the dimensions are fixed for the lifetime of a query, a single query
with a stream-static join (:func:`enrich_static`) is enough.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from cellscope.operators import persona
from cellscope.operators.sinks import upsert_snapshot
from cellscope.schemas import PERSONA_COLUMNS, REGION_FLOW
from cellscope.session import default_parallelism
from cellscope.sources import delimited, files
from cellscope.sources.dimensions import DimensionSnapshot

ENRICHED = T.StructType([
    T.StructField("imsi", T.StringType()),
    T.StructField("laccell", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("procedureStartTime", T.LongType()),
    T.StructField("region_id", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
])


# ------------------------------------------------------------- enrichment

def enrich_static(signals: DataFrame, users: DataFrame, cells: DataFrame) -> DataFrame:
    """Stream-static inner joins with fixed dimensions."""
    return persona.enrich(signals, users, cells)


def enrich_batch(batch: DataFrame, users: DataFrame, cells: DataFrame) -> tuple[DataFrame,
                                                                              DataFrame]:
    """(enriched, rejects) of one micro-batch against current dimensions."""
    enriched = persona.enrich(batch, users, cells).select(*ENRICHED.fieldNames())
    return enriched, persona.enrich_rejects(batch, users, cells)


def start_enrich_stage(signals: DataFrame, user_path: str, cell_path: str, out_base: str,
                       rejects_base: str, checkpoint: str, ttl_seconds: int | None = None,
                       trigger: dict | None = None) -> StreamingQuery:
    """Stage A: per micro-batch dimension refresh + enrichment.

    The dimensions are rebuilt only when their files change or expire, see
    :class:`DimensionSnapshot`.
    """
    spark = signals.sparkSession
    users_dim = DimensionSnapshot(spark, user_path, "user", "imsi", ttl_seconds,
                                  name="dim_users")
    cells_dim = DimensionSnapshot(spark, cell_path, "cell", "laccell", ttl_seconds,
                                  name="dim_cells")

    def run(batch: DataFrame, batch_id: int) -> None:
        write_enriched_batch(batch, batch_id, users_dim, cells_dim, out_base, rejects_base)

    writer = (signals.writeStream.foreachBatch(run)
              .option("checkpointLocation", checkpoint))
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def is_committed(spark: SparkSession, folder: str) -> bool:
    """True when ``folder`` holds a finished write (its ``_SUCCESS`` marker)."""
    return files.exists(spark, f"{folder}/_SUCCESS")


def write_enriched_batch(batch: DataFrame, batch_id: int, users_dim: DimensionSnapshot,
                         cells_dim: DimensionSnapshot, out_base: str, rejects_base: str) -> None:
    """Enrich one micro-batch into ``<out>/batch_id=<n>`` (rejects alongside).

    The batch is written in a hidden folder and moved to its name when it is
    finished, so stage B never sees files of an unfinished batch that a
    replay would write again.  A batch whose folder is there is skipped.
    """
    spark = batch.sparkSession
    out = f"{out_base}/batch_id={batch_id}"
    if is_committed(spark, out):
        return
    # Two outputs from one batch: keep it so the source is read once.  Stage A
    # has no stateful operator, so a lost block is recomputed from the same
    # offsets with the same result.
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    staged = f"{out_base}/_staged/{batch_id}"
    try:
        enriched, rejects = enrich_batch(batch, users_dim.get(), cells_dim.get())
        rejects.write.mode("overwrite").parquet(f"{rejects_base}/batch_id={batch_id}")
        enriched.write.mode("overwrite").parquet(staged)
        files.rename(spark, staged, out)
    finally:
        batch.unpersist()


def start_rejects(lines: DataFrame, path: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Keep the feed's malformed lines, as (line): what :func:`signal_stream` leaves out."""
    return start_append(delimited.rejects(lines, delimited.signal_is_valid()), path, checkpoint,
                        trigger)


def enriched_stream(spark: SparkSession, base: str, max_files: int | None = None) -> DataFrame:
    """Stage B input: the enriched folder written by stage A."""
    reader = spark.readStream.schema(ENRICHED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(base).select(*ENRICHED.fieldNames())


# ---------------------------------------------------- persona per window

def persona_window_stream(enriched: DataFrame, window: str = "1 minute",
                          time_mode: str = "event", watermark: str | None = None) -> DataFrame:
    """Signal counts per (region, tumbling window).

    ``event``: windows on the signal time, replayable.  Without a watermark
    every signal counts however late it is, and state grows with the windows;
    a ``watermark`` bounds the state and drops what is later.  To keep all
    signals without state use :func:`start_window_counts`.  ``processing``:
    windows on arrival time like the original job (results depend on when
    data arrives).
    """
    if time_mode == "processing":
        enriched = enriched.withColumn("ts", F.current_timestamp())
    if watermark is not None:
        enriched = enriched.withWatermark("ts", watermark)
    ind = persona.indicators()
    return (enriched.groupBy("region_id", F.window("ts", window).alias("w"))
                    .agg(*[F.sum(c).cast("long").alias(n) for n, c in ind.items()])
                    .select("region_id", F.col("w.start").alias("window_start"),
                            F.col("w.end").alias("window_end"), *PERSONA_COLUMNS))


WINDOW_COUNTS = T.StructType(
    [T.StructField("region_id", T.StringType()), T.StructField("window_start", T.TimestampType()),
     T.StructField("window_end", T.TimestampType())]
    + [T.StructField(c, T.LongType()) for c in PERSONA_COLUMNS]
    + [T.StructField("day", T.StringType()), T.StructField("batch_id", T.LongType())])


def start_window_counts(enriched: DataFrame, base: str, checkpoint: str,
                        window: str = "1 minute", trigger: dict | None = None) -> StreamingQuery:
    """Window counts with no cut-off for late signals and no state.

    Each micro-batch adds its own counts per (region, window) under
    ``<base>/day=<window day>/batch_id=<n>``; a late signal simply adds to an
    earlier day's folder, and a replay rewrites its own.  Nothing stored
    before is read or rewritten.  :func:`read_window_counts` sums the parts.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        part = persona.persona_window(batch, window)
        (part.withColumn("day", F.date_format("window_start", "yyyyMMdd"))
             .withColumn("batch_id", F.lit(batch_id).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("day", "batch_id").parquet(base))

    return (enriched.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
                    .trigger(**(trigger or {"availableNow": True})).start())


def read_window_counts(spark: SparkSession, base: str) -> DataFrame:
    """(region_id, window_start, window_end, counters) over all micro-batches so far."""
    parts = spark.read.schema(WINDOW_COUNTS).parquet(base)
    return parts.groupBy("region_id", "window_start", "window_end").agg(
        *[F.sum(c).cast("long").alias(c) for c in PERSONA_COLUMNS])


# ------------------------------------------------ enter / leave flows (T3)

_STATE_SCHEMA = "region_id string, gender string, age int"

# Users are grouped into hash buckets for the stateful operator; the per-user
# state lives in a MapState keyed by imsi inside each bucket.  The bucket is
# the state's grouping key, so the count must stay the same for the life of a
# checkpoint, like the shuffle partition count it is derived from.
BUCKETS_PER_PARTITION = 16


class RegionFlowProcessor(StatefulProcessor):
    """Enter/leave state machine for all users of one hash bucket.

    Per user it remembers the current region and the profile seen on entry.
    Rows of one micro-batch are ordered by (imsi, ts, event_id); across micro-
    batches arrival order holds.  A region change emits an enter for the new
    region and, if the user was somewhere, a leave for the old region carrying
    the profile recorded on entry, so counters stay balanced across profile
    edits.  One invocation handles every user of the bucket with numpy; the
    state is read once per user present in the batch and written once per
    user whose region changed.
    """

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getMapState("current", "imsi string", _STATE_SCHEMA, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame],
                        timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        pdf = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        pdf = pdf.sort_values(["imsi", "ts", "event_id"], kind="stable", ignore_index=True)
        imsi = pdf["imsi"].to_numpy(dtype=object)
        region = pdf["region_id"].to_numpy(dtype=object)
        gender = pdf["gender"].to_numpy(dtype=object)
        age = pdf["age"].to_numpy(dtype=np.int64)

        first = np.ones(len(imsi), dtype=bool)
        first[1:] = imsi[1:] != imsi[:-1]
        user_of_row = np.cumsum(first) - 1
        saved = [self.current.getValue((u,)) for u in imsi[first]]

        prev = np.empty(len(region), dtype=object)
        prev[1:] = region[:-1]
        prev[first] = [s[0] if s is not None else None for s in saved]
        at = np.flatnonzero(region != prev)
        if at.size == 0:
            return
        user_at = user_of_row[at]
        first_change = np.ones(at.size, dtype=bool)
        first_change[1:] = user_at[1:] != user_at[:-1]
        last_change = np.ones(at.size, dtype=bool)
        last_change[:-1] = user_at[:-1] != user_at[1:]

        # Region left at each change = the user's previous change in this
        # batch, or the saved state for the first one, with its entry profile.
        in_region, in_gender, in_age = region[at], gender[at], age[at]
        out_region = np.empty(at.size, dtype=object)
        out_gender = np.empty(at.size, dtype=object)
        out_age = np.zeros(at.size, dtype=np.int64)
        out_region[1:], out_gender[1:], out_age[1:] = in_region[:-1], in_gender[:-1], in_age[:-1]
        for j in np.flatnonzero(first_change):
            s = saved[user_at[j]]
            out_region[j], out_gender[j], out_age[j] = (s[0], s[1], s[2]) if s else (None, None, 0)
        has_out = np.array([r is not None for r in out_region], dtype=bool)

        for j in np.flatnonzero(last_change):
            self.current.updateValue((imsi[at[j]],),
                                     (in_region[j], in_gender[j], int(in_age[j])))

        ts = pdf["ts"].to_numpy()[at]
        eid = pdf["event_id"].to_numpy(dtype=np.int64)[at]
        n_out = int(has_out.sum())
        yield pd.DataFrame({
            "imsi": np.concatenate([imsi[at], imsi[at][has_out]]),
            "ts": np.concatenate([ts, ts[has_out]]),
            "event_id": np.concatenate([eid, eid[has_out]]),
            "is_in": np.concatenate([np.ones(at.size, np.int32), np.zeros(n_out, np.int32)]),
            "region_id": np.concatenate([in_region, out_region[has_out]]),
            "gender": np.concatenate([in_gender, out_gender[has_out]]),
            "age": np.concatenate([in_age, out_age[has_out]]).astype(np.int32),
        })

    def close(self) -> None:
        pass


def flows_stream(enriched: DataFrame, ttl_ms: int | None = None,
                 state_buckets: int | None = None) -> DataFrame:
    """Enter/leave flows from per-user state (shuffle on the imsi bucket, RocksDB).

    ``ttl_ms`` expires a silent user's state; it switches the operator to
    processing-time mode, which keeps scheduling eviction batches, so run such
    a query with a processing-time trigger (``availableNow`` would not end).
    ``state_buckets`` (by default ``BUCKETS_PER_PARTITION`` for each shuffle
    partition) must not change while the checkpoint is in use; what one
    invocation holds is a bucket's share of a micro-batch, which the source's
    rate limit bounds.
    """
    state_buckets = state_buckets or BUCKETS_PER_PARTITION * default_parallelism(
        enriched.sparkSession)
    time_mode = "ProcessingTime" if ttl_ms else "None"
    cols = ["imsi", "ts", "event_id", "region_id", "gender", "age"]
    bucket = F.pmod(F.xxhash64("imsi"), F.lit(state_buckets)).alias("_bucket")
    return (enriched.select(*cols, bucket).groupBy("_bucket")
                    .transformWithStateInPandas(RegionFlowProcessor(ttl_ms), REGION_FLOW,
                                                "Append", time_mode))


def headcount_stream(flows: DataFrame) -> DataFrame:
    """Net per-region counters (+1 enter / -1 leave), running forever."""
    return persona.region_headcount(flows)


# ------------------------------------------------------------------ sink

def start_upsert(df: DataFrame, base: str, key_cols: Sequence[str], order_cols: Sequence[str],
                 checkpoint: str, output_mode: str = "update",
                 trigger: dict | None = None) -> StreamingQuery:
    """Keyed last-write-wins snapshots (see :func:`upsert_snapshot`)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        upsert_snapshot(batch, batch_id, base, key_cols, order_cols)

    return (df.writeStream.outputMode(output_mode).foreachBatch(run)
              .option("checkpointLocation", checkpoint)
              .trigger(**(trigger or {"availableNow": True})).start())


def start_append(df: DataFrame, path: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Append every micro-batch to a Parquet folder (exactly-once file sink)."""
    return (df.writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint)
              .trigger(**(trigger or {"availableNow": True})).start())


def start_console(df: DataFrame, output_mode: str = "update", num_rows: int = 20,
                  trigger: dict | None = None) -> StreamingQuery:
    """Print each micro-batch (debugging sink)."""
    return (df.writeStream.outputMode(output_mode).format("console")
              .option("numRows", str(num_rows)).option("truncate", "false")
              .trigger(**(trigger or {"processingTime": "1 minute"})).start())


def run_to_end(q: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an ``availableNow`` query; surface its error if it failed."""
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"streaming query {q.name or q.id} did not finish")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))

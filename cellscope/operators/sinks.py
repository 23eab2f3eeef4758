"""Sinks: idempotent table writes and the keyed snapshot upsert.

The original jobs inserted row by row and appended on every re-run, so a
retried job duplicated ids and bitmaps.  Here every write is a whole-
DataFrame write that a re-run replaces:

* ``write_table``      -- full overwrite (user index, portraits);
* ``write_hourly``     -- ``partitionBy(produce_hour)`` with dynamic partition
  overwrite: re-running one hour replaces that hour only;
* ``upsert_snapshot``  -- keyed last-write-wins for streaming results: the new
  snapshot of batch *n* = snapshot *n-1* minus the keys in the batch, plus the
  latest row per key of the batch.  Each snapshot has a folder of its own
  (``<base>/batch=<n>``) and counts once its marker ``<base>/_done/<n>`` is
  there; a missing predecessor is an error, never an empty table.  Snapshots
  older than the retention time go.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.operators.joins import latest_per_key
from cellscope.sources import files


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                sort_cols: Sequence[str] = ()) -> str:
    """Full overwrite; ``sort_cols`` orders rows inside each file so Parquet
    min/max statistics let point lookups skip row groups."""
    if sort_cols:
        df = df.sortWithinPartitions(*sort_cols)
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def write_hourly(df: DataFrame, path: str, hour_col: str = "produce_hour",
                 sort_cols: Sequence[str] = ("region_id", "bucket"),
                 hours: Sequence[str] = ()) -> str:
    """One folder per hour; re-running some hours replaces just those folders.

    ``hours`` names the hours that the run stands for: an hour of these without
    rows is emptied, where a plain dynamic overwrite would leave its old rows.

    ``rebalance`` clusters rows of an hour into few files while AQE still
    splits an oversized hour into several advisory-sized tasks; rows are
    sorted by ``sort_cols`` inside each file so a region lookup reads only the
    matching row groups.  Each written hour must be complete in ``df`` (a
    backfill or a recomputation); incremental runs whose late signals touch
    earlier hours use the (produce_hour, source_hour) layout of
    :func:`cellscope.plans.jobs.hourly_stay_job`.
    """
    spark = df.sparkSession
    for hour in hours:
        files.delete(spark, f"{path.rstrip('/')}/{hour_col}={hour}")
    df = df.hint("rebalance", hour_col)
    present = [c for c in sort_cols if c in df.columns]
    if present:
        df = df.sortWithinPartitions(hour_col, *present)
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(hour_col)
       .parquet(path))
    return path


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str]) -> str:
    """Folder-partitioned overwrite with few files per folder (``rebalance``)."""
    (df.hint("rebalance", *partition_cols).write.mode("overwrite")
       .partitionBy(*partition_cols).parquet(path))
    return path


RETAIN_SECONDS = 3600


def snapshot_path(base: str, batch_id: int) -> str:
    return f"{base.rstrip('/')}/batch={batch_id}"


def _marker(base: str, batch_id: int) -> str:
    return f"{base.rstrip('/')}/_done/{batch_id}"


def read_snapshot(spark: SparkSession, base: str, batch_id: int) -> DataFrame:
    """The finished snapshot of ``batch_id``; an error if there is none."""
    if not files.exists(spark, _marker(base, batch_id)):
        raise RuntimeError(f"no finished snapshot of batch {batch_id} under {base}")
    return spark.read.parquet(snapshot_path(base, batch_id))


def upsert_snapshot(batch: DataFrame, batch_id: int, base: str, key_cols: Sequence[str],
                    order_cols: Sequence[str] = (), retain_seconds: int = RETAIN_SECONDS) -> None:
    """Merge one micro-batch into the keyed snapshot (last write wins).

    Between batches the later one wins.  Inside a batch the row with the
    greatest ``order_cols`` wins; without them a batch must hold one row per
    key, as an update-mode aggregation does.

    The micro-batch is consumed exactly once: its latest row per key is
    written to ``<base>/_delta/<n>`` and the merge reads that back.
    Referencing the batch twice would re-run upstream stateful operators
    inside one batch.
    """
    spark, root = batch.sparkSession, base.rstrip("/")
    keys, cols = list(key_cols), batch.columns
    values = [c for c in cols if c not in keys]
    prev = read_snapshot(spark, base, batch_id - 1) if batch_id > 0 else None
    delta_path = f"{root}/_delta/{batch_id}"
    latest = (latest_per_key(batch, keys, values, order_cols) if order_cols
              else batch.dropDuplicates(keys))
    latest.select(*cols).write.mode("overwrite").parquet(delta_path)
    latest = spark.read.parquet(delta_path)
    if prev is not None:
        kept = prev.select(*cols).join(latest.select(*keys), keys, "left_anti")
        latest = kept.unionByName(latest.select(*cols))
    files.delete(spark, _marker(base, batch_id))      # a replay: not finished until rewritten
    latest.select(*cols).write.mode("overwrite").parquet(snapshot_path(base, batch_id))
    files.touch(spark, _marker(base, batch_id))
    files.delete(spark, delta_path)
    _retire(spark, root, batch_id, retain_seconds)


def _retire(spark: SparkSession, root: str, batch_id: int, retain_seconds: int) -> None:
    """Remove snapshots that are neither the last two nor younger than the retention time."""
    cutoff = (time.time() - retain_seconds) * 1000
    for path, changed, _ in files.listing(spark, f"{root}/_done/*"):
        n = int(path.rsplit("/", 1)[1])
        if n < batch_id - 1 and changed <= cutoff:
            files.delete(spark, path)
            files.delete(spark, snapshot_path(root, n))


def latest_snapshot(spark: SparkSession, base: str) -> DataFrame:
    """The most recent finished snapshot under ``base``."""
    done = [int(path.rsplit("/", 1)[1])
            for path, _, _ in files.listing(spark, f"{base.rstrip('/')}/_done/*")]
    if not done:
        raise RuntimeError(f"no finished snapshot under {base}")
    return read_snapshot(spark, base, max(done))

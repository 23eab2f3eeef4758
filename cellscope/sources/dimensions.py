"""Dimension feeds read from folders of delimited files.

A dimension folder receives new files over time (profile edits, new cells).
Reading it yields, per key, the *last written* line: ordered by file
modification time, then path, then position inside the file.  An optional TTL
ignores files older than ``ttl_seconds`` (the reference expired dimension
state after one day).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.operators.joins import latest_per_key
from cellscope.session import scratch_path
from cellscope.sources.files import listing
from cellscope.sources.delimited import parse_region_cell_lenient, parse_users_lenient


def read_with_order(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with their write-order key columns."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_modification_time").alias("_mtime"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    # Row order inside a split is preserved by the text scan.
    return lines.withColumn("_pos", F.monotonically_increasing_id())


def apply_ttl(lines: DataFrame, ttl_seconds: int | None) -> DataFrame:
    if ttl_seconds is None:
        return lines
    cutoff = F.current_timestamp() - F.make_dt_interval(secs=F.lit(ttl_seconds))
    return lines.where(F.col("_mtime") >= cutoff)


_ORDER = ["_mtime", "_file", "_block", "_pos"]


def user_dimension(spark: SparkSession, path: str, ttl_seconds: int | None = None) -> DataFrame:
    """(imsi, gender, age), last write wins per imsi."""
    lines = apply_ttl(read_with_order(spark, path), ttl_seconds)
    parsed = parse_users_lenient(lines, tuple(_ORDER))
    return latest_per_key(parsed, ["imsi"], ["gender", "age"], _ORDER)


def cell_dimension(spark: SparkSession, path: str, ttl_seconds: int | None = None) -> DataFrame:
    """(laccell, region_id), last write wins per cell."""
    lines = apply_ttl(read_with_order(spark, path), ttl_seconds)
    parsed = parse_region_cell_lenient(lines, tuple(_ORDER))
    return latest_per_key(parsed, ["laccell"], ["region_id"], _ORDER)


_EMPTY = {"user_dimension": "imsi string, gender string, age int",
          "cell_dimension": "laccell string, region_id string"}


class DimensionSnapshot:
    """A dimension folder materialised once and reused until the folder changes.

    ``get()`` lists the folder (no data read) and rebuilds the latest-per-key
    view when a file was added, removed or rewritten in place (its path,
    modification time or length changed), or, with a TTL, when the oldest
    file in use has expired.  The snapshot is a table sorted on its key; Spark
    decides by its size in bytes whether a micro-batch join broadcasts it.
    """

    def __init__(self, spark: SparkSession, path: str, kind: str, key: str,
                 ttl_seconds: int | None = None, name: str = "dim"):
        self.spark, self.path, self.key = spark, path, key
        self.build = {"user": user_dimension, "cell": cell_dimension}[kind]
        self.ttl = ttl_seconds
        self.base = scratch_path(spark, name)
        self.version = 0
        self._seen: list[tuple[str, int, int]] | None = None
        self._df: DataFrame | None = None

    def _listing(self) -> list[tuple[str, int, int]]:
        """(path, modification time, length) of every file in use."""
        out = listing(self.spark, self.path, deep=True)
        if self.ttl is not None:
            cutoff = (time.time() - self.ttl) * 1000
            out = [f for f in out if f[1] >= cutoff]
        return out

    def get(self) -> DataFrame:
        seen = self._listing()
        if self._df is None or seen != self._seen:
            if seen:
                dim = self.build(self.spark, self.path, self.ttl)
            else:   # no feed yet: every lookup misses, signals go to rejects
                dim = self.spark.createDataFrame([], _EMPTY[self.build.__name__])
            self._df, self._seen = self._materialise(dim), seen
        return self._df

    def _materialise(self, dim: DataFrame) -> DataFrame:
        # Two slots, overwritten alternately: the slot being replaced holds the
        # version before the one in use, so storage stays bounded.
        self.version += 1
        path = f"{self.base}/slot={self.version % 2}"
        dim.repartition(self.key).sortWithinPartitions(self.key).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

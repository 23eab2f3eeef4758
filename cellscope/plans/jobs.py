"""Scheduled batch jobs: what a daily / hourly scheduler calls.

* :func:`daily_index_job`    -- extend the user bitmap index with the day's
  users (known ids kept) and overwrite the index table;
* :func:`daily_portrait_job` -- portrait bitmaps from the profiles and the
  index, overwritten as a whole (truncate-then-load semantics);
* :func:`hourly_stay_job`    -- one hour folder of signals (``dt=/hh=``,
  pruned at the scan) -> stay containers by *event* hour.  Late signals land in
  an earlier event hour, so each source hour is a part of its own: a run
  publishes a new version of its source hour alone (re-runs are idempotent,
  late rows never overwrite the rows an earlier run wrote) and
  :func:`read_hourly_stay` OR-merges source hours.

Hourly runs publish by one commit record (:mod:`cellscope.operators.manifest`): a
run that dies leaves the version before it readable.  Every job reads its
inputs from tables/folders and can simply be re-run after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope.functions import containers
from cellscope.operators import portrait, stay
from cellscope.operators.index import build_user_index, extend_user_index
from cellscope.operators.manifest import read_versions, write_version
from cellscope.operators.sinks import write_table
from cellscope.schemas import SIGNAL
from cellscope.sources.delimited import SEP

SIGNAL_FOLDERS = T.StructType(SIGNAL.fields + [T.StructField("dt", T.StringType()),
                                               T.StructField("hh", T.StringType())])


def daily_index_job(spark: SparkSession, users: DataFrame, index_path: str,
                    new_index_path: str, first_run: bool = False,
                    locality: DataFrame | None = None) -> DataFrame:
    """Write the next index version to ``new_index_path`` and return it.

    A new folder per version (not an in-place overwrite of the table being
    read) keeps the job re-runnable: the previous version stays intact until
    the caller switches to the new one.  Ids of an earlier version are kept; a
    dense index from scratch is built only with ``first_run``, because it
    would shift every id and make older bitmaps wrong.  ``locality`` (imsi,
    group), e.g. :func:`cellscope.operators.index.home_regions`, places users
    who are seen together next to each other.
    """
    if first_run:
        index = build_user_index(users, locality=locality)
    else:
        index = extend_user_index(spark.read.parquet(index_path), users, locality=locality)
    write_table(index, new_index_path, sort_cols=["imsi"])
    return spark.read.parquet(new_index_path)


def daily_portrait_job(spark: SparkSession, user_info: DataFrame, index: DataFrame,
                       out_path: str) -> DataFrame:
    write_table(portrait.portrait_bitmaps(user_info, index), out_path,
                sort_cols=["portrait_id", "bucket"])
    return spark.read.parquet(out_path)


def hourly_stay_job(spark: SparkSession, signals_root: str, source_hour: str,
                    region_cell: DataFrame, index: DataFrame, out_path: str,
                    fmt: str = "parquet") -> None:
    """Stay bitmaps of one hour folder of signals (``yyyyMMddHH``).

    ``signals_root`` is partitioned as ``dt=yyyyMMdd/hh=HH``; the filter on
    the folder hour prunes every other folder before a file is opened.
    ``fmt``: ``parquet``, or ``delimited`` for the feed's ``|``-separated text.
    """
    reader = spark.read.schema(SIGNAL_FOLDERS)
    if fmt == "delimited":
        reader = reader.option("sep", SEP).option("header", "false").format("csv")
    signals = (reader.load(signals_root)
               .where((F.col("dt") == source_hour[:8]) & (F.col("hh") == source_hour[8:])))
    bitmaps = stay.region_hour_stay(signals, region_cell, index).hint("rebalance", "produce_hour")
    write_version(bitmaps.sortWithinPartitions("produce_hour", "region_id", "bucket"), out_path, source_hour,
                  ["produce_hour"])


def read_hourly_stay(spark: SparkSession, path: str) -> DataFrame:
    """The hourly job's table as (region_id, produce_hour, bucket, container),
    source hours OR-merged."""
    table = read_versions(spark, path, stay.STAY_TABLE)
    return containers.merge(table, stay.STAY_KEYS)

"""Who stayed in which region at which hour.

Plan (per run, e.g. one hour or one day of signals):

1. project signals to (imsi, laccell, hour) -- the scan reads 3 columns;
2. LEFT JOIN the cell map (checked broadcast; an unmatched cell keeps a NULL
   region, a cell in two regions fans out);
3. DISTINCT (imsi, region, hour) -- partial aggregation map-side collapses the
   many signals a phone emits per hour, so a hot imsi shrinks to at most
   #regions x #hours rows before any shuffle on imsi;
4. LEFT JOIN the user index on imsi (shuffle join, AQE skew split);
5. one adaptive container per (region, hour, bucket), built reduce-side: a
   region-hour holds few users per 32768-id bucket, so the compact rows are
   shuffled instead of 4 KiB partial bitmaps and stored as a short list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope.functions import bitmap, containers
from cellscope.functions.scalar import hour_bucket

STAY_KEYS = ["region_id", "produce_hour"]

# Stored layout of the hourly table (produce_hour is the folder partition).
STAY_TABLE = T.StructType([
    T.StructField("region_id", T.StringType()),
    T.StructField("bucket", T.LongType()),
    *containers.CONTAINER_FIELDS,
    T.StructField("produce_hour", T.StringType()),
])


def read_stay_table(spark: SparkSession, path: str) -> DataFrame:
    """The hourly stay table with its declared schema.

    Declaring the schema keeps ``produce_hour`` a string (no partition type
    inference) so an hour filter prunes folders directly.
    """
    return spark.read.schema(STAY_TABLE).parquet(path)


def stay_rows(signals: DataFrame, region_cell: DataFrame, user_index: DataFrame) -> DataFrame:
    """Distinct (region_id, produce_hour, bitmap_id) visits; ids may be NULL."""
    cells = region_cell.select("laccell", "region_id")
    visits = (signals.select("imsi", "laccell",
                             hour_bucket("procedureStartTime").alias("produce_hour"))
                     .join(cells, "laccell", "left")
                     .select("imsi", "region_id", "produce_hour")
                     .distinct())
    index = user_index.select("imsi", "bitmap_id")
    # Visits of users without an id collapse to one row per (region, hour) in
    # their own task, before anything is dealt by region and hour.
    return (visits.join(index, "imsi", "left")
                  .select("region_id", "produce_hour", "bitmap_id").distinct())


def region_hour_stay(signals: DataFrame, region_cell: DataFrame,
                     user_index: DataFrame) -> DataFrame:
    """(region_id, produce_hour, bucket, container) -- the stay table."""
    return containers.build(stay_rows(signals, region_cell, user_index), STAY_KEYS, "bitmap_id")


def stay_id_sets(signals: DataFrame, region_cell: DataFrame,
                 user_index: DataFrame) -> DataFrame:
    """(region_id, produce_hour, bucket, bitmap_ids) -- id-array form."""
    return bitmap.id_sets(stay_rows(signals, region_cell, user_index), STAY_KEYS)


def stay_user_count(stay_bitmaps: DataFrame) -> DataFrame:
    """(region_id, produce_hour, user_count) from the stay table."""
    return containers.cardinality(stay_bitmaps, STAY_KEYS)


def rollup_day(stay_bitmaps: DataFrame) -> DataFrame:
    """Hours OR-merged into days: (region_id, produce_day, bucket, container)."""
    day = stay_bitmaps.withColumn("produce_day", F.substring("produce_hour", 1, 8))
    return containers.merge(day, ["region_id", "produce_day"])

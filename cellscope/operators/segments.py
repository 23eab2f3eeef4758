"""Segment queries: users of portrait P who stayed in region R at hour H.

Single triple (the lookup service): both bitmap tables are filtered by the
parameters (pushed into the Parquet scan / partition pruning on the hour),
then AND-ed bucket by bucket, whatever kinds of container meet.  A missing region-hour or
portrait yields a count of 0 / no users, duplicate region-hour rows are OR-merged first.

All triples (``segment_matrix``): a join of visit rows with portrait rows on
the id, a balanced shuffle without any bitmap; counts from a partial
aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.functions import bitmap, containers

SALTS = 16


def _segment_sides(stay_bitmaps: DataFrame, portrait_bitmaps: DataFrame, region_id: str,
                   produce_hour: str, portrait_id: int) -> tuple[DataFrame, DataFrame]:
    stay = stay_bitmaps.where((F.col("region_id") == F.lit(region_id))
                              & (F.col("produce_hour") == F.lit(produce_hour)))
    port = portrait_bitmaps.where(F.col("portrait_id") == F.lit(int(portrait_id)))
    return stay, port


def segment_bitmap(stay_bitmaps: DataFrame, portrait_bitmaps: DataFrame, region_id: str,
                   produce_hour: str, portrait_id: int) -> DataFrame:
    """(bucket, container) of the intersection."""
    stay, port = _segment_sides(stay_bitmaps, portrait_bitmaps, region_id,
                                produce_hour, portrait_id)
    return containers.intersect(stay, port)


def segment_count(stay_bitmaps: DataFrame, portrait_bitmaps: DataFrame, region_id: str,
                  produce_hour: str, portrait_id: int) -> DataFrame:
    """Exactly one row: cnt (0 when any side is missing)."""
    seg = segment_bitmap(stay_bitmaps, portrait_bitmaps, region_id, produce_hour, portrait_id)
    return seg.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("cnt"))


def segment_users(stay_bitmaps: DataFrame, portrait_bitmaps: DataFrame, region_id: str,
                  produce_hour: str, portrait_id: int) -> DataFrame:
    """One row per user id of the segment (ascending order within each bucket)."""
    seg = segment_bitmap(stay_bitmaps, portrait_bitmaps, region_id, produce_hour, portrait_id)
    return containers.decode(seg, [], id_col="bitmap_id")


def segment_counts(requests: DataFrame, stay_bitmaps: DataFrame, portrait_bitmaps: DataFrame) -> DataFrame:
    """One row per distinct request (region_id, produce_hour, portrait_id) with cnt, 0 for a miss.

    All requests are answered by one job.  The requests' hours prune the hour folders of a
    stored stay table while it is scanned (dynamic partition pruning), their regions and
    portraits filter the rows before the join; the containers are AND-ed bucket by bucket.
    Nulls in a request match nothing.
    """
    keys = ["region_id", "produce_hour"]
    wanted = requests.select(*keys, F.col("portrait_id").cast("int").alias("portrait_id")).distinct()
    # Asked for once each: a region-hour's containers aren't copied for every portrait.
    stay = stay_bitmaps.where(F.col("bucket").isNotNull()).join(wanted.select(*keys).distinct(), keys, "left_semi")
    port = portrait_bitmaps.where(F.col("bucket").isNotNull()).join(
        wanted.select("portrait_id").distinct(), "portrait_id", "left_semi")
    stay = containers.prefixed(containers.merge(stay, keys), "_s").join(wanted, keys)
    port = containers.prefixed(containers.merge(port, ["portrait_id"]), "_p")
    counts = (stay.join(port, ["portrait_id", "bucket"])
                  .select(*keys, "portrait_id", F.size(containers.common("_s", "_p")).alias("_n"))
                  .groupBy(*keys, "portrait_id").agg(F.sum("_n").cast("long").alias("cnt")))
    asked, got = wanted.alias("w"), counts.alias("c")
    same = [F.col(f"w.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "portrait_id"]]
    return asked.join(got, same[0] & same[1] & same[2], "left").select(
        *[F.col(f"w.{k}") for k in [*keys, "portrait_id"]], F.coalesce("c.cnt", F.lit(0)).cast("long").alias("cnt"))


def segment_matrix(stay_rows: DataFrame, portrait_rows: DataFrame) -> DataFrame:
    """(region_id, produce_hour, portrait_id, user_count) for every non-empty triple.

    From visit rows (region_id, produce_hour, bitmap_id) and portrait rows
    (portrait_id, bitmap_id), both distinct: before any bitmap is built, so
    nothing is decoded.  A user is in two portraits at most.
    """
    stay = stay_rows.select("region_id", "produce_hour", "bitmap_id").where(
        F.col("bitmap_id").isNotNull())
    return (stay.join(portrait_rows.select("portrait_id", "bitmap_id"), "bitmap_id")
                .groupBy("region_id", "produce_hour", "portrait_id")
                .agg(F.count(F.lit(1)).alias("user_count")))


def segment_matrix_and(stay_bitmaps: DataFrame, portrait_bitmaps: DataFrame) -> DataFrame:
    """Same result as :func:`segment_matrix` from the stored containers.

    Every stay row meets the (at most five) portrait rows of its bucket; they are copied over
    SALTS sub-keys, so a bucket with most of the users isn't one task's work.  The AND is a
    projection of the joined row; only counts are aggregated.
    """
    stay = stay_bitmaps.where(F.col("bucket").isNotNull())
    stay = containers.merge(stay, ["region_id", "produce_hour"]).withColumn(
        "_salt", F.pmod(F.xxhash64("region_id", "produce_hour"), F.lit(SALTS)))
    port = containers.merge(portrait_bitmaps.where(F.col("bucket").isNotNull()), ["portrait_id"]).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    both = containers.prefixed(stay, "_s").join(containers.prefixed(port, "_p"), ["bucket", "_salt"])
    counts = (both.select("region_id", "produce_hour", "portrait_id", F.size(containers.common("_s", "_p")).alias("_n"))
                  .groupBy("region_id", "produce_hour", "portrait_id")
                  .agg(F.sum("_n").cast("long").alias("user_count")))
    return counts.where(F.col("user_count") > 0)


def users_json(segment_user_rows: DataFrame) -> DataFrame:
    """``{"users":[...]}`` documents, one per 32768-id chunk (bounded size); a segment
    without users gives one document with an empty list (bucket NULL)."""
    chunked = segment_user_rows.withColumn("bucket", bitmap.bucket_of("bitmap_id"))
    docs = (chunked.groupBy("bucket")
                   .agg(F.to_json(F.struct(F.sort_array(F.collect_list("bitmap_id"))
                                            .alias("users"))).alias("doc")))
    # One row for the segment itself; it stands alone when no chunk is there.
    one = docs.agg(F.count(F.lit(1)).alias("_n")).where("_n = 0")
    empty = one.select(F.lit(None).cast("long").alias("bucket"), F.lit('{"users":[]}').alias("doc"))
    return docs.unionByName(empty)


def count_json(count_row: DataFrame) -> DataFrame:
    """``{"cnt":n}``."""
    return count_row.select(F.to_json(F.struct("cnt")).alias("doc"))

"""User bitmap index: every distinct imsi gets a small integer id.

Default ids are dense and deterministic: the position of the imsi in byte
order (``row_number() OVER (ORDER BY imsi) - 1``), computed by range
partitioning rather than a single-partition window.  Ids must fit the store's
unsigned 32-bit bitmap values; a larger id fails the job instead of wrapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.operators.ordered import unique_row_ids, with_row_index

MAX_BITMAP_ID = (1 << 32) - 1


def _checked(id_col: str) -> F.Column:
    c = F.col(id_col)
    return F.when(c > MAX_BITMAP_ID,
                  F.raise_error(F.lit("bitmap id exceeds unsigned 32-bit range"))).otherwise(c)


def build_user_index(users: DataFrame, imsi_col: str = "imsi",
                     num_partitions: int | None = None,
                     locality: DataFrame | None = None) -> DataFrame:
    """(imsi, bitmap_id) for the distinct, non-empty imsis of ``users``.

    Default order: imsi bytes.  With ``locality`` (imsi, group), ids are
    assigned in (group, imsi) order, so users who tend to be seen together
    (e.g. one home region, see :func:`home_regions`) get neighbouring ids and
    share 32768-id bitmap buckets; users without a group come first.
    """
    distinct = (users.select(F.col(imsi_col).alias("imsi"))
                     .where(F.col("imsi").isNotNull() & (F.col("imsi") != ""))
                     .distinct())
    distinct, order = _in_groups(distinct, locality)
    indexed = with_row_index(distinct, order, "bitmap_id", num_partitions)
    return indexed.select("imsi", _checked("bitmap_id").alias("bitmap_id"))


def _in_groups(users: DataFrame, locality: DataFrame | None) -> tuple[DataFrame, list[str]]:
    if locality is None:
        return users, ["imsi"]
    group = locality.select("imsi", F.col(locality.columns[1]).alias("_group"))
    return users.join(group, "imsi", "left"), ["_group", "imsi"]


def home_regions(signals: DataFrame, region_cell: DataFrame) -> DataFrame:
    """(imsi, home_region): the region where a user emits most signals.

    Two partial aggregations (per user and region, then per user), so even a
    user holding a third of all signals costs one row per region visited.
    Ties go to the smallest region id.
    """
    cells = region_cell.select("laccell", "region_id")
    per_region = (signals.select("imsi", "laccell").join(cells, "laccell")
                         .groupBy("imsi", "region_id").agg(F.count(F.lit(1)).alias("_n")))
    return (per_region.groupBy("imsi")
                      .agg(F.min_by("region_id", F.struct(-F.col("_n"), F.col("region_id")))
                           .alias("home_region")))


def extend_user_index(existing: DataFrame, users: DataFrame, imsi_col: str = "imsi",
                      num_partitions: int | None = None,
                      locality: DataFrame | None = None) -> DataFrame:
    """Stable daily index: known users keep their id, new users get dense ids
    after the current maximum (in imsi byte order, or in (group, imsi) order
    with ``locality``).

    A full rebuild would shift every id after a newly inserted imsi, so
    bitmaps built on different days would no longer be comparable.
    Re-running with the same inputs yields the same index.
    """
    known = existing.select("imsi", "bitmap_id")
    # One scalar (the next free id) comes back to the driver.
    start = known.agg(F.coalesce(F.max("bitmap_id") + 1, F.lit(0))).first()[0]
    fresh = (users.select(F.col(imsi_col).alias("imsi"))
                  .where(F.col("imsi").isNotNull() & (F.col("imsi") != ""))
                  .distinct()
                  .join(known.select("imsi"), "imsi", "left_anti"))
    fresh, order = _in_groups(fresh, locality)
    numbered = with_row_index(fresh, order, "_pos", num_partitions)
    added = numbered.select("imsi", _checked_expr(F.lit(start) + F.col("_pos"))
                            .alias("bitmap_id"))
    return known.unionByName(added)


def _checked_expr(c: F.Column) -> F.Column:
    return F.when(c > MAX_BITMAP_ID,
                  F.raise_error(F.lit("bitmap id exceeds unsigned 32-bit range"))).otherwise(c)


def unique_id_index(users: DataFrame, imsi_col: str = "imsi") -> DataFrame:
    """Parity form of the original job: one id per input line, k*n+i layout."""
    ids = unique_row_ids(users.select(F.col(imsi_col).alias("imsi")), "bitmap_id")
    return ids.select("imsi", _checked("bitmap_id").alias("bitmap_id"))

"""Bucketed bitmaps over Spark's built-in bitmap aggregates.

A user set is stored in *long form*: one row per (key..., bucket) holding a
fixed 4 KiB bitmap of 32768 bits (``bitmap_construct_agg``).  Ids are encoded
as ``id + 1`` so that id 0 is representable and every id maps to exactly one
(bucket, position):

    bucket = bitmap_bucket_number(id + 1)   -> id // 32768 + 1
    pos    = bitmap_bit_position(id + 1)    -> id %  32768
    id     = (bucket - 1) * 32768 + pos

Because a bitmap row never spans buckets, every set operation groups by
bucket; a group's state is bounded (4 KiB) however many users it holds, and a
hot key is spread over ``users / 32768`` independent rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS_PER_BUCKET = 32768
BYTES_PER_BUCKET = BITS_PER_BUCKET // 8


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bucket_of(id_col: Column | str) -> Column:
    return F.bitmap_bucket_number(_checked_id(id_col) + 1)


def position_of(id_col: Column | str) -> Column:
    return F.bitmap_bit_position(_checked_id(id_col) + 1)


def id_of(bucket: Column | str, pos: Column | str) -> Column:
    return (_c(bucket) - 1) * BITS_PER_BUCKET + _c(pos)


def _checked_id(id_col: Column | str) -> Column:
    c = _c(id_col).cast("long")
    return F.when(c < 0, F.raise_error(F.lit("bitmap ids must be >= 0"))).otherwise(c)


def build(df: DataFrame, keys: Sequence[str], id_col: str = "bitmap_id",
          bitmap_col: str = "bitmap", sparse: bool = False) -> DataFrame:
    """GROUP BY keys -> set of ids, as (keys..., bucket, bitmap).

    NULL ids are skipped; a group whose ids are all NULL keeps one row with
    bucket NULL and an empty bitmap, so the group survives with cardinality 0.
    Duplicates collapse.

    ``sparse=False`` (dense sets, e.g. portraits): partial bitmaps are built
    map-side, so up to 32768 ids leave a task as one 4 KiB row.
    ``sparse=True`` (few ids per key and bucket, e.g. one region-hour): a map-
    side partial bitmap would turn a handful of ids into 4 KiB per task, so
    the compact (key, bucket, pos) rows are shuffled on the group key first
    and the bitmaps are built once, reduce-side (the aggregation then needs
    no exchange of its own).
    """
    keys = list(keys)
    rows = df.select(*keys, bucket_of(id_col).alias("bucket"),
                     position_of(id_col).alias("pos"))
    if sparse:
        rows = rows.repartition(*keys, "bucket")
    return (rows.groupBy(*keys, "bucket")
                .agg(F.bitmap_construct_agg("pos").alias(bitmap_col)))


def merge(df: DataFrame, keys: Sequence[str], bitmap_col: str = "bitmap") -> DataFrame:
    """OR-merge partial bitmaps of the same (keys, bucket), e.g. hours -> day."""
    return (df.groupBy(*keys, "bucket")
              .agg(F.bitmap_or_agg(bitmap_col).alias(bitmap_col)))


def cardinality(df: DataFrame, keys: Sequence[str], bitmap_col: str = "bitmap",
                out: str = "user_count") -> DataFrame:
    """Number of ids per key (sum over buckets)."""
    return (df.groupBy(*keys)
              .agg(F.coalesce(F.sum(F.bitmap_count(bitmap_col)), F.lit(0))
                   .cast("long").alias(out)))


def intersect(left: DataFrame, right: DataFrame, keys: Sequence[str] = (),
              bitmap_col: str = "bitmap") -> DataFrame:
    """Bucket-wise AND of two bitmap sets sharing ``keys``.

    Each side is first OR-merged per (keys, bucket) so duplicate rows cannot
    drop or double a bucket; then both are unioned and AND-aggregated, keeping
    only buckets present on both sides.
    """
    keys = list(keys)
    sides = []
    for tag, side in ((0, left), (1, right)):
        sides.append(merge(side.select(*keys, "bucket", bitmap_col)
                               .where(F.col("bucket").isNotNull()), keys, bitmap_col)
                     .withColumn("_side", F.lit(tag)))
    both = sides[0].unionByName(sides[1])
    return (both.groupBy(*keys, "bucket")
                .agg(F.bitmap_and_agg(bitmap_col).alias(bitmap_col),
                     F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") == 2)
                .drop("_n"))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def bitmap_positions(bitmaps: pd.Series) -> pd.Series:
    """Set bit positions (ascending) of each bitmap; vectorised over the batch.

    Only non-zero bytes are unpacked, so memory follows the number of set
    bits rather than 32768 per row.
    """
    n = len(bitmaps)
    out = np.empty(n, dtype=object)
    out[:] = [np.empty(0, dtype=np.int32)] * n
    idx = np.flatnonzero(bitmaps.notna().to_numpy())
    if len(idx):
        buf = np.frombuffer(b"".join(bytes(b) for b in bitmaps.iloc[idx]), dtype=np.uint8)
        grid = buf.reshape(len(idx), buf.size // len(idx))
        rows, cols = np.nonzero(grid)                    # non-zero bytes, row-major
        bits = np.unpackbits(grid[rows, cols][:, None], axis=1, bitorder="little")
        hit_byte, hit_bit = np.nonzero(bits)
        pos = (cols[hit_byte] * 8 + hit_bit).astype(np.int32)
        owner = rows[hit_byte]
        cuts = np.searchsorted(owner, np.arange(1, len(idx)))
        for j, part in zip(idx, np.split(pos, cuts)):
            out[j] = part
    return pd.Series(out)


def decode(df: DataFrame, keys: Sequence[str], bitmap_col: str = "bitmap",
           id_col: str = "bitmap_id") -> DataFrame:
    """Long-form bitmaps -> one row per (keys..., id)."""
    return (df.where(F.col("bucket").isNotNull())
              .select(*keys, "bucket", F.explode(bitmap_positions(bitmap_col)).alias("pos"))
              .select(*keys, id_of("bucket", "pos").alias(id_col)))


def from_ids(df: DataFrame, keys: Sequence[str], ids_col: str,
             bitmap_col: str = "bitmap") -> DataFrame:
    """Id arrays -> bitmaps (explode, then the same bucketed build)."""
    exploded = df.select(*keys, F.explode_outer(ids_col).alias("_id"))
    return build(exploded, keys, "_id", bitmap_col)


def id_sets(df: DataFrame, keys: Sequence[str], id_col: str = "bitmap_id",
            out: str = "bitmap_ids") -> DataFrame:
    """Distinct ids per key as sorted arrays, chunked per bucket of 32768 ids.

    Chunking keeps every array bounded; a key's full set is the union of its
    chunks.  NULL ids are skipped (an all-NULL group yields an empty array).
    """
    keys = list(keys)
    return (df.select(*keys, F.col(id_col).cast("long").alias("_id"))
              .withColumn("bucket", F.when(F.col("_id").isNotNull(), bucket_of("_id")))
              .groupBy(*keys, "bucket")
              .agg(F.sort_array(F.collect_set("_id")).alias(out)))

"""Portrait bitmaps: which users are male / female / in an age band.

One scan of the profile table: each indexed user of age >= 10 yields two
portrait rows (gender, age band) through an ``explode`` of a 2-element array,
then a single bucketed bitmap aggregation.  The five portrait groups are the
most skewed keys in the system (every user is in two of them); bucketing
splits each into ``users / 32768`` bounded rows and the partial aggregation
runs map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.functions import bitmap, containers
from cellscope.functions.scalar import (age_band, age_portrait_comment, age_portrait_id,
                                        gender_portrait_comment, gender_portrait_id)
from cellscope.schemas import MIN_PORTRAIT_AGE

PORTRAIT_KEYS = ["portrait_id", "portrait_value", "comment"]


def _profiles(user_info: DataFrame, user_index: DataFrame) -> DataFrame:
    adults = (user_info.where(F.col("age") >= MIN_PORTRAIT_AGE)
                       .select("imsi", "gender", age_band("age").alias("age_flag")))
    return adults.join(user_index.select("imsi", "bitmap_id"), "imsi", "inner")


def portrait_rows(user_info: DataFrame, user_index: DataFrame,
                  keep_unknown: bool = False) -> DataFrame:
    """(portrait_id, portrait_value, comment, bitmap_id), two rows per user.

    A gender outside the catalogue has no portrait id; such rows are dropped
    unless ``keep_unknown`` (see :func:`portrait_rejects`).
    """
    g = F.col("gender")
    a = F.col("age_flag")
    pairs = F.array(
        F.struct(gender_portrait_id(g).alias("portrait_id"), g.alias("portrait_value"),
                 gender_portrait_comment(g).alias("comment")),
        F.struct(age_portrait_id(a).alias("portrait_id"), a.alias("portrait_value"),
                 age_portrait_comment(a).alias("comment")))
    rows = (_profiles(user_info, user_index)
            .select("bitmap_id", F.inline(pairs)))
    if not keep_unknown:
        rows = rows.where(F.col("portrait_id").isNotNull())
    return rows.select(*PORTRAIT_KEYS, "bitmap_id")


def portrait_rejects(user_info: DataFrame, user_index: DataFrame) -> DataFrame:
    """Indexed adult users whose gender has no portrait."""
    return (portrait_rows(user_info, user_index, keep_unknown=True)
            .where(F.col("portrait_id").isNull()))


def portrait_bitmaps(user_info: DataFrame, user_index: DataFrame) -> DataFrame:
    """(portrait_id, portrait_value, comment, bucket, container)."""
    return containers.build(portrait_rows(user_info, user_index), PORTRAIT_KEYS, "bitmap_id", sparse=False)


def portrait_id_sets(user_info: DataFrame, user_index: DataFrame) -> DataFrame:
    """(portrait_id, portrait_value, comment, bucket, bitmap_ids)."""
    return bitmap.id_sets(portrait_rows(user_info, user_index), PORTRAIT_KEYS)


def portrait_union(user_info: DataFrame, user_index: DataFrame) -> DataFrame:
    """The two-branch form: gender aggregation UNION age aggregation.

    Each branch aggregates on its own key and the results are combined with a
    set union over scalar columns (the branches cannot overlap: ids 1-2 vs
    3-5).  Output: portrait key columns + user_count.
    """
    prof = _profiles(user_info, user_index)
    g, a = F.col("gender"), F.col("age_flag")
    gender = (prof.select(gender_portrait_id(g).alias("portrait_id"),
                          g.alias("portrait_value"),
                          gender_portrait_comment(g).alias("comment"), "bitmap_id"))
    age = (prof.select(age_portrait_id(a).alias("portrait_id"), a.alias("portrait_value"),
                       age_portrait_comment(a).alias("comment"), "bitmap_id"))
    branches = [bitmap.cardinality(bitmap.build(b.where(F.col("portrait_id").isNotNull()),
                                                PORTRAIT_KEYS), PORTRAIT_KEYS)
                for b in (gender, age)]
    return branches[0].unionByName(branches[1]).distinct()

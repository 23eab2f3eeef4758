"""Join helper: last-write-wins dimensions.

Dimension joins carry no hint: Spark broadcasts a side whose measured bytes are
below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.operators.ordered import last_tagged, range_tagged


def asof_join(rows: DataFrame, versions: DataFrame, key_cols: Sequence[str], time_col: str,
              value_cols: Sequence[str], valid_from: str = "valid_from",
              num_partitions: int | None = None) -> DataFrame:
    """LEFT as-of join: each row with the values of its key's latest version that is valid at
    the row's time (``valid_from`` <= time), nulls before the first.

    Rows and versions are merged into one order (key, time, versions first), range-partitioned
    on the whole of it, and scanned with carries: no window holds a key, so a cell with a third
    of all signals is many partitions' work.  Versions of equal key and time: the greatest by
    the values' order.  Rows without a key or time get nulls; versions without are left out.
    """
    keys, vals = list(key_cols), list(value_cols)
    tagged_rows = rows.select(F.struct("*").alias("_row"), *keys, F.col(time_col).alias("_at"))
    known = versions.where(F.col(valid_from).isNotNull())
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    version = known.select(F.lit(None).cast(tagged_rows.schema["_row"].dataType).alias("_row"), *keys,
                           F.col(valid_from).alias("_at"), F.struct(*vals).alias("_version"), F.lit(True).alias("_is_version"))
    none = F.lit(None).cast(version.schema["_version"].dataType)
    merged = tagged_rows.select("*", none.alias("_version"), F.lit(False).alias("_is_version")).unionByName(version)
    merged = merged.withColumn("_kind", F.when(F.col("_is_version"), 0).otherwise(1))
    # The rows' own order last, so that a hot (key, time) is cut as well.
    merged = merged.withColumn("_tie", F.when(F.col("_kind") == 1, F.xxhash64(F.to_json("_row"))))
    tagged = range_tagged(merged, [*keys, "_at", "_kind", "_version", "_tie"], num_partitions)
    found = last_tagged(tagged, keys, "_is_version", ["_version"]).where(~F.col("_is_version"))
    usable = F.col("_at").isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    return found.select("_row.*", *[F.when(usable, F.col(f"last__version.{v}")).alias(v) for v in vals])


def latest_per_key(df: DataFrame, key_cols: Sequence[str], value_cols: Sequence[str],
                   order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the values of the row with the greatest ``order_cols``.

    Last-write-wins for a dimension fed by files: order by (file modification
    time, path, split start, line position).  Runs as a partial aggregation
    (``max_by``), so a key repeated a billion times costs one buffer per task.
    """
    vals = list(value_cols)
    order = F.struct(*order_cols)
    picked = (df.groupBy(*key_cols)
                .agg(F.max_by(F.struct(*vals), order).alias("_v")))
    return picked.select(*key_cols, *[F.col(f"_v.{v}").alias(v) for v in vals])

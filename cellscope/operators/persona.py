"""Region persona counters (batch twins of the streaming jobs) and lookups.

Counters per region: ``man`` (gender '1'), ``women`` (any other gender),
``age_10_20`` [10,20), ``age_20_40`` [20,40), ``age_40`` [40,inf).  Users under
10 count in a gender column only.  Window counters count *signals*; headcount
counters count enter (+1) / leave (-1) flows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope.functions.scalar import is_man
from cellscope.operators.ordered import lag_tagged, range_tagged, running_sums
from cellscope.schemas import PERSONA_COLUMNS

WINDOW = "1 minute"


def indicators(gender: Column | str = "gender", age: Column | str = "age") -> dict[str, Column]:
    g = F.col(gender) if isinstance(gender, str) else gender
    a = F.col(age) if isinstance(age, str) else age
    man = is_man(g)
    return {
        "man": man.cast("int"),
        "women": (~man).cast("int"),
        "age_10_20": ((a >= 10) & (a < 20)).cast("int"),
        "age_20_40": ((a >= 20) & (a < 40)).cast("int"),
        "age_40": (a >= 40).cast("int"),
    }


def enrich(signals: DataFrame, user_info: DataFrame, region_cell: DataFrame) -> DataFrame:
    """Signals with profile and region; signals of unknown users or cells drop.

    Cells come first: that map is small, and what it drops isn't shuffled to
    the users.

    Output: imsi, laccell, ts, event_id, procedureStartTime, region_id, gender, age.
    """
    cells = region_cell.select("laccell", "region_id")
    users = user_info.select("imsi", "gender", "age")
    return (signals.select("imsi", "laccell", "ts", "event_id", "procedureStartTime")
                   .join(cells, "laccell", "inner")
                   .join(users, "imsi", "inner")
                   .select("imsi", "laccell", "ts", "event_id", "procedureStartTime",
                           "region_id", "gender", "age"))


def enrich_rejects(signals: DataFrame, user_info: DataFrame, region_cell: DataFrame) -> DataFrame:
    """Signals that the enrichment drops, with the reason."""
    cells = region_cell.select("laccell", F.lit(1).alias("_cell"))
    users = user_info.select("imsi", F.lit(1).alias("_user"))
    j = (signals.select("imsi", "laccell", "ts", "event_id")
                .join(users, "imsi", "left").join(cells, "laccell", "left"))
    reason = (F.when(F.col("_user").isNull(), F.lit("unknown_user"))
               .when(F.col("_cell").isNull(), F.lit("unknown_cell")))
    return (j.withColumn("reason", reason).where(F.col("reason").isNotNull())
             .drop("_user", "_cell"))


def persona_window(enriched: DataFrame, window: str = WINDOW) -> DataFrame:
    """Signal counts per (region, tumbling event-time window)."""
    ind = indicators()
    return (enriched.groupBy("region_id", F.window("ts", window).alias("w"))
                    .agg(*[F.sum(c).cast("long").alias(n) for n, c in ind.items()])
                    .select("region_id", F.col("w.start").alias("window_start"),
                            F.col("w.end").alias("window_end"), *PERSONA_COLUMNS))


def persona_window_preagg(signals: DataFrame, user_info: DataFrame, region_cell: DataFrame,
                          window: str = WINDOW) -> DataFrame:
    """:func:`persona_window` computed straight from signals, counting first.

    A phone emits many signals per minute: counting them per (imsi, region,
    window) with a map-side partial aggregation means the join with a user
    table too large to broadcast shuffles one row per user-minute instead of
    one per signal.  The counters are then sums of per-user counts.
    """
    cells = region_cell.select("laccell", "region_id")
    per_user = (signals.select("imsi", "laccell", F.window("ts", window).alias("w"))
                       .join(cells, "laccell", "inner")
                       .groupBy("imsi", "region_id", "w")
                       .agg(F.count(F.lit(1)).alias("_n")))
    users = user_info.select("imsi", "gender", "age")
    ind = indicators()
    return (per_user.join(users, "imsi", "inner")
                    .groupBy("region_id", "w")
                    .agg(*[F.sum(c * F.col("_n")).cast("long").alias(n) for n, c in ind.items()])
                    .select("region_id", F.col("w.start").alias("window_start"),
                            F.col("w.end").alias("window_end"), *PERSONA_COLUMNS))


def persona_running(enriched: DataFrame, window: str = WINDOW,
                    num_partitions: int | None = None) -> DataFrame:
    """One row per signal with the counts so far in its (region, window)."""
    w = enriched.withColumn("window_start", F.window("ts", window).start)
    out = running_sums(w.select("region_id", "window_start", "ts", "event_id", "imsi",
                                "gender", "age"),
                       ["region_id", "window_start"], ["ts", "event_id"],
                       indicators(), num_partitions)
    return out.select("region_id", "window_start", "ts", "event_id", "imsi", *PERSONA_COLUMNS)


def region_flow(enriched: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Enter / leave flows per user, in (ts, event_id) order.

    A signal in a region different from the user's previous one emits
    ``is_in=1`` for the new region and, if there was a previous region,
    ``is_in=0`` for it.  The leave carries the profile recorded when the
    user entered the old region, so a profile edit cannot unbalance counters.
    """
    base = enriched.select("imsi", "ts", "event_id", "region_id", "gender", "age")
    tagged = range_tagged(base, ["imsi", "ts", "event_id"], num_partitions)
    prev = lag_tagged(tagged, ["imsi"], ["region_id"])
    changes = prev.where(F.col("prev_region_id").isNull()
                         | (F.col("prev_region_id") != F.col("region_id")))
    # Previous *change* of the same user = the region being left, with its
    # entry profile: over the same partitions, so without another exchange.
    entered = lag_tagged(changes.drop("prev_region_id"), ["imsi"],
                         ["region_id", "gender", "age"], prefix="left_")
    # One pass emits both rows of a change (enter, and leave when the user
    # was somewhere), so the upstream plan runs once.
    def flow(is_in: int, region: str, gender: str, age: str) -> Column:
        return F.struct(F.col("imsi").alias("imsi"), F.col("ts").alias("ts"),
                        F.col("event_id").alias("event_id"), F.lit(is_in).alias("is_in"),
                        F.col(region).alias("region_id"), F.col(gender).alias("gender"),
                        F.col(age).alias("age"))
    both = F.array(flow(1, "region_id", "gender", "age"),
                   flow(0, "left_region_id", "left_gender", "left_age"))
    return entered.select(F.inline(both)).where(F.col("region_id").isNotNull())


def signed_indicators(flows: DataFrame) -> dict[str, Column]:
    sign = F.when(F.col("is_in") == 1, F.lit(1)).otherwise(F.lit(-1))
    return {n: c * sign for n, c in indicators().items()}


def region_headcount(flows: DataFrame) -> DataFrame:
    """Net counters per region: sum of +1 (enter) / -1 (leave) per indicator."""
    return (flows.groupBy("region_id")
                 .agg(*[F.sum(c).cast("long").alias(n)
                        for n, c in signed_indicators(flows).items()]))


def persona_lookup(persona: DataFrame, region_id: str) -> DataFrame:
    """Point read of one region's counters (filter pushed to the scan)."""
    return persona.where(F.col("region_id") == F.lit(region_id))


def persona_lookup_json(persona: DataFrame, region_id: str) -> DataFrame:
    """Exactly one row ``(region_id, doc)``; ``{}`` when the region is unknown."""
    key = persona.sparkSession.createDataFrame([(region_id,)], "region_id string")
    found = key.join(persona_lookup(persona, region_id), "region_id", "left")
    # to_json drops NULL fields, so a missing region renders as {}.
    return persona_json(found)


def persona_cells(persona: DataFrame) -> DataFrame:
    """Wide counters -> (region_id, qualifier, value) with values as strings."""
    pairs = ", ".join(f"'{c}', CAST({c} AS STRING)" for c in PERSONA_COLUMNS)
    return persona.selectExpr("region_id",
                              f"stack({len(PERSONA_COLUMNS)}, {pairs}) AS (qualifier, value)")


def persona_from_cells(cells: DataFrame) -> DataFrame:
    """Inverse of :func:`persona_cells` (pivot with a fixed column list)."""
    return (cells.groupBy("region_id").pivot("qualifier", PERSONA_COLUMNS)
                 .agg(F.first("value")))


def persona_json(persona: DataFrame) -> DataFrame:
    """``{qualifier: value-string, ...}`` document per region."""
    return persona.select(
        "region_id",
        F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in PERSONA_COLUMNS]))
         .alias("doc"))


__all__ = [
    "enrich", "enrich_rejects", "persona_window", "persona_running", "region_flow",
    "region_headcount", "persona_lookup", "persona_cells", "persona_from_cells",
    "persona_json", "persona_lookup_json", "indicators",
]

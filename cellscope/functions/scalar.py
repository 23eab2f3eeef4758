"""Column helpers for the scalar functions the jobs use (all JVM built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellscope.schemas import PORTRAITS


def epoch_ms(ts: Column | str) -> Column:
    """Epoch milliseconds of a timestamp (NTZ values are taken as session-zone wall time)."""
    return F.unix_millis(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def hour_bucket(ms: Column | str) -> Column:
    """``yyyyMMddHH`` of an epoch-ms value in the session time zone.

    Same result as ``from_unixtime(ms/1000, 'yyyyMMddHH')`` (seconds truncated),
    without the double division.
    """
    c = F.col(ms) if isinstance(ms, str) else ms
    return F.date_format(F.timestamp_millis(c), "yyyyMMddHH")


def age_band(age: Column | str) -> Column:
    """Half-open age bands -> '10' / '20' / '40', NULL below 10."""
    a = F.col(age) if isinstance(age, str) else age
    return (F.when((a >= 10) & (a < 20), F.lit("10"))
            .when((a >= 20) & (a < 40), F.lit("20"))
            .when(a >= 40, F.lit("40")))


def _lookup(value: Column, pairs: list[tuple[str, object]]) -> Column:
    expr = None
    for k, v in pairs:
        expr = (F.when(value == k, F.lit(v)) if expr is None
                else expr.when(value == k, F.lit(v)))
    return expr


def gender_portrait_id(gender: Column) -> Column:
    return _lookup(gender, [(v, pid) for pid, v, _ in PORTRAITS[:2]]).cast("int")


def gender_portrait_comment(gender: Column) -> Column:
    return _lookup(gender, [(v, c) for _, v, c in PORTRAITS[:2]])


def age_portrait_id(flag: Column) -> Column:
    return _lookup(flag, [(v, pid) for pid, v, _ in PORTRAITS[2:]]).cast("int")


def age_portrait_comment(flag: Column) -> Column:
    return _lookup(flag, [(v, c) for _, v, c in PORTRAITS[2:]])


def is_man(gender: Column) -> Column:
    """Streaming persona rule: gender '1' is a man, any other value a woman."""
    return F.coalesce(gender == "1", F.lit(False))

"""Pipe-delimited text sources: typed scans, lenient / strict parsing, rejects.

The signalling feeds are ``|``-separated text without a header.  Three ways to
read them:

* typed scan (``read_*``): Spark's CSV reader with an explicit schema -- column
  pruning and filters reach the scan;
* lenient parse (``parse_*_lenient``): a line becomes a record when the fields
  the job needs exist and cast; other lines are skipped (and can be kept with
  :func:`rejects`);
* strict parse: any malformed line fails the job, whatever columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope.schemas import REGION_CELL, SIGNAL, USER_INFO

SEP = "|"


def to_lines(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows -> one ``value`` string per row, fields joined by ``|``."""
    return df.select(F.concat_ws(SEP, *[F.col(c).cast("string") for c in cols]).alias("value"))


def write_lines(df: DataFrame, path: str, cols: list[str] | None = None,
                mode: str = "overwrite") -> str:
    """Write rows (or an existing ``value`` column) as pipe-delimited text."""
    lines = df if cols is None else to_lines(df, cols)
    lines.write.mode(mode).text(path)
    return path


def read_delimited(spark: SparkSession, path: str, schema: T.StructType,
                   mode: str = "PERMISSIVE") -> DataFrame:
    """Typed scan of ``|``-separated text with a fixed schema (never inferred)."""
    reader = spark.read.option("sep", SEP).option("header", "false").option("mode", mode)
    return reader.schema(schema).csv(path)


def read_signals(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    return read_delimited(spark, path, SIGNAL, mode)


def read_region_cell(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    return read_delimited(spark, path, REGION_CELL, mode)


def read_user_info(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    return read_delimited(spark, path, USER_INFO, mode)


def read_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Malformed lines (bad number, too few or too many fields) fail the job.

    The check is a filter over whole lines, so it runs whatever columns are
    read afterwards: a one-column select and ``count()`` fail too (a typed
    ``FAILFAST`` scan would only look at the columns that are kept).
    """
    f = _fields()
    fields = [F.when(F.get(f, i) != "", F.get(f, i)).cast(x.dataType).alias(x.name)
              for i, x in enumerate(schema.fields)]
    return _or_fail(read_lines(spark, path), line_is_valid(schema)).select(*fields)


def _or_fail(lines: DataFrame, valid: Column) -> DataFrame:
    """The lines, or an error at the first that isn't valid."""
    failed = F.raise_error(F.concat(F.lit("malformed line: "), F.col("value"))).cast("boolean")
    return lines.where(F.when(_held(valid), F.lit(True)).otherwise(failed))


def _held(valid: Column) -> Column:
    return F.coalesce(valid, F.lit(False))


def line_is_valid(schema: T.StructType, value: Column | str = "value") -> Column:
    """True when a line has exactly the schema's fields and each one casts."""
    f = _fields(value)
    ok = F.size(f) == len(schema.fields)
    for i, field in enumerate(schema.fields):
        if not isinstance(field.dataType, T.StringType):
            raw = F.get(f, i)
            ok = ok & (raw.isNull() | (raw == "") | raw.try_cast(field.dataType).isNotNull())
    return ok


# One validity expression for each parse: a parse keeps the lines for which it holds,
# its rejects are all others, so no line is in neither or in both.

def signal_pair_is_valid() -> Column:
    """At least (imsi, laccell)."""
    return F.size(_fields()) >= 2


def signal_is_valid() -> Column:
    """Exactly five fields, coordinates and time well typed and present."""
    f = _fields()
    return ((F.size(f) == 5) & F.get(f, 2).try_cast("double").isNotNull()
            & F.get(f, 3).try_cast("double").isNotNull() & F.get(f, 4).try_cast("long").isNotNull())


def user_is_valid() -> Column:
    """At least three fields, the third an integer age of 0 or more."""
    return F.get(_fields(), 2).try_cast("int") >= 0


def cell_is_valid() -> Column:
    """At least (region_id, laccell)."""
    return F.size(_fields()) >= 2


def rejects(lines: DataFrame, valid: Column) -> DataFrame:
    """The lines, as (line), that the parse with this validity leaves out.

    Works on batch and streaming ``value`` columns alike.
    """
    return lines.where(~_held(valid)).select(F.col("value").alias("line"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text lines as ``value``."""
    return spark.read.text(path)


def _fields(value: Column | str = "value") -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.split(v, r"\|", -1)


def first_field(lines: DataFrame, out: str = "imsi") -> DataFrame:
    """``split(line, '|')[0]`` per line."""
    return lines.select(F.get(_fields(), 0).alias(out))


def parse_signals_lenient(lines: DataFrame) -> DataFrame:
    """(imsi, laccell) of lines that have at least these two fields."""
    f = _fields()
    return lines.where(signal_pair_is_valid()).select(
        F.get(f, 0).alias("imsi"), F.get(f, 1).alias("laccell"))


def parse_users_lenient(lines: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(imsi, gender, age) of lines with three fields and an integer age >= 0."""
    f = _fields()
    return lines.where(user_is_valid()).select(
        F.get(f, 0).alias("imsi"), F.get(f, 1).alias("gender"),
        F.get(f, 2).try_cast("int").alias("age"), *extra)


def parse_region_cell_lenient(lines: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(laccell, region_id) of lines with both fields (key first, for lookups)."""
    f = _fields()
    return lines.where(cell_is_valid()).select(
        F.get(f, 1).alias("laccell"), F.get(f, 0).alias("region_id"), *extra)


def parse_signals_full(lines: DataFrame, strict: bool = False) -> DataFrame:
    """All five signal fields from a ``value`` column (stream-friendly).

    Lenient: lines without exactly five well-typed fields are dropped (and
    kept by ``rejects(lines, signal_is_valid())``).  Strict: such a line fails
    the query.
    """
    f = _fields()
    out = [F.get(f, 0).alias("imsi"), F.get(f, 1).alias("laccell"),
           F.get(f, 2).try_cast("double").alias("latitude"),
           F.get(f, 3).try_cast("double").alias("longitude"),
           F.get(f, 4).try_cast("long").alias("procedureStartTime")]
    kept = _or_fail(lines, signal_is_valid()) if strict else lines.where(signal_is_valid())
    return kept.select(*out)

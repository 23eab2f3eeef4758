"""Adaptive containers: a set of ids as whichever of three kinds is smallest.

Same buckets as :mod:`cellscope.functions.bitmap` (32768 ids each), one row per (key...,
bucket) with the columns of CONTAINER:

* ``kind`` ARRAY: ``vals`` holds the sorted positions, two bytes each;
* ``kind`` RUNS: ``vals`` holds pairs (first position, how many more follow), four bytes a run;
* ``kind`` BITMAP: ``bits`` holds the 4 KiB bitmap;
* ``n``: how many ids there are, so counting reads nothing else.

A region-hour has a handful of users in a bucket and takes some bytes; a portrait has half of
them and takes 4 KiB; ids that stand together (numbered by home region) become runs.  Every
operation is built-in expressions: containers of any two kinds are intersected in a
projection, decoded without Python, and merged after one exchange of the containers
themselves, never of 4 KiB partial states of sparse sets.

Cases: null ids are skipped; a group whose ids are all null keeps one row with bucket null
and an empty array; duplicates collapse; negative ids fail.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope.functions import bitmap
from cellscope.functions.bitmap import BITS_PER_BUCKET, BYTES_PER_BUCKET, bucket_of, id_of, position_of

ARRAY, RUNS, BITMAP = 0, 1, 2
CONTAINER = ["kind", "n", "vals", "bits"]
CONTAINER_FIELDS = [
    T.StructField("kind", T.ByteType()), T.StructField("n", T.IntegerType()),
    T.StructField("vals", T.ArrayType(T.ShortType())), T.StructField("bits", T.BinaryType())]

_WORDS = BITS_PER_BUCKET // 32


def _shorts(c: Column) -> Column:
    return c.cast("array<smallint>")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: inside a lambda an outer expression would
    be computed again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _runs(positions: Column) -> Column:
    """Sorted positions -> first position and length less one of every run."""
    def of(a: Column) -> Column:
        starts = F.filter(a, lambda x, i: (i == 0) | (F.get(a, i - 1) != x - 1))
        ends = F.filter(a, lambda x, i: (i == F.size(a) - 1) | (F.get(a, i + 1) != x + 1))
        return F.flatten(F.zip_with(starts, ends, lambda s, e: F.array(s, e - s)))

    return _let(positions, of)


def _word(bits: Column, w: Column) -> Column:
    """Bytes 4w to 4w + 3 of a bitmap, the first one highest.  A part of a binary value is taken
    at its place; of a string it would be sought from the start."""
    return F.conv(F.hex(F.substring(bits, w * 4 + 1, F.lit(4))), 16, 10).cast("long")


def _bit(word: Column, p: Column) -> Column:
    """Bit p (0 to 31, as bitmaps count them) of such a word."""
    place = (F.lit(3) - F.shiftright(p.cast("int"), 3)) * 8 + p % 8
    return F.call_function("shiftright", word, place).bitwiseAND(F.lit(1).cast("long")) == 1


def _single(p: Column) -> Column:
    """The word that has bit p alone."""
    place = (F.lit(3) - F.shiftright(p.cast("int"), 3)) * 8 + p % 8
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def _words(bits: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda w: _word(bits, w))


def _filled(bits: Column) -> Column:
    """Words (w, word) of a bitmap that aren't 0."""
    numbered = F.transform(_words(bits), lambda word, w: F.struct(w.alias("w"), word.alias("word")))
    return F.filter(numbered, lambda x: x["word"] != 0)


def _word_positions(words: Column) -> Column:
    def positions(x: Column) -> Column:
        inside = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda p: _bit(x["word"], p))
        return F.transform(inside, lambda p: (x["w"] * 32 + p).cast("smallint"))

    return F.flatten(F.transform(words, positions))


def _bitmap_positions(bits: Column) -> Column:
    return _word_positions(_filled(bits))


def _bitmap_of(positions: Column) -> Column:
    """Sorted positions -> bitmap, by way of its bits as digits, the last one first."""
    def gap(x: Column, i: Column) -> Column:
        return F.repeat(F.lit("0"), (x - F.when(i > 0, F.get(positions, i - 1)).otherwise(F.lit(-1)) - 1).cast("int"))

    digits = F.array_join(F.transform(positions, lambda x, i: F.concat(gap(x, i), F.lit("1"))), "")
    digits = F.reverse(F.rpad(digits, BITS_PER_BUCKET, "0")).cast("binary")

    def byte(d: Column, b: Column) -> Column:
        eight = F.substring(d, F.lit(BITS_PER_BUCKET - 7) - b * 8, F.lit(8)).cast("string")
        return F.lpad(F.conv(eight, 2, 16), 2, "0")

    return _let(digits, lambda d: F.unhex(F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(BYTES_PER_BUCKET - 1)), lambda b: byte(d, b)), "")))


def _run_positions(vals: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor(F.size(vals) / 2).cast("int") - 1)
    return _shorts(F.flatten(F.transform(runs, lambda i: F.sequence(
        F.get(vals, i * 2).cast("int"), F.get(vals, i * 2).cast("int") + F.get(vals, i * 2 + 1).cast("int")))))


def positions(prefix: str = "") -> Column:
    """Sorted positions of a container (columns with this prefix)."""
    kind, vals, bits = (F.col(prefix + c) for c in ("kind", "vals", "bits"))
    return F.when(kind == BITMAP, _bitmap_positions(bits)).when(kind == RUNS, _run_positions(vals)).otherwise(vals)


def _contained(rows: DataFrame, keep: Sequence[str], sorted_positions: Column, bits: Column | None = None,
               bitmaps: bool = True) -> DataFrame:
    """keep... and the container of the kind that takes fewest bytes, in one projection.

    ``bits`` is the set as a bitmap where it's at hand.  Without ``bitmaps`` lists that would
    be one stay runs (a result that isn't stored).
    """
    none = F.lit(None).cast("binary")

    def of(kind: int, a: Column, vals: Column, bits: Column) -> Column:
        return F.struct(F.lit(kind).cast("tinyint").alias("kind"), F.size(a).alias("n"),
                        _shorts(vals).alias("vals"), bits.alias("bits"))

    def chosen(a: Column, runs: Column) -> Column:
        array, by_runs = F.size(a) * 2, F.size(runs) * 2
        out = F.when((array <= by_runs) & (array <= BYTES_PER_BUCKET), of(ARRAY, a, a, none))
        if not bitmaps:
            return out.otherwise(of(RUNS, a, runs, none))
        return out.when(by_runs <= BYTES_PER_BUCKET, of(RUNS, a, runs, none)).otherwise(
            of(BITMAP, a, F.array(), _bitmap_of(a) if bits is None else bits))

    # Two ids or fewer are an array whatever they are.
    container = _let(sorted_positions, lambda a: F.when(F.size(a) <= 2, of(ARRAY, a, a, none)).otherwise(
        _let(_runs(a), lambda runs: chosen(a, runs))))
    return rows.select(*keep, F.inline(F.array(container)))


def _from_positions(dealt: DataFrame, group: list[str]) -> DataFrame:
    """(group..., pos), dealt by ``group`` -> containers; no exchange."""
    # Sorted by bucket first: a number of many values, where a key's text has few.
    sets = dealt.groupBy(*reversed(group)).agg(F.sort_array(F.collect_set("pos")).alias("_sorted"))
    return _contained(sets, group, F.col("_sorted"))


def from_bitmaps(df: DataFrame, keys: Sequence[str], bitmap_col: str = "bitmap") -> DataFrame:
    """Rows (keys..., bucket, bitmap), one for each bucket, as containers."""
    bits = F.col(bitmap_col)
    return _contained(df, [*keys, "bucket"], _bitmap_positions(bits), bits)


def build(df: DataFrame, keys: Sequence[str], id_col: str = "bitmap_id", sparse: bool = True) -> DataFrame:
    """GROUP BY keys -> set of ids, as (keys..., bucket, kind, n, vals, bits).

    ``sparse`` sets (a region-hour): the (key, bucket, position) rows are shuffled.  Dense ones
    (portraits): up to 32768 ids leave a task as one bitmap, made a container at the end.
    """
    keys = list(keys)
    if not sparse:
        return from_bitmaps(bitmap.build(df, keys, id_col), keys)
    rows = df.select(*keys, bucket_of(id_col).alias("bucket"), position_of(id_col).cast("smallint").alias("pos"))
    return _from_positions(rows.repartition(*keys, "bucket"), [*keys, "bucket"])


def merge(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """OR of the containers of the same (keys, bucket), e.g. hours -> day.

    Each container is read out as words of 32 bits, equal words are OR-ed and the at most 1024
    of a bucket make its container again: one pass after one exchange, whatever kinds meet.
    """
    group = [*keys, "bucket"]
    dealt = df.select(*group, *CONTAINER).repartition(*group)
    single = F.transform(positions(), lambda p: F.struct(
        F.shiftright(p.cast("int"), 5).alias("w"), _single(p % 32).alias("word")))
    words = F.when(F.col("kind") == BITMAP, _filled(F.col("bits"))).otherwise(single)
    words = dealt.select(*group, F.explode_outer(words).alias("x")).select(*group, "x.w", "x.word")
    words = words.groupBy(*group, "w").agg(F.bit_or("word").alias("word"))
    sets = words.groupBy(*group).agg(F.sort_array(F.collect_list(
        F.when(F.col("w").isNotNull(), F.struct("w", "word")))).alias("_words"))
    return _contained(sets, group, _word_positions(F.col("_words")))


def cardinality(df: DataFrame, keys: Sequence[str], out: str = "user_count") -> DataFrame:
    """Number of ids per key; reads ``n`` alone."""
    return df.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias(out))


def common(left: str, right: str) -> Column:
    """Sorted positions that two containers (columns of :func:`prefixed`) share.

    With a bitmap on one side the other's positions are looked up in its words (of two bitmaps the
    one with fewer ids is read out); otherwise two short lists are intersected.
    """
    def inside(p: str, of: str) -> Column:
        return F.filter(positions(p), lambda x: _bit(
            F.get(F.col(of + "words"), F.shiftright(x.cast("int"), 5)), x % 32))

    first = (F.col(right + "kind") == BITMAP) & (
        (F.col(left + "kind") != BITMAP) | (F.col(left + "n") <= F.col(right + "n")))
    return (F.when(first, inside(left, right)).when(F.col(left + "kind") == BITMAP, inside(right, left))
            .otherwise(F.sort_array(F.array_intersect(positions(left), positions(right)))))


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """Containers with prefixed columns for :func:`common`; a bitmap's words are read once
    here, not for every container that it meets."""
    words = F.when(F.col("kind") == BITMAP, _words(F.col("bits")))
    return df.withColumn(prefix + "words", words).withColumnsRenamed({c: prefix + c for c in CONTAINER})


def intersect(left: DataFrame, right: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Bucket-wise AND of two sets that share ``keys``; empty buckets fall away.

    Each side is OR-merged first, so repeated rows can't double a bucket.
    """
    group = [*keys, "bucket"]
    sides = [prefixed(merge(x.where(F.col("bucket").isNotNull()), list(keys)), p) for x, p in ((left, "_l"), (right, "_r"))]
    both = sides[0].join(sides[1], group).select(*group, common("_l", "_r").alias("_both")).where(F.size("_both") > 0)
    return _contained(both, group, F.col("_both"), bitmaps=False)


def decode(df: DataFrame, keys: Sequence[str], id_col: str = "bitmap_id") -> DataFrame:
    """Containers -> one row per (keys..., id)."""
    rows = df.where(F.col("bucket").isNotNull()).select(*keys, "bucket", F.explode(positions()).alias("pos"))
    return rows.select(*keys, id_of("bucket", F.col("pos").cast("long")).alias(id_col))


def from_ids(df: DataFrame, keys: Sequence[str], ids_col: str) -> DataFrame:
    """Id arrays -> containers."""
    return build(df.select(*keys, F.explode_outer(ids_col).alias("_id")), keys, "_id")


def stored_bytes(df: DataFrame) -> Column:
    """Bytes of a container's content."""
    return F.size("vals") * 2 + F.coalesce(F.octet_length("bits"), F.lit(0))

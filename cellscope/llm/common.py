"""Helpers shared by the text operators: words, scratch tables, checked broadcasts, folds."""

from __future__ import annotations

import zlib
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.session import scratch_path

# White space of the word pattern [^\x20\x09-\x0D]+ : space, tab, LF, VT, FF, CR.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_RUN = r"[\x20\x09-\x0D]+"

# A side of at most this many rows may be broadcast (narrow rows: < 64 MB).
BROADCAST_ROWS = 200_000
SALTS = 32


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, WS_RUN))


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (null id: of the empty text)."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod).cast("int")


def fold_py(doc_id, mod: int) -> int:
    text = "" if doc_id is None else str(int(doc_id))
    return zlib.crc32(text.encode()) % mod


_STEPS = count(1)
RELEASE_STEPS = 2


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back, so
    that later passes neither recompute it nor depend on executors' disks.  What
    written steps no longer need is released every few steps: operators of many
    small steps would otherwise fill the driver and keep shuffle files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if next(_STEPS) % RELEASE_STEPS == 0:
        release(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _probes(h: Column, bits: int) -> list[Column]:
    low = h.bitwiseAND(F.lit(bits - 1).cast("long"))
    return [low, F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1).cast("long"))]


def bitmap(hashes: DataFrame, column: str, bits: int) -> DataFrame:
    """One row ``bits``: an array of bits / 64 words with two bits set for every hash.  Its
    size is fixed, whatever the number of hashes."""
    places = hashes.select(F.explode(F.array(*_probes(F.col(column), bits))).alias("bit"))
    words = places.groupBy(F.shiftright("bit", 6).cast("long").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    every = hashes.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(words, "word", "left")
    return every.agg(F.transform(F.sort_array(F.collect_list(
        F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))),
        lambda x: x["bits"]).alias("bits"))


def may_hold(bitmap_row: Column, h: Column, bits: int, probes: int = 2) -> Column:
    """False only for hashes that the bitmap wasn't built from."""
    first, *rest = [F.getbit(F.get(bitmap_row, F.shiftright(b, 6).cast("int")),
                     b.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1 for b in _probes(h, bits)[:probes]]
    return first & rest[0] if rest else first


AMONG_BITS = 1 << 20


def among(df: DataFrame, column: str, wanted: DataFrame, wanted_column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` occurs in ``wanted``, and possibly some more: a cheap
    cut by a bitmap of fixed size before a join, so that less is shuffled."""
    row = materialize(bitmap(wanted.select(F.xxhash64(wanted_column).alias("h")), "h", AMONG_BITS), "among")
    return df.where(may_hold(row.scalar(), F.xxhash64(column), AMONG_BITS))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int,
                    mod: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, text, label of about ``rows`` labelled documents at most, chosen by a hash
    of the id outside the held-out fold.  The sample's labels are few by construction
    (``rows`` is a parameter), so they are broadcast and no text is shuffled."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()
                         & (fold(F.col("doc_id"), mod) != held_out))
    known = known.groupBy("doc_id").agg(F.max((F.col(label) >= 1).cast("int")).alias("label"))
    n = known.count()
    if n > rows:
        span = 1 << 32
        known = known.where(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(span)) < int(span * rows / n))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose results are written."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def join_checked(big: DataFrame, small: DataFrame, keys: list[str], spread: Column) -> DataFrame:
    """Inner join with a side that is expected to be small.

    The side is broadcast when its counted rows prove it small.  Beyond that
    both sides take part in a salted shuffle join (``spread`` deals the rows of
    a hot key over SALTS sub-keys), so one frequent key never meets in one task.
    """
    if small.count() <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), keys)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [*keys, "_salt"]).drop("_salt")


# --- vectorised words over Arrow string buffers -------------------------------------------

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that all bits of a hash are usable."""
    x = np.asarray(x, np.uint64)
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a batch of texts as 64-bit hashes.

    ``hashes[i]`` belongs to the row ``row[i]``; words of one row stand together
    in text order, ``first[r]:first[r + 1]`` are those of row r.  ``start`` and
    ``end`` are byte offsets in ``data`` (the batch's UTF-8 bytes).  A-Z are
    lower-cased in the hash when ``lower`` is set.
    """

    def __init__(self, texts, lower: bool = True):
        data, offsets = utf8(texts)
        n = len(offsets) - 1
        self.data, self.offsets, self.rows = data, offsets, n
        space = _IS_SPACE[data]
        # A word starts where a non-space follows a space, the batch's start or a row's start.
        word = ~space
        begin = word.copy()
        begin[1:] &= space[:-1]
        stop = word.copy()
        stop[:-1] &= space[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        begin[edges] |= word[edges]
        stop[edges - 1] |= word[edges - 1]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(n), np.diff(self.first))
        self.hashes = _word_hashes(data, self.start, self.end, _LOWER if lower else _SAME)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _MULT)
_SAME = _CODE
_LOWER = _CODE.copy()
_LOWER[65:91] = _CODE[97:123]


def _powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(1, n), np.uint64)
    filled = 1
    while filled < n:
        take = min(filled, n - filled)
        out[filled:filled + take] = out[:take] * np.uint64(pow(base, filled, 1 << 64))
        filled += take
    return out


_BASE = 0xD6E8FEB86659FD93


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Polynomial hash of every word: sum of code[byte] * base**(position in word)."""
    out = np.empty(len(start), np.uint64)
    span = 1 << 18      # work in slices of about this many bytes
    inverse = pow(_BASE, -1, 1 << 64)
    powers, backs = _powers(span + 1, _BASE), _powers(span + 1, inverse)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + span)))
        a, b = int(start[lo]), int(end[hi - 1])
        if b - a > len(powers):
            powers, backs = _powers(b - a, _BASE), _powers(b - a, inverse)
        terms = table[data[a:b]] * powers[:b - a]
        terms[_IS_SPACE[data[a:b]]] = 0
        at = start[lo:hi] - a
        sums = np.add.reduceat(terms, at)
        # Shift each sum back to position 0: multiply by base**-at (the base is odd).
        length = (end[lo:hi] - start[lo:hi]).astype(np.uint64)
        out[lo:hi] = mix64(sums * backs[at] + length * _MULT)
        lo = hi
    return out


def utf8(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string array; nulls are empty."""
    import pyarrow as pa

    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, n + 1 + texts.offset)[texts.offset:]
    raw = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    base = int(offsets[0]) if n else 0
    stop = int(offsets[-1]) if n else 0
    return raw[base:stop], (offsets - base).astype(np.int64)


# Bytes of the batches that go to Python workers.  By default up to 10 000 rows travel at
# once; of long texts that would take a large part of an executor's memory, several times over.
BATCH_BYTES = 4 << 20


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` over batches of a bounded size (a setting of the session)."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def arrow_batches(batches, column: str, max_bytes: int = BATCH_BYTES):
    """Cut record batches so that ``column`` holds about ``max_bytes`` at most
    (one longer text stands alone): what a task holds doesn't follow text length."""
    import pyarrow.compute as pc

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes)
        lo = 0
        while lo < n:
            before = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, before + max_bytes, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi

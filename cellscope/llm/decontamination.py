r"""Operator 5: benchmark decontamination by spaced-seed hashing.

Tokens are lower-cased runs of letters and digits.  Fixed masks of span 10 choose 5
tokens; equal hashes of the chosen tokens in a document and a benchmark item are a hit,
whatever stands at the ignored places.  Around a hit the two texts are laid side by
side: a document holds an item if some ``WINDOW`` aligned tokens (the whole item, if it
is shorter) agree in 80 % or more.  The three masks find every such overlap: wherever
the substitutions are, some mask at some place avoids them (tested exhaustively).

Everything is built-in expressions.  Document hashes meet the benchmark's in two steps:
a bitmap of fixed size built from the benchmark (a scalar subquery) drops almost all
positions where they arise, the rest are joined with the seeds, which are broadcast if
counted small and salted otherwise.  Nothing but hits is shuffled.

Items of fewer than ``MIN_TOKENS`` tokens are too short for masks: a document holds one of n
tokens if n tokens of it in a row are the item, found by hashes of all its windows of the few
lengths n that such items have (no such items: no pass).

Cases: null and empty texts and items have no tokens and match nothing; equal items count as one, under
the smallest id; a document is cut into overlapping pieces, so very long texts are
searched whole; rows that repeat an id are reported once per item; rows with a null id
are reported under null; empty tables give no rows; other columns are left aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import bitmap, documents, join_checked, materialize, may_hold

MASKS = ((0, 3, 7, 8, 9), (0, 3, 4, 5, 9), (0, 1, 2, 7, 9))
SPAN = 10
WINDOW = 20
MIN_TOKENS = 12
PERCENT = 80
PIECE = 64                   # tokens of a document in one piece; each position's row holds its piece
FILTER_BITS = 1 << 23        # 1 MB
LEFT = WINDOW - SPAN         # tokens looked at before a hit


def token_hashes(text: Column) -> Column:
    """Hashes of a text's tokens."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.xxhash64(x))


def _mask_hash(tokens: Column, at: Column, m: int) -> Column:
    # The tokens' hashes are shifted and XORed first: little code for each position, so that
    # the JVM compiles the loop.
    mixed = tokens[at + MASKS[m][0]]
    for k, o in enumerate(MASKS[m][1:], 1):
        mixed = mixed.bitwiseXOR(F.shiftleft(tokens[at + o], 7 * k))
    return F.xxhash64(mixed, F.lit(m))


def _seed_rows(at: Column, tokens: Column) -> Column:
    return F.array(*[F.struct(F.lit(m).alias("mask"), _mask_hash(tokens, at, m).alias("hash"))
                     for m in range(len(MASKS))])


def seeds(benchmark: DataFrame) -> DataFrame:
    """mask, hash, q, item_id, n_items, n_item, item (tokens around q), item_left."""
    items = benchmark.select("item_id", token_hashes(F.col("text")).alias("tokens"))
    items = items.where(F.size("tokens") >= MIN_TOKENS).groupBy("tokens").agg(
        F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("n_items"))
    items = items.withColumn("n_item", F.size("tokens"))
    rows = items.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("n_item") - SPAN)))
    rows = rows.withColumn("seed", F.explode(_seed_rows(F.col("q"), F.col("tokens"))))
    left = F.least(F.col("q"), F.lit(LEFT))
    return rows.select("seed.mask", "seed.hash", "q", "item_id", "n_items", "n_item",
                       F.slice("tokens", F.col("q") - left + 1, left + WINDOW).alias("item"),
                       left.alias("item_left"))


def _short_items(benchmark: DataFrame) -> DataFrame:
    """n, hash, item (tokens), item_id, n_items of the items too short for masks."""
    items = benchmark.select("item_id", token_hashes(F.col("text")).alias("item"))
    items = items.where((F.size("item") > 0) & (F.size("item") < MIN_TOKENS)).groupBy("item").agg(
        F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("n_items"))
    return items.select(F.size("item").alias("n"), F.xxhash64("item").alias("hash"), "item", "item_id", "n_items")


def _short_overlaps(docs: DataFrame, items: DataFrame, lengths: list[int]) -> DataFrame:
    """Documents that hold a short item word for word, as from :func:`overlaps`."""
    bits = materialize(bitmap(items, "hash", FILTER_BITS), "decon-short-bits").scalar()
    most = max(lengths)
    d = docs.select("doc_id", token_hashes(F.col("text")).alias("tokens")).where(F.size("tokens") > 0)
    d = d.withColumn("start", F.explode(F.sequence(F.lit(0), F.size("tokens") - 1, F.lit(PIECE))))
    d = d.select("doc_id", "start", F.slice("tokens", F.col("start") + 1, PIECE + most - 1).alias("piece"))
    d = d.withColumn("at", F.explode(F.sequence(F.lit(0), F.least(F.lit(PIECE), F.size("piece")) - 1)))
    windows = F.array(*[F.struct(F.lit(n).alias("n"), F.slice("piece", F.col("at") + 1, n).alias("window"))
                        for n in lengths])
    d = d.select("doc_id", (F.col("start") + F.col("at")).alias("p"), F.explode(windows).alias("w"))
    d = d.select("doc_id", "p", "w.n", "w.window", F.xxhash64("w.window").alias("hash"))
    d = d.where((F.size("window") == F.col("n")) & may_hold(bits, F.col("hash"), FILTER_BITS))
    found = join_checked(d, items, ["n", "hash"], F.struct("doc_id", "p")).where("window = item")
    return found.groupBy("doc_id", "item_id", "n_items", F.col("n").alias("window")).agg(
        F.min("p").alias("doc_token")).select("doc_id", "item_id", "n_items", "window",
                                              F.col("window").alias("matched"), "doc_token")


def hits(docs: DataFrame, filter_row: DataFrame) -> DataFrame:
    """doc_id, p (token of the document), mask, hash, near (tokens around p), near_left:
    the positions that the bitmap lets through."""
    bits = filter_row.scalar()
    d = docs.select("doc_id", token_hashes(F.col("text")).alias("tokens"))
    # Documents shorter than a mask have no start and drop out here.
    starts = F.when(F.size("tokens") >= SPAN, F.sequence(F.lit(0), F.size("tokens") - SPAN, F.lit(PIECE)))
    d = d.withColumn("start", F.explode(starts))
    begin = F.greatest(F.col("start") - LEFT, F.lit(0))
    d = d.select("doc_id", begin.alias("begin"), (F.col("start") - begin).alias("lead"),
                 F.slice("tokens", begin + 1, F.col("start") - begin + PIECE + WINDOW).alias("piece"))
    last = F.least(F.col("lead") + PIECE - 1, F.size("piece") - SPAN)
    d = d.withColumn("at", F.explode(F.sequence(F.col("lead"), last)))
    d = d.withColumns({f"h{m}": _mask_hash(F.col("piece"), F.col("at"), m) for m in range(len(MASKS))})

    some = F.lit(False)
    for m in range(len(MASKS)):
        some = some | may_hold(bits, F.col(f"h{m}"), FILTER_BITS, probes=1)
    left = F.least(F.col("at"), F.lit(LEFT))
    d = d.where(some).select(
        "doc_id", (F.col("begin") + F.col("at")).alias("p"), left.alias("near_left"),
        F.slice("piece", F.col("at") - left + 1, left + WINDOW).alias("near"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("mask"), F.col(f"h{m}").alias("hash"))
                            for m in range(len(MASKS))])).alias("seed"))
    d = d.select("doc_id", "p", "near", "near_left", "seed.mask", "seed.hash")
    return d.where(may_hold(bits, F.col("hash"), FILTER_BITS))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item that it holds: doc_id, item_id,
    n_items (equal items), window, matched (of window tokens), doc_token (place in the document)."""
    seed_rows = materialize(seeds(benchmark), "decon-seeds")
    filter_row = materialize(bitmap(seed_rows, "hash", FILTER_BITS), "decon-bits")
    pairs = join_checked(hits(docs, filter_row), seed_rows, ["mask", "hash"], F.struct("doc_id", "p"))
    left = F.least("near_left", "item_left")
    doc = F.slice("near", F.col("near_left") - left + 1, left + WINDOW)
    item = F.slice("item", F.col("item_left") - left + 1, left + WINDOW)
    n = F.least(F.size(doc), F.size(item))
    same = F.zip_with(F.slice(doc, 1, n), F.slice(item, 1, n), lambda a, b: (a == b).cast("int"))
    pairs = pairs.withColumns({"left": left, "same": same, "window": F.least("n_item", F.lit(WINDOW))})
    pairs = pairs.where(F.size("same") >= F.col("window"))
    pairs = pairs.withColumn("runs", F.transform(
        F.sequence(F.lit(0), F.size("same") - F.col("window")),
        lambda i: F.aggregate(F.slice("same", i + 1, F.col("window")), F.lit(0), lambda a, x: a + x)))
    pairs = pairs.withColumn("matched", F.array_max("runs")).where(
        F.col("matched") * 100 >= F.col("window") * PERCENT)
    place = F.col("p") - F.col("left") + F.array_position("runs", F.col("matched")).cast("int") - 1
    best = F.min(F.struct((-F.col("matched")).alias("m"), place.alias("at")))
    out = pairs.groupBy("doc_id", "item_id", "n_items", "window").agg(best.alias("best"))
    out = out.select("doc_id", "item_id", "n_items", "window", (-F.col("best.m")).alias("matched"),
                     F.col("best.at").alias("doc_token"))
    short = materialize(_short_items(benchmark), "decon-short")
    lengths = sorted(r.n for r in short.select("n").distinct().collect())      # MIN_TOKENS - 1 at most
    return out.unionByName(_short_overlaps(docs, short, lengths)) if lengths else out


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    return overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

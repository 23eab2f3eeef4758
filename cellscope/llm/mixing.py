r"""Operator 1: mixing sources to target weights by a low-discrepancy schedule.

Every source gets a target number of words; its shuffled documents form one word
stream, read for as many words as the target (twice at most) and cut into blocks of
equal size.  The mix is a row of slots: each source owns a range of slots in
proportion to its target, the base-2 van der Corput points run through these
cumulative ranges, and the k-th slot that falls to a source takes its k-th block.
Consecutive slots therefore mix all sources in the target proportions, on any prefix.

* Targets: sources in code point order (null last) weigh 3, 1, 2 in turn and share
  150 % of all words; what exceeds twice a source's words goes to the others by
  weight until none exceeds (water filling, closed form over whole numbers).
* The rank of a slot among those of its source is computed from the slot's bits: no
  window over a hot source.  Offsets in a source's stream are prefix sums in two
  levels (hash buckets of a bounded number of documents, then inside each bucket).

Cases: null text has 0 words and takes 0; a null source is a source of its own, after
the others; null or repeated ids are rows of their own; documents of 0 words have
taken 0; without any words all targets are 0; an empty table gives no rows; columns
of the input that aren't used are left aside.  One text is never split by length:
a document of many words spans many blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm.common import WS_RUN, documents, join_checked, materialize

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
TIMES = 2                 # passes over a source at most
BLOCK_WORDS = 2048        # words of one slot
BUCKET_DOCS = 8192        # documents of one prefix-sum bucket, about
SEED = "mix"


def sizes(docs: DataFrame, keep=()) -> DataFrame:
    """doc_id, source and number of words: all that the rest needs, and the columns ``keep``."""
    return docs.select(
        "doc_id", "source", *keep,
        F.coalesce(F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame, weights=WEIGHTS) -> DataFrame:
    """source, source_size, n_docs, target: one row for each source.

    Windows here run over one row per source, after the aggregation."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    src = src.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    src = src.withColumn("weight", weight).withColumn("cap", F.col("source_size") * TIMES)
    # Sources whose cap is small against their weight fill up first.
    whole = 1
    for x in set(weights):
        whole *= x
    src = src.withColumn("fill", F.col("cap") * whole / F.col("weight"))
    before = Window.orderBy("fill", "rank").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("fill", "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    src = src.withColumns({
        "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "weight_left": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        "all_words": F.sum("source_size").over(every)})
    # 100 * (what is left to share) and whether this source is full at that level.
    left = F.col("all_words") * SHARE_PERCENT - F.col("cap_before") * 100
    src = src.withColumn("left", left).withColumn(
        "full", F.col("cap") * 100 * F.col("weight_left") <= left * F.col("weight"))
    # Once one source isn't full, it and all after it share what is left there.
    open_at = F.min(F.when(~F.col("full"), F.struct("fill", "rank", "left", "weight_left"))).over(every)
    src = src.withColumn("open", open_at)
    shared = (F.col("weight") * F.col("open.left")).cast("double") / (F.col("open.weight_left") * 100)
    is_full = F.col("open").isNull() | (F.struct("fill", "rank") < F.struct("open.fill", "open.rank"))
    return src.select("source", "rank", "source_size", "n_docs",
                      F.when(is_full, F.col("cap").cast("double")).otherwise(shared).alias("target"))


def _source_key(source: Column) -> Column:
    """Joins treat the null source as a source."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def plan(sized: DataFrame) -> DataFrame:
    """Targets, words to take (take) and each source's slot range [lo, lo + n_slots)."""
    t = targets(sized).withColumn("take", F.floor(F.col("target") + 0.5).cast("long"))
    t = t.withColumn("n_slots", F.ceil(F.col("take") / BLOCK_WORDS).cast("long"))
    upto = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("lo", F.coalesce(F.sum("n_slots").over(upto), F.lit(0)).cast("long"))
    return t.withColumn("source_key", _source_key(F.col("source")))


def _points_below(i: Column, bound: Column, bits: int) -> Column:
    """How many of the van der Corput points 0 .. i-1 (as whole numbers of ``bits``
    bits) lie below ``bound``.

    Numbers smaller than i split by the highest bit in which they differ from i: they
    share the bits above it, have 0 there and any bits below.  Reversed, each part is
    an arithmetic progression with step 2**(number of fixed bits)."""
    total = F.lit(0).cast("long")
    prefix = F.lit(0).cast("long")           # reversed bits shared so far
    for fixed in range(bits):
        bit = F.shiftrightunsigned(i, bits - 1 - fixed).bitwiseAND(F.lit(1).cast("long"))
        step = 1 << (fixed + 1)
        count = F.ceil((bound - prefix) / F.lit(float(step))).cast("long")
        part = F.least(F.greatest(count, F.lit(0).cast("long")), F.lit(1 << (bits - 1 - fixed)).cast("long"))
        total = total + bit * part
        prefix = prefix + bit * (1 << fixed)
    return total


def _reversed(i: Column, bits: int) -> Column:
    out = F.lit(0).cast("long")
    for b in range(bits):
        out = out + F.shiftrightunsigned(i, b).bitwiseAND(F.lit(1).cast("long")) * (1 << (bits - 1 - b))
    return out


def schedule(spark, planned: DataFrame) -> DataFrame:
    """slot, source_key, k: which block of which source each slot takes, in mix order.

    Points run over a power of two; those beyond the last slot fall to no source."""
    n = planned.agg(F.sum("n_slots")).first()[0] or 0
    bits = max(1, int(max(n, 1) - 1).bit_length())
    slots = spark.range(1 << bits).withColumnRenamed("id", "slot")
    slots = slots.withColumn("point", _reversed(F.col("slot"), bits)).where(F.col("point") < n)
    # Which range holds the point: by cells of about equal width, so that it is an equi-join.
    width = max(1, (1 << bits) // 1024)
    ranges = planned.where("n_slots > 0").select(
        "source_key", "lo", (F.col("lo") + F.col("n_slots")).alias("hi"),
        F.explode(F.sequence(F.floor(F.col("lo") / width),
                             F.floor((F.col("lo") + F.col("n_slots") - 1) / width))).alias("cell"))
    slots = slots.withColumn("cell", F.floor(F.col("point") / width))
    slots = join_checked(slots, ranges, ["cell"], F.col("slot"))
    slots = slots.where((F.col("point") >= F.col("lo")) & (F.col("point") < F.col("hi")))
    k = _points_below(F.col("slot"), F.col("hi"), bits) - _points_below(F.col("slot"), F.col("lo"), bits)
    return slots.select("slot", "source_key", k.alias("k"))


def streams(sized: DataFrame, planned: DataFrame, keep=()) -> DataFrame:
    """Each document with its place (at) in its source's shuffled word stream and a
    row number, unique with source and bucket."""
    d = sized.withColumn("source_key", _source_key(F.col("source")))
    p = planned.drop("source", "rank").withColumn(
        "n_buckets", F.ceil(F.col("n_docs") / BUCKET_DOCS).cast("long"))
    d = join_checked(d, p, ["source_key"], F.col("doc_id"))
    key = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    d = d.withColumn("key", key)
    deal = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    d = d.withColumn("bucket", F.floor(deal * F.col("n_buckets") / F.lit(float(1 << 32))).cast("long"))
    order = Window.partitionBy("source_key", "bucket").orderBy("key", F.col("doc_id").asc_nulls_first(), "size", *keep)
    d = d.withColumn("inside", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    d = d.withColumn("row", F.row_number().over(order))
    per_bucket = d.groupBy("source_key", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.select("source_key", "bucket", F.coalesce(
        F.sum("bucket_size").over(earlier), F.lit(0)).alias("bucket_at"))
    d = join_checked(d, per_bucket, ["source_key", "bucket"], F.col("key"))
    return d.withColumn("at", F.col("bucket_at") + F.col("inside"))


def pieces(stream: DataFrame) -> DataFrame:
    """Documents cut at pass and block borders: source_key, k, bucket, row, pass, words
    [word_from, word_to) of the document."""
    p = stream.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(TIMES - 1))))
    p = p.withColumn("from", F.col("pass") * F.col("source_size") + F.col("at"))
    p = p.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("take"))).where("from < to")

    # Block k starts at word k * q + min(k, r), where take = q * n_slots + r.
    p = p.withColumns({"q": F.expr("take div n_slots"), "r": F.expr("take % n_slots")})

    def block(x: str) -> Column:
        return F.expr(f"if({x} < r * (q + 1), {x} div (q + 1), r + ({x} - r * (q + 1)) div q)")
    p = p.withColumn("k", F.explode(F.sequence(block("from"), block("(to - 1)"))))
    begin = F.expr("k * q + least(k, r)")
    end = F.expr("(k + 1) * q + least(k + 1, r)")
    base = F.col("from")
    return p.select("source_key", "k", "bucket", "row", "pass",
                    (F.greatest(begin, base) - base).alias("word_from"),
                    (F.least(end, F.col("to")) - base).alias("word_to"))


def mix(docs: DataFrame, keep=()) -> tuple[DataFrame, DataFrame]:
    """(documents with size, source_size, target, at ...; the mix: one row for each
    piece of a document in a slot, in the order slot, pass, row)."""
    sized = materialize(sizes(docs, keep), "mix-sizes")
    planned = materialize(plan(sized), "mix-plan")
    stream = materialize(streams(sized, planned, keep), "mix-stream")
    slots = schedule(docs.sparkSession, planned)
    return stream, pieces(stream).join(slots, ["source_key", "k"])


def taken_words(docs: DataFrame, keep=()) -> DataFrame:
    """One row for each document: doc_id, source, size, source_size, target, taken, ``keep``."""
    stream, mixed = mix(docs, keep)
    key = ["source_key", "bucket", "row"]
    got = mixed.groupBy(*key).agg(F.sum(F.col("word_to") - F.col("word_from")).alias("taken"))
    out = stream.join(got, key, "left")
    return out.select("doc_id", "source", "size", "source_size", "target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), *keep)


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    return taken_words(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def _oracle() -> str:
    w = ", ".join(map(str, WEIGHTS))
    whole = 1
    for x in set(WEIGHTS):
        whole *= x
    return rf"""
WITH d AS (SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank FROM s0),
s2 AS (SELECT *, CAST([{w}][rank % {len(WEIGHTS)} + 1] AS BIGINT) AS weight, source_size * {TIMES} AS cap FROM s1),
s3 AS (SELECT *, cap * {whole} / weight AS fill FROM s2),
s4 AS (SELECT *, CAST(coalesce(sum(cap) OVER b, 0) AS BIGINT) AS cap_before,
    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS BIGINT) AS weight_left,
    CAST(sum(source_size) OVER () AS BIGINT) AS all_words FROM s3
    WINDOW b AS (ORDER BY fill, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s5 AS (SELECT *, all_words * {SHARE_PERCENT} - cap_before * 100 AS rest FROM s4),
s6 AS (SELECT *, cap * 100 * weight_left <= rest * weight AS is_full FROM s5),
o AS (SELECT fill AS ofill, rank AS orank, rest AS orest, weight_left AS oleft FROM s6 WHERE NOT is_full
    ORDER BY fill, rank LIMIT 1),
t AS (SELECT source, source_size, n_docs,
    CASE WHEN ofill IS NULL OR fill < ofill OR (fill = ofill AND rank < orank) THEN CAST(cap AS DOUBLE)
    ELSE CAST(weight * orest AS DOUBLE) / (oleft * 100) END AS target FROM s6 LEFT JOIN o ON true),
p AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS take FROM t),
x AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.take,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY
      md5('{SEED}' || coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - d.size AS pos
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN size = 0 THEN 0 ELSE (take // source_size) * size
    + greatest(0, least(pos + size, take % source_size) - pos) END AS BIGINT) AS taken FROM x
"""


ORACLE = _oracle()

"""Audit of how far sources diverge from each other and from their language (op11).

Terms are counted by length-bucketed packing.  A term of up to 16 bytes is one or two uint64
words; the words of a batch are radix-sorted digit by digit and counted as runs, and what the
batches of a task have in common is merged the same way before it leaves the task.  Longer
terms stand in buckets of doubling width and are sorted as bytes.

The counts (lang, source, term, n, docs) are dealt by (lang, term).  A language keeps the
terms of at least MIN_DOCS of its documents.  All that follows is whole-number arithmetic:
``p = 1 + floor(1e9 (n + 2) / (N + 2 V))`` on decimals, ``f = floor((p - q)^2 / (p + q))`` on
longs (p and q are at most 1e9 + 1, so the square fits).

* Part ``term``: a group's ten most overused terms against its language (top ten found in
  each task before the shuffle).
* Part ``pair``: every pair of sources of a language, summed over all its kept terms.  Kept
  terms are dealt into blocks of about BLOCK_TERMS and sources into tiles of TILE; a task
  holds one block for two tiles (a bounded matrix) and returns a sum for each pair of its
  sources, so no pair is made for a term.  Terms that neither tile has add the same value
  each, counted at the end.

Cases: null text, lang and source are ''; equal rows are documents of their own; a language
without kept terms gives its pairs the value 0; a language with one source has no pairs; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm.common import arrow_batches, documents, join_checked, map_batches, materialize, utf8
from cellscope.llm.packing import SHORT, packed, radix_order, run_starts, runs, unpacked

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
ADDED = 2

MERGE = 1 << 20         # entries that a task holds before it merges them
BLOCK_TERMS = 4096
TILE = 64

# Bytes of terms: letters A-Z, a-z and all of characters from U+0080 on.
_TERM = np.zeros(256, bool)
_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_COUNTS = "lang string, source string, term string, n long, docs long"


class _Groups:
    """Numbers of the (lang, source) pairs that a task has met, in order of appearance."""

    def __init__(self):
        self.number: dict[tuple[str, str], int] = {}

    def of(self, batch) -> np.ndarray:
        pairs = zip(*[(v or "" for v in batch.column(c).to_pylist()) for c in ("lang", "source")], strict=True)
        return np.fromiter((self.number.setdefault(p, len(self.number)) for p in pairs), np.uint32, batch.num_rows)


def _counted(keys: list[np.ndarray], row: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct sorted keys, how often each occurs and in how many rows."""
    start = run_starts(keys)
    new_row = np.zeros(len(row), np.int64)
    new_row[run_starts([*keys, row])] = 1
    n = np.diff(np.append(start, len(row)))
    return [k[start] for k in keys], n, np.add.reduceat(new_row, start) if len(start) else n


def _short_terms(data, start, length, row, group):
    """Counts of the packed terms: [high, low, group], n, docs."""
    high, low = packed(data, start, length)
    # Rows first by group, so that a term's rows stand together by group.
    order = radix_order([low, high], radix_order([group[row]]))
    return _counted([high[order], low[order], group[row][order]], row[order])


def _long_terms(data, start, length, row, group):
    """(term bytes, group, n, docs) of longer terms, one bucket for each doubling of the length."""
    width = SHORT
    while len(start):
        width *= 2
        here = length <= width
        if here.any():
            s, n, r = start[here], length[here], row[here]
            at = np.repeat(s - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            cells = np.zeros((len(s), width), np.uint8)
            cells[np.repeat(np.arange(len(s)), n), at - np.repeat(s, n)] = data[at]
            terms = cells.view(f"S{width}").ravel()
            order = radix_order([group[r]])
            order = order[np.argsort(terms[order], kind="stable")]
            (t, g), n, docs = _counted([terms[order], group[r][order]], r[order])
            yield from zip(t.tolist(), g.tolist(), n.tolist(), docs.tolist(), strict=True)
        start, length, row = start[~here], length[~here], row[~here]


def _merged(parts):
    """Counts of several batches as one."""
    high, low, group, n, docs = (np.concatenate([p[i] for p in parts]) for i in range(5))
    order = radix_order([group, low, high])
    keys = [high[order], low[order], group[order]]
    start = run_starts(keys)
    return [*[k[start] for k in keys], np.add.reduceat(n[order], start), np.add.reduceat(docs[order], start)]


def count_terms(batches):
    """Documents -> counts of their terms, combined within the task."""
    import pyarrow as pa

    groups, held = _Groups(), []

    def table(terms, group, n, docs):
        names = list(groups.number)
        pair = [pa.array([p[i] for p in names], pa.string()) for i in (0, 1)]
        at = pa.array(np.asarray(group, np.int64))
        return pa.RecordBatch.from_arrays(
            [pair[0].take(at), pair[1].take(at), terms, pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
            ["lang", "source", "term", "n", "docs"])

    def flushed(merged):
        for lo in range(0, len(merged[0]), 1 << 16):
            high, low, group, n, docs = (c[lo:lo + (1 << 16)] for c in merged)
            data, offsets = unpacked(high, low)
            terms = pa.StringArray.from_buffers(len(high), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
            yield table(terms, group, n, docs)

    for batch in arrow_batches(batches, "text"):
        group = groups.of(batch)
        raw, offsets = utf8(batch.column("text"))
        start, end = runs(_TERM[raw], offsets)
        data, length = _LOWER[raw], end - start
        row = np.searchsorted(offsets, start, side="right") - 1
        short = length <= SHORT
        (high, low, g), n, docs = _short_terms(data, start[short], length[short], row[short], group)
        if len(high):
            held.append([high, low, g, n, docs])
        long = list(_long_terms(data, start[~short], length[~short], row[~short], group))
        if long:
            terms, g, n, docs = zip(*long, strict=True)
            yield table(pa.array([t.decode() for t in terms]), g, n, docs)
        if sum(len(p[0]) for p in held) > MERGE:
            held = [_merged(held)]
            if len(held[0][0]) > MERGE // 2:
                yield from flushed(held.pop())
    if held:
        yield from flushed(_merged(held))


def _divided(n: str, whole: str, kept: str):
    """p of a count: 1 + floor(SCALE (n + ADDED) / (whole + ADDED kept)), exact."""
    return F.expr(f"1 + ({SCALE}BD * ({n} + {ADDED})) div ({whole} + {ADDED} * {kept})")


def _distance(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n, all_n (in the language), is_first (once for each kept term)."""
    texts = docs.select("lang", "source", "text")
    counts = map_batches(texts, count_terms, _COUNTS).repartition("lang", "term")
    counts = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    counts = counts.withColumns({"all_docs": F.sum("docs").over(of_term), "all_n": F.sum("n").over(of_term),
                                 "least": F.min("source").over(of_term)}).where(F.col("all_docs") >= min_docs)
    return counts.select("lang", "source", "term", "n", "all_n", (F.col("source") == F.col("least")).alias("is_first"))


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every (lang, source): tokens N, lang_tokens, lang_terms V, place (its number in the
    language), p0 (the p of a term that it lacks; null without terms)."""
    every = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("tokens"))
    whole = kept.groupBy("lang").agg(F.sum("n").alias("lang_tokens"),
                                     F.sum(F.col("is_first").cast("long")).alias("lang_terms"))
    out = every.join(own, ["lang", "source"], "left").join(whole, "lang", "left").fillna(
        0, ["tokens", "lang_tokens", "lang_terms"])
    out = out.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    return out.withColumn("p0", F.when(F.col("lang_terms") > 0, _divided("0L", "tokens", "lang_terms")))


def overused_terms(kept: DataFrame, found: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    rows = join_checked(kept, found.select("lang", "source", "tokens", "lang_tokens", "lang_terms"),
                        ["lang", "source"], F.col("term"))
    rows = rows.withColumns({"p": _divided("n", "tokens", "lang_terms"),
                             "q": _divided("all_n", "lang_tokens", "lang_terms")}).where("p > q")
    rows = rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                       _distance("p", "q").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= top)


def _pair_sums(key, rows):
    """One block of terms for two tiles of sources: a sum of f for each pair of them."""
    import pandas as pd

    lang, left, right, _ = key
    heads = rows[rows["term"].isna()].drop_duplicates("place").sort_values("place")
    place, p0 = heads["place"].to_numpy(), heads["p"].to_numpy()
    body = rows[rows["term"].notna()]
    term, names = pd.factorize(body["term"])
    p = np.repeat(p0[:, None], len(names), 1)
    p[np.searchsorted(place, body["place"].to_numpy()), term] = body["p"].to_numpy()
    first, second = np.flatnonzero(place // TILE == left), np.flatnonzero(place // TILE == right)
    out = []
    for a in first:
        others = second[place[second] > place[a]]
        d = p[others] - p[a]
        value = (d * d // (p[others] + p[a])).sum(1)
        out.append(pd.DataFrame({"lang": lang, "a": place[a], "b": place[others], "value": value,
                                 "terms": len(names)}))
    return pd.concat(out) if out else pd.DataFrame(
        {"lang": [], "a": [], "b": [], "value": [], "terms": []})


def pair_distances(kept: DataFrame, found: DataFrame) -> DataFrame:
    """Part ``pair``: both orders of every two sources of a language."""
    blocks = f"CAST(ceil(lang_terms / {BLOCK_TERMS}) AS INT)"
    tiles = F.expr(f"explode(sequence(0, CAST((lang_sources - 1) / {TILE} AS INT)))")
    sized = found.withColumn("lang_sources", F.count(F.lit(1)).over(Window.partitionBy("lang")))
    known = sized.where("lang_terms > 0").select("lang", "source", "place", "tokens", "lang_terms", "lang_sources", "p0")
    body = join_checked(kept.select("lang", "source", "term", "n"), known, ["lang", "source"], F.col("term")).select(
        "lang", "place", "term", _divided("n", "tokens", "lang_terms").alias("p"),
        F.expr(f"CAST(pmod(xxhash64(term), {blocks}) AS INT)").alias("block"), "lang_sources")
    heads = known.select("lang", "place", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"),
                         F.expr(f"explode(sequence(0, {blocks} - 1))").alias("block"), "lang_sources")
    # A row goes to every pair of tiles that holds its own.
    tile = F.expr(f"CAST(place / {TILE} AS INT)")
    rows = body.union(heads).withColumn("tile", tile).withColumn("other", tiles).select(
        "lang", F.least("tile", "other").alias("left_tile"), F.greatest("tile", "other").alias("right_tile"),
        "block", "place", "term", "p")
    sums = rows.groupBy("lang", "left_tile", "right_tile", "block").applyInPandas(
        _pair_sums, "lang string, a int, b int, value long, terms long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    names = found.select("lang", "source", "place", "p0", "lang_terms")
    one = names.select("lang", F.col("place").alias("a"), F.col("source").alias("a_source"), F.col("p0").alias("p"),
                       "lang_terms")
    two = names.select("lang", F.col("place").alias("b"), F.col("source").alias("b_source"), F.col("p0").alias("q"))
    # The result itself: a row for each two sources of a language.
    pairs = one.join(two, "lang").where("a < b").join(sums, ["lang", "a", "b"], "left")
    pairs = pairs.withColumn("value", F.expr(
        "coalesce(value, 0L) + coalesce((lang_terms - coalesce(terms, 0L)) * (((p - q) * (p - q)) div (p + q)), 0L)"))
    pairs = pairs.select("lang", F.expr("inline(array(struct(a_source AS source, b_source AS item), "
                                        "struct(b_source AS source, a_source AS item)))"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank."""
    kept = materialize(kept_terms(docs, min_docs), "divergence-kept")
    found = materialize(groups(docs, kept), "divergence-groups")
    return pair_distances(kept, found).unionByName(overused_terms(kept, found, top))


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(text, '') AS text FROM documents),
tok AS (SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM tok SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT gn.lang, gn.source, kept.term, coalesce(c.n, 0) AS n,
    CAST(1 + (CAST({SCALE} AS HUGEINT) * (coalesce(c.n, 0) + {ADDED})) // (gn.total + {ADDED} * v.v) AS BIGINT) AS p
  FROM gn JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
ln AS (SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM c GROUP BY lang, term),
q AS (SELECT lang, term,
    CAST(1 + (CAST({SCALE} AS HUGEINT) * (n + {ADDED})) // (total + {ADDED} * v.v) AS BIGINT) AS q FROM ln JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p JOIN q USING (lang, term)
  WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER)
  AS rank FROM x)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""

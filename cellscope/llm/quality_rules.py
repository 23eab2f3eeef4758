"""Operator 8: quality rules as one projection.

A threshold table (``RULES``) is compiled into Column expressions over counts of
one text; rows neither move nor meet Python.  Counts are whole numbers and every
rule compares whole numbers (``metric * per <= bound * base``), so a verdict
never hangs on floating point.

Cases: a null, empty or blank text has no words, fails the base rules and isn't
kept.  Repeated rows are judged each for itself.  Columns of the input that clash
with those computed here are replaced by them.  An empty table gives no rows.  Words
are compared by 64-bit hash inside one text (three-word windows).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import WS_CHARS, WS_RUN, words

SYMBOLS = "#*$%&|<>"
UPPER = "A-Z"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in is it that for with as was on are by this be from or an have not "
    "der die das und in zu den von mit ist des im für auf nicht ein eine als auch dem "
    "de la le les des et en un une du que pour dans sur qui par est pas au "
    "el los las y del se por con no una su para es al lo como "
).split()


@dataclass(frozen=True)
class Rule:
    """``metric * per <= bound * base`` ("most") or ``>=`` ("least")."""
    name: str
    metric: str
    per: int
    kind: str
    bound: int
    base: str


# The threshold table.  Ratios are written as per : bound.
RULES = (
    Rule("long_words", "word_chars", 1, "most", 20, "n_words"),
    Rule("short_words", "word_chars", 1, "least", 2, "n_words"),
    Rule("symbols", "n_symbols", 10, "most", 1, "n_words"),
    Rule("stop_words", "n_stop_words", 50, "least", 1, "n_words"),
    Rule("capitals", "n_upper", 2, "most", 1, "word_chars"),
    Rule("same_lines", "n_dup_lines", 2, "most", 1, "n_lines"),
    Rule("list_lines", "n_list_lines", 10, "most", 9, "n_lines"),
    Rule("cut_lines", "n_cut_lines", 10, "most", 3, "n_lines"),
)

MIN_WORDS = 50
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _count_chars(text: Column, chars: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def _windows(h: Column) -> Column:
    """Hashes of the three-word windows, from those of the words."""
    n = F.greatest(F.size(h) - 2, F.lit(0))
    two = F.zip_with(F.slice(h, 1, n), F.slice(h, 2, n), lambda a, b: F.xxhash64(a, b))
    return F.zip_with(two, F.slice(h, 3, n), lambda a, b: F.xxhash64(a, b))


PACKED_BITS = 16            # bits of a window's place in a packed sort key


def _packed_pairs(windows: Column) -> Column:
    """Places (i << 16 | j) of neighbours among the windows sorted by the upper 48 bits of
    their hash, where these are equal; null for a text with too many windows to pack.

    A sort of plain longs is many times faster than one of (hash, place) structs."""
    low = (1 << PACKED_BITS) - 1
    order = F.sort_array(F.transform(windows, lambda x, i: x.bitwiseAND(F.lit(~low).cast("long"))
                                     .bitwiseOR(i.cast("long"))))
    after = F.slice(order, 2, F.greatest(F.size(order) - 1, F.lit(0)))
    pairs = F.filter(F.zip_with(F.slice(order, 1, F.size(after)), after, lambda a, b: F.when(
        F.shiftright(a, PACKED_BITS) == F.shiftright(b, PACKED_BITS),
        F.shiftleft(a.bitwiseAND(F.lit(low).cast("long")), PACKED_BITS).bitwiseOR(
            b.bitwiseAND(F.lit(low).cast("long"))))), lambda p: p.isNotNull())
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.array().cast("array<bigint>")).when(
        F.size(windows) <= low, pairs)


def _covered(starts: Column) -> Column:
    """Words covered by three-word windows at the given sorted places."""
    # Each start covers three words, less where the next start comes sooner.
    reach = F.zip_with(starts, F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))),
                       lambda p, q: F.least(F.lit(3).cast("long"), F.coalesce(q - p, F.lit(3).cast("long"))))
    return F.aggregate(reach, F.lit(0).cast("long"), lambda acc, x: acc + x)


def _repeat_words(windows: Column, pairs: Column) -> Column:
    """Words inside a three-word window that occurs twice or more in the text."""
    def places(p: Column) -> list[Column]:
        return [F.shiftright(p, PACKED_BITS), p.bitwiseAND(F.lit((1 << PACKED_BITS) - 1).cast("long"))]

    # Equal upper bits of different hashes: the whole hashes decide.
    differ = F.exists(pairs, lambda p: F.get(windows, places(p)[0].cast("int"))
                      != F.get(windows, places(p)[1].cast("int")))
    quick = F.sort_array(F.array_distinct(F.flatten(F.transform(pairs, lambda p: F.array(*places(p))))))
    order = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("i"))))
    after = F.slice(order, 2, F.greatest(F.size(order) - 1, F.lit(0)))
    equal = F.filter(F.arrays_zip(order.alias("a"), after.alias("b")), lambda p: p["a"]["h"] == p["b"]["h"])
    whole = F.sort_array(F.array_distinct(F.flatten(
        F.transform(equal, lambda p: F.array(p["a"]["i"], p["b"]["i"])))))
    return F.when(F.size(pairs) == 0, F.lit(0).cast("long")).when(
        pairs.isNull() | differ, _covered(whole)).otherwise(_covered(quick))


def _stop_forms() -> list[str]:
    """Stop words in lower case, capitalised and in capitals."""
    return sorted({f for w in STOP_WORDS for f in (w, w.capitalize(), w.upper())})


def _stop_hashes(spark) -> list[int]:
    """The forms' hashes: a fixed list, compared with the hashes that the windows need anyway."""
    row = spark.range(1).select(F.array(*[F.xxhash64(F.lit(f)) for f in _stop_forms()])).first()
    return list(row[0])


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one boolean Column: true where every rule holds."""
    verdict = F.lit(True)
    for r in rules:
        left, right = F.col(r.metric) * r.per, F.col(r.base) * r.bound
        verdict = verdict & ((left <= right) if r.kind == "most" else (left >= right))
    return verdict


def rules_sql(rules: tuple[Rule, ...] = RULES) -> str:
    return " AND ".join(f"{r.metric} * {r.per} {'<=' if r.kind == 'most' else '>='} {r.base} * {r.bound}"
                        for r in rules)


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with all metrics, ``base_failed`` and ``kept``."""
    t = F.coalesce(F.col(text), F.lit(""))
    counted = docs.withColumn("_words", words(F.col(text))).withColumn(
        "_lines", F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(WS_CHARS)) != ""))
    counted = counted.withColumn("_hashes", F.transform("_words", lambda x: F.xxhash64(x)))
    counted = counted.withColumn("_windows", _windows(F.col("_hashes")))
    counted = counted.withColumn("_pairs", _packed_pairs(F.col("_windows")))
    w, lines = F.col("_words"), F.col("_lines")
    metrics = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": _count_chars(t, SYMBOLS),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(F.col("_windows"), F.col("_pairs")),
        "n_lines": F.size(lines),
        "n_upper": _count_chars(t, UPPER),
        "n_stop_words": F.size(F.filter(F.col("_hashes"), lambda x: x.isin(*_stop_hashes(docs.sparkSession)))),
        "n_list_lines": F.size(F.filter(lines, lambda x: F.substring(x, 1, 2).isin("- ", "* ", "• "))),
        "n_cut_lines": F.size(F.filter(lines, lambda x: x.endswith("...") | x.endswith("…"))),
    }
    out = counted.withColumns({k: v.cast("long") for k, v in metrics.items()})
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                         | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
    out = out.withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
    return out.drop("_words", "_lines", "_hashes", "_windows", "_pairs")


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    from cellscope.llm.common import documents

    return judge(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", *METRICS, "base_failed", "kept")


_STOP_SQL = ", ".join(f"'{w}'" for w in _stop_forms())
ORACLE = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text,
  list_filter(regexp_split_to_array(text, '{WS_RUN}'), lambda x: x <> '') AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
tri AS (SELECT doc_id, i, x, lead(x, 1) OVER (PARTITION BY doc_id ORDER BY i) AS y,
  lead(x, 2) OVER (PARTITION BY doc_id ORDER BY i) AS z FROM g),
rep AS (SELECT doc_id, i FROM tri WHERE z IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, x, y, z) > 1),
cov AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM rep) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws) AS n_words,
  length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
  len(regexp_extract_all(text, '[{SYMBOLS}]')) AS n_symbols,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
  len(ls) AS n_lines, len(regexp_extract_all(text, '[{UPPER}]')) AS n_upper,
  len(list_filter(ws, lambda x: x IN ({_STOP_SQL}))) AS n_stop_words,
  len(list_filter(ls, lambda x: left(x, 2) IN ('- ', '* ', '• '))) AS n_list_lines,
  len(list_filter(ls, lambda x: ends_with(x, '...') OR ends_with(x, '…'))) AS n_cut_lines
  FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND {rules_sql()} AS kept FROM b
"""

r"""Operator 3: toxicity by a fuzzy lexicon in context windows.

* The lexicon is a trie of entries (words and word stems) learned from labelled rows:
  word prefixes that occur in many more documents of label 1 than of label 0, each with
  its log-odds as weight.  It is bounded in size (``MAX_ENTRIES``).
* A Levenshtein automaton of the entry side runs through the trie along the letters
  of a word: the states reached are the (node, edits) pairs, so one walk compares a word
  with every entry.  An entry matches when some prefix of the word is within ``EDITS``
  of it (short entries: 0), which catches misspelled and inflected forms.  Words that
  share neither half of an entry can't be within one edit and skip the walk.
* Every hit is weighed in a window of words around it: quotation marks on both sides
  or a word of speech before it mark a report; words of address, other hits close by
  mark abuse.  A logistic model over these counts, fitted on the sample, gives the score.

The sample for both is bounded (``train_rows``, by a hash of the id, outside the held-out
fold); every row is scored whole, in one pass without a shuffle.

Cases: null and empty texts have no hits and get the score of no hits; without labels of
both classes every score is the share of label 1 (0 without labels); an id with several
labels counts as its largest; repeated rows and null ids: a row each; an empty table
gives no rows; other columns are left aside.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import arrow_batches, documents, fold, map_batches, materialize, training_sample

TRAIN_ROWS = 12_000
MAX_ENTRIES = 2_000
EDITS = 1
FUZZY_LENGTH = 5            # entries shorter than this must match exactly
SHORTEST, LONGEST = 4, 14   # letters of a prefix that may become an entry
WINDOW = 6                  # words looked at on either side of a hit
KNOWN_WORDS = 400_000
THRESHOLD = 0.5

_WORD = re.compile(r"[^\W\d_]+")
_QUOTES = "\"'“”„«»‘’‹›"
# Words that report speech and words that address somebody.
SPEECH = frozenset("said says say saying called calls calling wrote writes quote quoted word term "
                   "sagte sagt nannte wort dit disait mot dijo dice palabra llamó".split())
ADDRESS = frozenset("you your youre yourself u ur du dich dir dein ihr euch tu te toi vous votre "
                    "tú ti usted eres ustedes".split())
NAMES = ("entries", "weight", "top", "hits", "density", "fuzzy", "quoted", "reported", "addressed", "near")


@dataclass
class Entry:
    text: str
    weight: float


class Lexicon:
    """Entries in a trie, searched with edits."""

    def __init__(self, entries: list[Entry]):
        self.entries = entries
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        # First halves, and second halves by the place where one edit may have moved them.
        self.heads: dict[int, set[str]] = {}
        self.tails: dict[tuple[int, int], dict[str, set[str]]] = {}
        for i, e in enumerate(entries):
            node = 0
            for c in e.text:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.ends.append(-1)
                node = self.child[node][c]
            self.ends[node] = i
            fuzzy = len(e.text) >= FUZZY_LENGTH
            half = (len(e.text) + 1) // 2 if fuzzy else len(e.text)
            self.heads.setdefault(half, set()).add(e.text[:half])
            for at in range(half - EDITS, half + EDITS + 1) if fuzzy else ():
                self.tails.setdefault((at, at + len(e.text) - half), {}).setdefault(
                    e.text[half:], set()).add(e.text[:half])

    def _may(self, word: str) -> bool:
        """False only where no entry can match: one edit leaves either the first half of
        an entry as it is, or the second half, moved by one place at most, and all but
        one letter of the first."""
        for n, heads in self.heads.items():
            if word[:n] in heads:
                return True
        for (a, b), tails in self.tails.items():
            halves = tails.get(word[a:b])
            if halves is not None:
                before = word[:a]
                for half in halves:
                    if sum(c in before for c in half) >= len(half) - EDITS:
                        return True
        return False

    def find(self, word: str) -> tuple[int, int] | None:
        """(entry, edits) of the best match of a prefix of ``word``, or None."""
        if len(word) < SHORTEST or not self._may(word):
            return None
        best = None
        states = self._close({0: 0})
        for at in range(len(word) + 1):
            for node, edits in states.items():
                i = self.ends[node]
                if i >= 0 and (not edits or len(self.entries[i].text) >= FUZZY_LENGTH):
                    rank = (edits, -self.entries[i].weight, i)
                    if best is None or rank < best:
                        best = rank
            if at == len(word) or not states:
                break
            c, after = word[at], {}
            for node, edits in states.items():
                step = self.child[node].get(c)
                if step is not None and after.get(step, EDITS + 1) > edits:
                    after[step] = edits
                if edits < EDITS:
                    # A letter too many in the word, or another letter than the entry's.
                    for other in (node, *self.child[node].values()):
                        if after.get(other, EDITS + 1) > edits + 1:
                            after[other] = edits + 1
            states = self._close(after)
        return None if best is None else (best[2], best[0])

    def _close(self, states: dict[int, int]) -> dict[int, int]:
        """Adds the states after leaving out letters of the entry."""
        todo = [(n, e) for n, e in states.items() if e < EDITS]
        while todo:
            node, edits = todo.pop()
            for other in self.child[node].values():
                if states.get(other, EDITS + 1) > edits + 1:
                    states[other] = edits + 1
                    if edits + 1 < EDITS:
                        todo.append((other, edits + 1))
        return states


class _Found(dict):
    """Matches of words seen before."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str):
        if len(self) >= KNOWN_WORDS:
            self.clear()
        hit = self[word] = self.lexicon.find(word)
        return hit


def evidence(text: str, found: _Found) -> list[float]:
    """The counts a text is judged by, in the order of NAMES."""
    low = text.lower()
    words = _WORD.findall(low)
    # Most texts have no hit: look at their distinct words only.
    hit_words = {w for w in set(words) if found[w] is not None}
    if not hit_words:
        return [0.0] * len(NAMES)
    hits = [i for i, w in enumerate(words) if w in hit_words]
    match = {i: found[words[i]] for i in hits}
    entries = found.lexicon.entries
    spans = _spans(low, set(hits))
    exact = {match[i][0] for i in hits if not match[i][1]}
    kinds = exact | {match[i][0] for i in hits}
    weights = [entries[k].weight * (1.0 if k in exact else 0.5) for k in kinds]
    quoted = reported = addressed = near = 0
    for n, i in enumerate(hits):
        a, b = spans[i]
        in_quotes = low[max(0, a - 40):a].rstrip()[-1:] in _QUOTES and a > 0 or _inside(low, a, b)
        around = words[max(0, i - WINDOW):i]
        after = words[i + 1:i + 1 + WINDOW]
        quoted += bool(in_quotes)
        reported += any(w in SPEECH for w in around)
        addressed += any(w in ADDRESS for w in around) or any(w in ADDRESS for w in after)
        near += n > 0 and i - hits[n - 1] <= WINDOW
    h = len(hits)
    return [float(len(kinds)), sum(weights), max(weights), np.log1p(h), 100.0 * h / len(words),
            sum(match[i][1] > 0 for i in hits) / h, quoted / h, reported / h, addressed / h, near / h]


def _spans(low: str, wanted: set[int]) -> dict[int, tuple[int, int]]:
    return {i: m.span() for i, m in enumerate(_WORD.finditer(low)) if i in wanted}


def _inside(low: str, a: int, b: int) -> bool:
    """Whether a quotation mark opens shortly before and one closes shortly after."""
    before, after = low[max(0, a - 40):a], low[b:b + 40]
    return any(q in before for q in _QUOTES[:9]) and any(q in after for q in _QUOTES[:9])


def _prefix_counts(sample: DataFrame) -> DataFrame:
    """entry, n1, n0: in how many documents of each class a word starts with it."""
    def run(batches):
        counts = (Counter(), Counter())
        for batch in arrow_batches(batches, "text"):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                seen = set()
                for w in set(_WORD.findall((text or "").lower())):
                    for n in range(SHORTEST, min(len(w), LONGEST) + 1):
                        seen.add(w[:n])
                counts[label].update(seen)
            if len(counts[0]) + len(counts[1]) > 500_000:
                yield _emit(counts)
                counts[0].clear()
                counts[1].clear()
        yield _emit(counts)

    def _emit(counts):
        import pyarrow as pa

        keys = list(counts[0].keys() | counts[1].keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([counts[1][k] for k in keys], pa.int64()),
             pa.array([counts[0][k] for k in keys], pa.int64())], ["entry", "n1", "n0"])

    return map_batches(sample, run, "entry string, n1 long, n0 long").groupBy("entry").agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def learn_lexicon(sample: DataFrame, size1: int, size0: int) -> list[Entry]:
    """Prefixes with clear evidence; of those that say the same, the longest."""
    expected = (F.col("n0") + 0.5) / F.lit(float(size0 + 1)) * size1
    weight = F.log((F.col("n1") + 0.5) / F.lit(float(size1 + 1))) - F.log(
        (F.col("n0") + 0.5) / F.lit(float(size0 + 1)))
    clear = (F.col("n1") - expected) / F.sqrt(expected + 1)
    rows = _prefix_counts(sample).where(F.col("n1") >= 4).select(
        "entry", "n1", "n0", weight.alias("weight"), clear.alias("clear"))
    rows = rows.where("clear >= 5 AND weight >= 1.5").orderBy(F.col("clear").desc(), "entry").limit(
        4 * MAX_ENTRIES).collect()
    support = {r.entry: r.n1 for r in rows}
    extended = {r.entry[:-1] for r in rows if r.n1 >= 0.9 * support.get(r.entry[:-1], float("inf"))}
    out, kept = [], {}
    for r in sorted(rows, key=lambda r: (len(r.entry), r.entry)):
        # A longer form says no more than a kept stem unless it is much purer.
        if r.entry in extended:
            continue
        stem = next((r.entry[:n] for n in range(len(r.entry) - 1, SHORTEST - 1, -1) if r.entry[:n] in kept), None)
        if stem is not None and r.weight < kept[stem] + 1.0:
            continue
        kept[r.entry] = r.weight
        out.append(Entry(r.entry, float(r.weight)))
        if len(out) == MAX_ENTRIES:
            break
    return out


@dataclass
class Model:
    entries: list[Entry]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple:
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    theta = np.zeros(z.shape[1])
    penalty = np.diag([ridge] * (z.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        move = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (p - y) + penalty @ theta)
        theta -= move
        if np.abs(move).max() < 1e-8:
            break
    return mean, scale, theta[:-1], float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    sample = materialize(training_sample(docs, labels, "toxic", train_rows), "tox-sample")
    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    size1, size0 = sizes.get(1, 0), sizes.get(0, 0)
    zero = np.zeros(len(NAMES))
    if not size1 or not size0:
        share = min(max(size1 / max(1, size1 + size0), 1e-6), 1 - 1e-6)
        return Model([], zero, zero + 1, zero, float(np.log(share / (1 - share))))
    entries = learn_lexicon(sample, size1, size0)
    # Evidence of the sample: ten numbers a row, a bounded number of rows.
    rows = _evidence(sample, entries, ["doc_id", "label"]).orderBy("doc_id").collect()
    x = np.array([r.evidence for r in rows])
    return Model(entries, *fit_logistic(x, np.array([r.label for r in rows], float)))


def _evidence(docs: DataFrame, entries: list[Entry], keep: list[str]) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        found = _Found(Lexicon(entries))
        for batch in arrow_batches(batches, "text"):
            rows = [evidence(t or "", found) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(rows, pa.list_(pa.float64()))], [*keep, "evidence"])

    kinds = dict(docs.dtypes)
    return map_batches(docs.select(*keep, "text"),
        run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", evidence array<double>")


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` columns plus score and predicted."""
    names = docs.columns

    def run(batches):
        import pyarrow as pa

        found = _Found(Lexicon(model.entries))
        for batch in arrow_batches(batches, "text"):
            x = np.array([evidence(t or "", found) for t in batch.column("text").to_pylist()])
            s = model.scores(x)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(s, pa.float64()),
                 pa.array((s >= threshold).astype(np.int32))], [*names, "score", "predicted"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return map_batches(docs, run, f"{kinds}, score double, predicted int")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")

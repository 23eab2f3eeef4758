r"""Operator 10: quality classifier by naive Bayes support vectors.

A text is a set of n-gram indicators, hashed into ``DIMS`` dimensions: words, word
pairs, and 3- and 5-grams over its run-length-collapsed shape (letters, capitals, digits,
each punctuation mark), and coarse steps of how often words and pairs recur.  Each
indicator is scaled by its class log-count ratio; a linear L2-regularised hinge-loss
model is fitted by dual coordinate descent and averaged with its mean magnitude;
a logistic curve fitted on rows kept aside turns margins into scores.

The fit uses a bounded sample of labelled rows (``train_rows``, chosen by a hash of
the id); every row is scored, in one pass without a shuffle.

Cases: null and empty texts have no indicators and get the score of the bias;
rows without a label are scored and never learned from; an id with several labels
counts as its largest; without labels of both classes every score is the share of
label 1 (0.5 without labels); repeated rows and null ids: a row each; an empty
table gives no rows; other columns are left aside.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import Words, arrow_batches, documents, fold, map_batches, mix64, training_sample, utf8

DIMS = 1 << 17
TRAIN_ROWS = 12_000         # labelled rows that the fit reads at most, about
KEEP_ASIDE = 5              # every fifth of them fits the logistic curve
COST = 1.0
EPOCHS = 12
MODEL_SHARE = 0.75          # share of the fitted weights, the rest is their mean magnitude
THRESHOLD = 0.3
BATCH_BYTES = 1 << 20       # texts worked on at once: the n-gram hashes take some 40 bytes for each


def _shape_table() -> np.ndarray:
    """Byte -> shape class: letters 1, capitals 2, digits 3, white space 4, newline 5, others themselves."""
    t = np.arange(256).astype(np.uint8)
    t[97:123], t[65:91], t[48:58], t[128:] = 1, 2, 3, 1
    t[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], t[0x0A] = 4, 5
    return t


_SHAPE = _shape_table()


def _grams(x: np.ndarray, n: int, salt: int) -> np.ndarray:
    if len(x) < n:
        return np.zeros(0, np.uint64)
    acc = np.full(len(x) - n + 1, salt, np.uint64)
    for j in range(n):
        acc = mix64(acc * np.uint64(3) + x[j:len(x) - n + 1 + j])
    return acc


def indicators(texts):
    """For each text the sorted distinct dimensions of its indicators."""
    w = Words(texts)
    data, offsets = utf8(texts)
    shape = _SHAPE[data]
    change = np.append(True, shape[1:] != shape[:-1]) if len(shape) else np.zeros(0, bool)
    starts = offsets[:-1]
    change[starts[starts < len(shape)]] = True
    at = np.flatnonzero(change)
    runs = shape[at].astype(np.uint64)
    run_first = np.searchsorted(at, offsets)
    mask = np.uint64(DIMS - 1)
    with np.errstate(over="ignore"):
        pairs = mix64(w.hashes[:-1] * np.uint64(7) + w.hashes[1:]) if len(w.hashes) > 1 else w.hashes[:0]
        three, five = _grams(runs, 3, 11), _grams(runs, 5, 13)
        seen = np.zeros(DIMS, bool)
        for r in range(w.rows):
            a, b = int(w.first[r]), int(w.first[r + 1])
            c, d = int(run_first[r]), int(run_first[r + 1])
            if b == a:
                yield np.zeros(0, np.int32)
                continue
            seen[:] = False
            words, two = w.hashes[a:b], pairs[a:max(a, b - 1)]
            for part in (words, two, three[c:max(c, d - 2)], five[c:max(c, d - 4)]):
                seen[(part & mask).astype(np.int64)] = True
            steps = [1 + int(8 * len(np.unique(words)) / len(words)),
                     20 + (int(8 * len(np.unique(two)) / len(two)) if len(two) else 9),
                     40 + int(8 * np.count_nonzero(words[1:] == words[:-1]) / len(words)),
                     60 + min(12, int(np.log2(len(words))))]
            seen[(mix64(np.array(steps, np.uint64) + np.uint64(977)) & mask).astype(np.int64)] = True
            yield np.flatnonzero(seen).astype(np.int32)


def packed_row(idx: np.ndarray) -> bytes:
    """A row's dimensions in DIMS / 8 bytes at most: a list, or a bitmap where that is smaller."""
    if 4 * len(idx) < DIMS // 8:
        return idx.astype("<i4").tobytes()
    bits = np.zeros(DIMS, np.uint8)
    bits[idx] = 1
    return np.packbits(bits).tobytes()


def dimensions(row) -> np.ndarray:
    """The dimensions of a row as they are, or from :func:`packed_row`."""
    if isinstance(row, np.ndarray):
        return row
    if len(row) == DIMS // 8:
        return np.flatnonzero(np.unpackbits(np.frombuffer(row, np.uint8))).astype(np.int32)
    return np.frombuffer(row, "<i4")


class Model:
    """Weights by dimension, bias, and the logistic curve (slope, shift)."""

    def __init__(self, weights, bias, slope, shift):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def score(self, idx: np.ndarray) -> float:
        margin = (self.weights[idx].sum() / np.sqrt(len(idx)) if len(idx) else 0.0) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, dims: int = DIMS) -> np.ndarray:
    p, q = np.ones(dims), np.ones(dims)
    for row, label in zip(rows, y):
        (p if label else q)[dimensions(row)] += 1
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_descent(rows, y, ratio, cost=COST, epochs=EPOCHS, seed=7):
    """Linear L2-loss SVM by coordinate descent on its dual; rows are scaled indicators."""
    sign = np.where(y, 1.0, -1.0)
    share = max(1, int(y.sum())), max(1, int(len(y) - y.sum()))
    soft = np.where(y, share[0], share[1]) * 2.0 / len(y) / (2 * cost)
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(y))
    norm = np.array([(ratio[idx] ** 2).sum() / max(1, len(idx)) + 1.0 for idx in map(dimensions, rows)]) + soft
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            idx = dimensions(rows[i])
            x = ratio[idx] / np.sqrt(max(1, len(idx)))
            slack = sign[i] * (w[idx] @ x + bias) - 1 + soft[i] * alpha[i]
            new = max(alpha[i] - slack / norm[i], 0.0)
            if new != alpha[i]:
                move = (new - alpha[i]) * sign[i]
                w[idx] += move * x
                bias += move
                alpha[i] = new
    return w, bias


def logistic_curve(margin: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of P(1 | margin), by Newton steps with a weak prior."""
    x = np.stack([margin, np.ones_like(margin)], 1)
    theta = np.zeros(2)
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (p - target) + 1e-3 * theta
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        theta -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def fit(rows: list[np.ndarray], y: np.ndarray) -> Model:
    y = np.asarray(y, bool)
    if y.all() or not y.any():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(DIMS), 0.0, 0.0, float(np.log(share / (1 - share))))
    aside = np.arange(len(y)) % KEEP_ASIDE == 0
    if y[aside].all() or not y[aside].any() or y[~aside].all() or not y[~aside].any():
        aside = np.zeros(len(y), bool)
    learn = [r for r, a in zip(rows, aside) if not a]
    ratio = log_count_ratios(learn, y[~aside])
    w, bias = dual_descent(learn, y[~aside], ratio)
    mean = np.abs(w).mean()
    weights = ratio * ((1 - MODEL_SHARE) * mean + MODEL_SHARE * w)
    model = Model(weights, bias, 1.0, 0.0)
    judge = aside if aside.any() else ~aside
    margin = np.array([(weights[r].sum() / np.sqrt(max(1, len(r)))) + bias
                       for r in (dimensions(row) for row, j in zip(rows, judge) if j)])
    model.slope, model.shift = logistic_curve(margin, y[judge])
    return model


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most about ``train_rows`` labelled documents outside the held-out fold."""
    sample = training_sample(docs, labels, "quality", train_rows)

    def run(batches):
        import pyarrow as pa

        for batch in arrow_batches(batches, "text", BATCH_BYTES):
            rows = [packed_row(x) for x in indicators(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())],
                ["doc_id", "label", "row"])

    kind = dict(sample.dtypes)["doc_id"]
    # About train_rows rows of DIMS / 8 bytes (16 KB) at most, however long the texts.
    got = map_batches(sample, run, f"doc_id {kind}, label int, row binary").toArrow()
    got = sorted(zip(got["doc_id"].to_pylist(), got["label"].to_pylist(), got["row"].to_pylist()))
    return fit([row for _, _, row in got], np.array([label for _, label, _ in got], bool))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` columns plus score and predicted."""
    names = docs.columns

    def run(batches):
        import pyarrow as pa

        for batch in arrow_batches(batches, "text", BATCH_BYTES):
            s = [model.score(x) for x in indicators(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(s, pa.float64()),
                 pa.array([int(x >= threshold) for x in s], pa.int32())], [*names, "score", "predicted"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return map_batches(docs, run, f"{kinds}, score double, predicted int")


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")

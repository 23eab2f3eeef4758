import random
import zlib

import numpy as np
import pyarrow as pa

from cellscope.llm import quality_classifier as qc
from tests.llm import cases


def corpus(n=500, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = cases.prose(rng, rng.randrange(20, 120))
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", " | "),
                               " ".join(w + "%%%" for w in text.split(" "))])
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def test_indicators_are_sets_of_the_whole_text():
    a, b, c, none = qc.indicators(pa.array(["the cat sat", "the cat sat on", "THE!! CAT", None]))
    assert (np.diff(a) > 0).all() and not len(none)
    assert len(np.intersect1d(a, b)) > len(np.intersect1d(a, c))
    long = "the cat sat " * 100_000 + "unheard"
    x, y = qc.indicators(pa.array(["the cat sat " * 100_000, long]))
    assert len(np.setdiff1d(y, x))


def test_dual_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(5)
    rows = [np.flatnonzero(rng.random(12) < 0.4) for _ in range(60)]
    y = np.array([len(np.intersect1d(r, [0, 1, 2])) > 1 for r in rows])
    ratio = np.ones(12)
    w, bias = qc.dual_descent(rows, y, ratio, cost=1.0, epochs=300)
    x = np.zeros((60, 13))
    for i, r in enumerate(rows):
        x[i, r], x[i, 12] = 1 / np.sqrt(max(1, len(r))), 1
    sign = np.where(y, 1, -1)
    soft = np.where(y, y.sum(), (~y).sum()) * 2.0 / len(y) / 2
    loss = lambda v: v @ v / 2 + (np.maximum(0, 1 - sign * (x @ v)) ** 2 / (2 * soft)).sum()
    best = loss(np.append(w, bias))
    for _ in range(300):
        assert best <= loss(np.append(w, bias) + rng.normal(size=13) * 0.05) + 1e-6


def test_learns_from_rows_outside_the_fold_and_holds_out(spark):
    rows, labels = corpus()
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    docs = cases.documents(spark, rows, extra=False).select("doc_id", "text")
    model = qc.train(docs, cases.labels(spark, turned))
    got = {r.doc_id: r for r in qc.score(docs, model).collect()}
    assert sum(got[i].predicted == q for i, q, _ in labels) >= 0.98 * len(labels)
    again = qc.train(docs, cases.labels(spark, turned))
    assert (again.weights == model.weights).all() and again.slope == model.slope


def test_sample_is_bounded(spark):
    rows, labels = corpus(400)
    sample = qc.training_sample(cases.documents(spark, rows), cases.labels(spark, labels), "quality", 50)
    assert 20 <= sample.count() <= 90


def test_edges(spark):
    rows, labels = corpus(200)
    model = qc.train(cases.documents(spark, rows), cases.labels(spark, [*labels, labels[0], (None, 1, 1)]))
    docs = cases.documents(spark).select("doc_id", "text")
    got = qc.score(docs, model).collect()
    assert len(got) == len(cases.edge_texts()) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not (r.text or "").strip()}) == 1
    assert qc.score(cases.empty(spark).select("doc_id", "text"), model).collect() == []
    for none in ([], [(1, None, 0)], [(1, 1, 0), (7, 1, 0)]):
        flat = qc.train(docs, cases.labels(spark, none))
        assert len({r.score for r in qc.score(docs, flat).collect()}) == 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in qc.op10_quality_classifier(spark, sf).collect()}
    held = [(r.quality, got[r.doc_id].predicted) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()
            if got[r.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.93 * len(held)


def test_rows_travel_in_bounded_bytes():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 4095, 4096, 4097, 50_000, qc.DIMS):
        idx = np.sort(rng.choice(qc.DIMS, n, replace=False)).astype(np.int32)
        row = qc.packed_row(idx)
        assert len(row) <= qc.DIMS // 8 and (qc.dimensions(row) == idx).all()

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cellscope.llm import ngram_lm as lm
from tests.llm import cases
from tests.llm.test_common import LOWER, PATTERN


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), min_size=1, max_size=300))
def test_elias_fano_gives_back_the_sequence(values):
    values = np.sort(np.array(values, np.int64))
    assert (lm.EliasFano.build(values).get(np.arange(len(values))) == values).all()


@settings(max_examples=80, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 60), st.integers(0, 60)), max_size=200))
def test_trie_finds_its_pairs_and_no_other(pairs):
    order = sorted(pairs)
    u, v = (np.array([p[i] for p in order], np.int64) for i in (0, 1))
    logp = -np.arange(len(order), dtype=float) / 50
    trie = lm.Trie(u, v, logp)
    every = [(a, b) for a in range(62) for b in range(62)]
    got = trie.find(*(np.array([p[i] for p in every], np.int64) for i in (0, 1)))
    assert {p for p, x in zip(every, got) if not np.isnan(x)} == pairs
    if order:
        assert np.abs(trie.find(u, v) - logp).max() < 0.1


def test_quantised_values_are_near():
    x = np.random.default_rng(1).normal(size=20_000)
    book, codes = lm.quantise(x)
    assert codes.max() <= 255 and np.abs(book[codes] - x).mean() < 0.02


def brute(rows, classes, hot):
    """Counts and scores of all rows, straight from the definitions."""
    toks = [PATTERN.findall((t or "").translate(LOWER)) for _, t in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for t, h in zip(toks, held) if not h for w in t)
    texts = held.count(False)
    n, v = sum(c.values()) + texts, len(c) + (texts > 0)
    steps = Counter(math.floor(math.log2(x) * 8) for x in c.values())
    room, least = classes, None
    for s in sorted(steps, reverse=True):
        room -= steps[s]
        if room < 0:
            break
        least = s
    own = {w for w, x in c.items() if least is not None and math.floor(math.log2(x) * 8) >= least}
    cls = lambda w: w if w in own else 2
    count = Counter({0: texts, 1: texts, 2: sum(x for w, x in c.items() if w not in own)})
    count.update({w: c[w] for w in own})
    total = sum(x + 0.5 for k, x in count.items() if k != 0)
    p1 = lambda x: (count[x] + 0.5) / total
    pairs = Counter()
    seqs = []
    for t, h in zip(toks, held):
        seq = [0, *map(cls, t), 1]
        seqs.append(seq)
        if not h:
            pairs.update(zip(seq, seq[1:]))
    rare_n, rare_v = count[2], len(c) - len(own)
    out = []
    for (i, _), t, h, seq in zip(rows, toks, held, seqs):
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t) + math.log10((texts + 1) / (n + v + 1))
        score = sum(math.log10((pairs[a, b] + lm.MU * p1(b)) / (count[a] + lm.MU)) for a, b in zip(seq, seq[1:]))
        score += sum(math.log10((c[w] + 1) / (rare_n + rare_v + 1)) for w in t if w not in own)
        out.append((i, h, len(t) + 1, sum(c[w] > 0 for w in t) + (texts > 0), n, base, score))
    return out


@pytest.mark.parametrize("classes,hot", [(65_000, 512), (12, 4), (0, 2)])
def test_scores_equal_brute_force(spark, monkeypatch, classes, hot):
    monkeypatch.setattr(lm, "CLASSES", classes)
    monkeypatch.setattr(lm, "HOT", hot)
    rng = random.Random(4)
    rows = cases.edge_texts() + [(100 + i, cases.prose(rng, rng.randrange(60))) for i in range(60)]
    got = sorted(map(tuple, lm.score(cases.documents(spark, rows)).collect()), key=str)
    want = brute(rows, classes, hot)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[2], round(r[5], 3))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-6)
        # Log probabilities of pairs are quantised: 256 steps for each shard.
        assert a[6] == pytest.approx(b[6], rel=0.02, abs=0.05)


def test_no_word_is_dropped_into_a_shared_class(spark, monkeypatch):
    """With few words in every task's table, all words still have pairs of their own."""
    rng = random.Random(5)
    rows = cases.edge_texts() + [(100 + i, cases.prose(rng, rng.randrange(60))) for i in range(60)]
    rows += [(300 + i, "zyx wvu zyx wvu") for i in range(12)]
    want = brute(rows, 10 ** 9, None)
    key = lambda r: (str(r[0]), r[2], round(r[5], 3))
    for table, hot in ((65_000, 512), (12, 4), (0, 2)):
        monkeypatch.setattr(lm, "TABLE", table)
        monkeypatch.setattr(lm, "HOT", hot)
        got = list(map(tuple, lm.score(cases.documents(spark, rows)).collect()))
        assert len(got) == len(want)
        for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
            assert a[:5] == b[:5]
            assert a[5] == pytest.approx(b[5], abs=1e-6)
            assert a[6] == pytest.approx(b[6], rel=0.03, abs=0.2)      # quantised, 256 steps a shard


def test_without_training_rows_and_empty(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    got = lm.score(cases.documents(spark, [(i, "a b a") for i in held])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(4, 0, 0)] * 3
    assert all(math.isfinite(r.score) and r.base_score == 0.0 for r in got)
    assert lm.score(cases.empty(spark)).collect() == []


def test_model_beats_the_base_on_held_out_rows(spark):
    got = [r for r in lm.op4_ngram_lm(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in got) > 0.97 * sum(r.base_score for r in got)


def test_word_pattern():
    assert re.fullmatch(PATTERN, "a\x1cb")


def small_model():
    model = lm.Counts(np.arange(10, 14, dtype=np.uint64), np.array([9, 7, 5, 3]), 1000, 300, 20, False)
    model.hot = np.zeros(model.n_hot ** 2)
    return model


def test_a_task_holds_few_arrays_of_a_full_shard():
    """Two tasks of a 3 GB executor share what its heap leaves.  A document has one row of a shard's."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(2)
    n, parts, sent = lm.SHARD_PAIRS // 2, -(-lm.SHARD_PAIRS // lm.PART_PAIRS), []
    for kind in (0, 1):
        v = rng.integers(3, 7, n) if kind == 0 else rng.integers(1 << 63, (1 << 63) + 90_000, n, np.uint64)
        pairs = rng.integers(3, 7, n).astype(np.uint64), v.astype(np.uint64), rng.integers(0, 5000, n).astype(np.uint32)
        sent += [(0, 0, kind, raw) for _, raw in lm._by_shard(*pairs, np.ones(n, np.uint32), 1, parts, kind == 1)]
    table = pa.table(dict(zip(("shard", "base", "kind", "payload"), zip(*sent))))
    tracemalloc.start()
    got = lm._answer(small_model(), parts)(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.num_rows == 2500 and peak < 120e6


def test_parts_of_a_shard_add_up(spark, monkeypatch):
    rng = random.Random(8)
    rows = cases.edge_texts() + [(100 + i, cases.prose(rng, rng.randrange(60))) for i in range(60)]
    want = brute(rows, 10 ** 9, None)
    monkeypatch.setattr(lm, "TABLE", 12)
    monkeypatch.setattr(lm, "HOT", 4)
    monkeypatch.setattr(lm, "MIN_SHARDS", 3)
    monkeypatch.setattr(lm, "PART_PAIRS", 90)
    got = list(map(tuple, lm.score(cases.documents(spark, rows)).collect()))
    key = lambda r: (str(r[0]), r[2], round(r[5], 3))
    assert len(got) == len(want) and want[0][4] > 3 * 90 * 2
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-6)
        assert a[6] == pytest.approx(b[6], rel=0.03, abs=0.2)      # quantised, 256 steps a part


def test_slices_of_a_batch_send_what_the_batch_would(monkeypatch):
    import pyarrow as pa
    import pyspark

    monkeypatch.setattr(pyspark, "TaskContext", type("Fake", (), {"get": classmethod(lambda c: c()),
                                                                  "partitionId": lambda self: 3}))
    rng = random.Random(6)
    texts = [cases.prose(rng, rng.randrange(200)) for _ in range(60)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array([None, *range(61)], pa.int64()), "train": [i % 3 > 0 for i in range(62)],
        "text": pa.array(texts, pa.string())})

    def sent():
        out = []
        for b in lm._sender(small_model(), 5, 2)([batch]):
            for s, at, kind, raw in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 2:
                    out.append((s, at, kind, raw))
                else:
                    out += [(s, at, kind, p, *map(int, x)) for p in (0, 1) for x in zip(*lm._unpack(raw, p))]
        return sorted(out, key=lambda r: (r[:3], r[3:] if r[2] < 2 else ()))

    whole = sent()
    monkeypatch.setattr(lm, "SLICE_BYTES", 500)
    assert sent() == whole and len({r[0] for r in whole}) == 5

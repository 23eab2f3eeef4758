import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cellscope.llm import packing, source_divergence
from tests.llm import cases

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, min_docs, top):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]
        groups[lang].add(source)
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        every = sum((count[lang, s] for s in sources), Counter())

        def shares(counts):
            whole = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // whole for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: shares(count[lang, s]) for s in sources}, shares(every)
        for s in sources:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, f(p[s][t], q[t])) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(found)
                        if part == "pair" or i < top]
    return sorted(out)


def rows_of(seed, n=160):
    rng = random.Random(seed)
    words = ["the", "The", "river", "Straße", "ÉCOLE", "日本語", "a", "internationalisation", "x" * 17, "ab-cd", "e1f",
             "Überwachungskamerasystem", "é" * 8, "q" * 16, "z" * 300]
    return [(i, None if rng.random() < 0.05 else " ".join(rng.choices(words, k=rng.randrange(0, 25))),
             rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "", None, "ß", "Z"])) for i in range(n)]


@pytest.mark.parametrize("seed,small", [(1, False), (2, True)])
def test_equals_brute_force(spark, monkeypatch, seed, small):
    """With small limits: many merges and flushes, several tiles and blocks."""
    if small:
        for name, value in (("MERGE", 20), ("BLOCK_TERMS", 3), ("TILE", 2)):
            monkeypatch.setattr(source_divergence, name, value)
        monkeypatch.setattr("cellscope.llm.common.BATCH_BYTES", 500)
    rows = rows_of(seed)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS term", "1 AS n", "2 AS place", "3 AS p0").repartition(3)
    got = source_divergence.divergence(df, 10, 4)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10, 4)


def test_edges(spark):
    rows = [(i, t, "en", None if i == 6 else f"s{(i or 0) % 3}") for i, t in cases.edge_texts()]
    rows += [(50, "only here", "fr", "s1"), (51, None, "it", "s1"), (52, "", "it", "s2"), (53, "!?", None, None)]
    for least in (1, 2, 100):
        got = source_divergence.divergence(spark.createDataFrame(rows, SCHEMA), least)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, 10)
    assert source_divergence.divergence(cases.empty(spark)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=16).filter(lambda b: 0 not in b), max_size=40))
def test_packed_terms_order_as_bytes_and_come_back(terms):
    data = np.frombuffer(b"".join(terms), np.uint8)
    length = np.array([len(t) for t in terms], np.int64)
    high, low = packing.packed(data, np.cumsum(length) - length, length)
    order = packing.radix_order([low, high])
    assert [terms[i] for i in order] == sorted(terms)
    raw, offsets = packing.unpacked(high, low)
    assert [bytes(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == terms
    start = packing.run_starts([high[order], low[order]])
    assert [terms[order[i]] for i in start] == sorted(set(terms))

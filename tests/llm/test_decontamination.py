import itertools
import random
import re

import pytest

from cellscope.llm import decontamination as dc
from tests.llm import cases


@pytest.mark.parametrize("w", range(dc.MIN_TOKENS, dc.WINDOW + 1))
def test_masks_find_every_overlap_the_rule_allows(w):
    """Wherever floor(20 % of w) substitutions stand, some mask at some place avoids them."""
    placed = [sum(1 << (at + x) for x in m) for m in dc.MASKS for at in range(w - dc.SPAN + 1)]
    for bad in itertools.combinations(range(w), w * (100 - dc.PERCENT) // 100):
        hit = sum(1 << x for x in bad)
        assert any(not p & hit for p in placed)


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items):
    """Best overlap of every document and distinct item, by all alignments."""
    best = {}
    distinct = {}
    for i, t in items:
        tk = tuple(tokens(t))
        if tk:
            distinct[tk] = min(i, distinct.get(tk, i))
    for (d, text), (item, i) in itertools.product(docs, distinct.items()):
        doc, w = tokens(text), min(len(item), dc.WINDOW)
        for p in range(len(doc) - w + 1):
            for q in range(len(item) - w + 1):
                same = sum(a == b for a, b in zip(doc[p:p + w], item[q:q + w]))
                if same * 100 >= w * (dc.PERCENT if len(item) >= dc.MIN_TOKENS else 100):
                    best[d, i] = max(best.get((d, i), 0), same)
    return best


def corpus(spark, monkeypatch, piece):
    monkeypatch.setattr(dc, "PIECE", piece)
    monkeypatch.setattr(dc, "FILTER_BITS", 1 << 14)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)] + ["the", "of", "and"] * 5
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([12, 13, 17, 20, 25, 31, 5])] + [(7, None), (8, "")]
    items += [(9, items[3][1]), (10, items[3][1].upper() + "!")]
    docs = []
    for d in range(60):
        item = tokens(items[rng.randrange(7)][1])
        for _ in range(rng.randrange(5)):
            item[rng.randrange(len(item))] = rng.choice(words)
        cut = item[rng.randrange(3):] if rng.random() < 0.3 else item
        docs.append((d, text(rng.randrange(30)) + " " + ", ".join(cut) + ". " + text(rng.randrange(30))))
    return docs, items


@pytest.mark.parametrize("piece", [4096, 7])
def test_overlaps_equal_brute_force(spark, monkeypatch, piece):
    docs, items = corpus(spark, monkeypatch, piece)
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.matched for r in dc.overlaps(cases.documents(spark, docs), frame).collect()}
    want = brute(docs, items)
    assert got == want and len(want) > 20
    equal = {r.item_id: r.n_items for r in dc.overlaps(cases.documents(spark, docs), frame).collect()}
    assert equal.get(3) == 3 and 9 not in equal


@pytest.mark.parametrize("piece", [64, 3])
def test_short_items_are_found_word_for_word(spark, monkeypatch, piece):
    monkeypatch.setattr(dc, "PIECE", piece)
    items = [(1, "What is the capital of France?"), (2, "yes"), (3, "one two"), (4, "YES!"),
             (5, "a b c d e f g h i j k"), (6, " ".join(f"w{i}" for i in range(15)))]
    docs = [(1, "so: what IS the, capital of france"), (2, "what is the capital of spain france"), (3, "yes"), (4, None),
            (5, "one three two one two. one two"), (6, "x a b c d e f g h i j k y"), (7, "a b c d e f g h i j"),
            (8, " ".join(f"w{i}" for i in range(14))), (None, "oh yes"), (9, "word " * 200 + "one two")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.matched, r.n_items) for r in dc.overlaps(cases.documents(spark, docs), frame).collect()}
    assert {k: m for k, (m, _) in got.items()} == brute(docs, items)
    assert {(1, 1), (3, 2), (None, 2), (5, 3), (9, 3), (6, 5)} == set(got) and got[3, 2] == (1, 2)


def test_edges(spark):
    rows = cases.edge_texts()
    quote = " ".join(rows[0][1].split()[20:60])
    items = spark.createDataFrame([(1, quote), (2, None), (3, "short"), (None, "x " * 20)], "item_id long, text string")
    got = dc.overlaps(cases.documents(spark, rows), items).collect()
    assert sorted(r.doc_id for r in got if r.item_id == 1) == [1, 8, 11] and not any(r.item_id == 2 for r in got)
    assert dc.overlaps(cases.empty(spark), items).collect() == []
    assert dc.overlaps(cases.documents(spark, rows), items.limit(0)).collect() == []


def test_long_documents_are_searched_whole(spark):
    rows = cases.edge_texts()
    words = rows[4][1].split()
    items = spark.createDataFrame([(i, " ".join(words[p:p + 30])) for i, p in enumerate((0, 4080, 4095, 8190, 29_970))],
                                  "item_id long, text string")
    got = dc.overlaps(cases.documents(spark, rows), items).collect()
    assert {r.item_id for r in got if r.doc_id == 5} >= {0, 1, 2, 3, 4}

import random
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from cellscope.llm import toxicity as tx
from tests.llm import cases


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def brute(entries, word):
    """Best (edits, -weight, entry) over all entries and all prefixes of the word."""
    best = None
    if len(word) < tx.SHORTEST:
        return None
    for i, e in enumerate(entries):
        d = min(distance(word[:n], e.text) for n in range(len(word) + 1))
        if d <= (tx.EDITS if len(e.text) >= tx.FUZZY_LENGTH else 0):
            rank = (d, -e.weight, i)
            best = rank if best is None or rank < best else best
    return None if best is None else (best[2], best[0])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=4, max_size=8), min_size=1, max_size=6, unique=True),
       st.text("abc", max_size=12))
def test_automaton_in_trie_equals_edit_distance(texts, word):
    entries = [tx.Entry(t, float(i)) for i, t in enumerate(texts)]
    assert tx.Lexicon(entries).find(word) == brute(entries, word)


def test_misspelled_terms_are_found():
    lexicon = tx.Lexicon([tx.Entry("idiot", 3.0), tx.Entry("scum", 3.0)])
    assert lexicon.find("idiots") == (0, 0) and lexicon.find("idjot") == (0, 1)
    assert lexicon.find("iddiot") == (0, 1) and lexicon.find("ideot") == (0, 1)
    assert lexicon.find("scam") is None and lexicon.find("scumbag") == (1, 0)
    assert lexicon.find("river") is None


def corpus(n=600, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = cases.prose(rng, rng.randrange(5, 80)).split(" ")
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["grobnick", "flaxhead", "grobnicks"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_learns_from_rows_outside_the_fold_and_holds_out(spark):
    rows, labels = corpus()
    # Labels of the held-out fold are turned round: nothing may be learned from them.
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    docs = cases.documents(spark, rows, extra=False).select("doc_id", "text")
    model = tx.train(docs, cases.labels(spark, turned))
    assert any(e.text.startswith("grob") for e in model.entries)
    got = {r.doc_id: r.predicted for r in tx.score(docs, model).collect()}
    right = sum(got[i] == t for i, _, t in labels)
    assert right >= 0.99 * len(labels)


def test_quotation_is_told_from_abuse():
    found = tx._Found(tx.Lexicon([tx.Entry("idiot", 3.0)]))
    names = dict(zip(tx.NAMES, range(len(tx.NAMES))))
    quoted = tx.evidence('He said "idiot" is a word', found)
    abuse = tx.evidence("you are an idiot", found)
    assert quoted[names["quoted"]] == 1 and quoted[names["reported"]] == 1 and quoted[names["addressed"]] == 0
    assert abuse[names["quoted"]] == 0 and abuse[names["addressed"]] == 1


def test_edges(spark):
    docs = cases.documents(spark).select("doc_id", "text")
    rows, labels = corpus(200)
    model = tx.train(cases.documents(spark, rows, extra=False), cases.labels(spark, [*labels, labels[0]]))
    got = tx.score(docs, model).collect()
    assert len(got) == len(cases.edge_texts()) and all(0 <= r.score <= 1 for r in got)
    empties = {r.score for r in got if not (r.text or "").strip()}
    assert len(empties) == 1
    assert tx.score(cases.empty(spark).select("doc_id", "text"), model).collect() == []
    for none in ([], [(1, 1, None)], [(1, None, 0), (2, None, 0), (None, 1, 1)]):
        flat = tx.train(docs, cases.labels(spark, none))
        scores = {r.score for r in tx.score(docs, flat).collect()}
        assert len(scores) == 1 and 0 <= scores.pop() < 0.5


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, sf):
    got = {r.doc_id: r for r in tx.op3_toxicity(spark, sf).collect()}
    held = [(r.toxic, got[r.doc_id].predicted) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()
            if got[r.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)

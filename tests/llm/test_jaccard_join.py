import random

import numpy as np
import pytest

from cellscope.llm import jaccard_join as jj
from cellscope.llm.components import components
from tests.llm import cases
from tests.llm.test_common import LOWER, PATTERN


def shingles(text):
    w = PATTERN.findall((text or "").translate(LOWER))
    if len(w) < 4:
        return {tuple(w)} if w else set()
    return set(zip(w, w[1:], w[2:], w[3:]))


def brute(rows):
    """Smallest id reachable, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else min(least[r], d) if d is not None else least[r]
    return sorted((str(d), len(s), str(least[find(i)]) if s else str(d)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def corpus(seed, n=150):
    rng = random.Random(seed)
    rows, base = [], [cases.prose(rng, rng.choice([3, 5, 8, 12, 30, 90, 200])) for _ in range(15)]
    passage = cases.prose(rng, 40)
    for i in range(n):
        words = rng.choice(base).split(" ")
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5]) if words else 0):
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice([[] if len(words) > 1 else ["x"], [f"new{rng.randrange(50)}"], [words[at], "more"]])
        if rng.random() < 0.2:
            words = [passage, *cases.prose(rng, rng.randrange(5, 40)).split(" ")]
        rows.append((rng.randrange(10_000) * 1000 + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_groups_equal_all_pairs(spark, seed):
    rows = corpus(seed)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in
                 jj.groups(cases.documents(spark, rows)).collect())
    want = brute(rows)
    assert got == want
    assert len({w[2] for w in want}) < len(rows)


def test_linked_sets_share_a_key_and_pass_the_bounds():
    rng = np.random.default_rng(3)
    bands = jj._bands(5000)
    for n in [6, 7, 8, 9, 13, 20, 40, 100, 333, 1000, 3000]:
        for _ in range(12):
            pool = rng.integers(0, 1 << 64, 2 * n, np.uint64)
            a = np.unique(pool[:n])
            apart = int(jj.most_apart(2 * n))
            out = int(rng.integers(0, apart + 1))
            b = np.unique(np.concatenate([a[out // 2:], pool[n:n + out - out // 2]]))
            same = len(np.intersect1d(a, b))
            if 100 * same < 85 * (len(a) + len(b) - same):
                continue
            assert len(np.intersect1d(jj.part_keys(a, bands), jj.part_keys(b, bands))) or (a == b).all()
            x, y = (np.unpackbits(jj.parity(s).view(np.uint8)) for s in (a, b))
            assert (x != y).sum() <= len(a) + len(b) - 2 * same <= jj.most_apart(len(a) + len(b))


def test_small_sets_fill_few_parts_but_lose_nothing():
    bands = jj._bands(100)
    for n in range(6, 30):
        a = np.sort(np.arange(n, dtype=np.uint64) + np.uint64(5))     # all in the first part
        b = np.append(a[:-1], np.uint64(1000)) if n >= 13 else a
        assert len(np.intersect1d(jj.part_keys(a, bands), jj.part_keys(b, bands)))


def test_links_through_rows_without_an_id(spark):
    """1 - null - 2 is a chain: 1 and 2 link by the row in between alone."""
    words = [f"w{i}" for i in range(103)]
    left, right = list(words), list(words)
    left[10] = left[30] = "x"
    right[60] = right[80] = "y"
    rows = [(1, " ".join(left)), (None, " ".join(words)), (2, " ".join(right)), (None, "some other text without an id"),
            (None, "some other text without an id")]
    rows += [(9, " ".join(words[:4] * 3 + ["z"]))]
    sets = [shingles(t) for _, t in rows[:3]]
    alike = lambda a, b: len(a & b) / len(a | b)
    assert alike(sets[0], sets[2]) < 0.85 <= min(alike(sets[0], sets[1]), alike(sets[1], sets[2]))
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in
                 jj.groups(cases.documents(spark, rows)).collect())
    assert got == brute(rows)
    assert ("2", 100, "1") in got and ("None", 100, "1") in got and ("None", 3, "None") in got


def test_large_group_of_near_copies(spark):
    rng = random.Random(1)
    words = cases.prose(rng, 150).split(" ")
    rows = []
    for i in range(400):
        w = list(words)
        w[rng.randrange(len(w))] = f"edit{i}"
        rows.append((1000 + i, " ".join(w)))
    got = jj.groups(cases.documents(spark, rows)).collect()
    assert {r.component_id for r in got} == {1000}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (7, 7)]
    rng.shuffle(edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in range(100, 160)) and got[201] == 200


def test_edges(spark):
    rows = cases.edge_texts()
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jj.groups(cases.documents(spark, rows)).collect())
    assert got == brute(rows)
    assert jj.groups(cases.empty(spark)).collect() == []
    only = cases.documents(spark, [(1, None), (2, " ")])
    assert sorted(map(tuple, jj.groups(only).collect())) == [(1, 0, 1), (2, 0, 2)]

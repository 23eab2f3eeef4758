import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from cellscope.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, seq in sorted(whole.items()):
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                kids[seq[:d - 1]].add(seq[:d])
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        out.append((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(kids[node]),
                    sum(not kids[n] for n in below),
                    sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                    hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, df=None):
    df = spark.createDataFrame(rows, SCHEMA) if df is None else df
    got = trie.trie(df).select(COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def generated(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*rng.sample(range(1000), 60), *range(200, 204)]:
        # Few texts, so that many conversations begin alike or are alike.
        for t in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((c, t * 2, rng.choice(["user", "user", None]), rng.choice(["a", "a", "a", "bé😀", "", None])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    check(spark, generated(seed))


def test_edges(spark):
    rows = [(0, None, "user", "x"), (0, 0, None, None), (0, 1, "user", "y" * 50), (7, 3, "user", "z"),
            (7, 3, "user", "z"), (105, 0, "a", "b"), (106, None, None, None), (300, 5, "user", "x"),
            (None, 0, "user", "lost"), (None, None, None, None), (2**40, 0, "user", "x")]
    clashing = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'q' AS depth", "1 AS p1", "2 AS kind", "3 AS rank", "'x' AS h", "5 AS weight", "6 AS _part")
    check(spark, rows, clashing)


def test_empty(spark):
    assert trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_hot_conversation_and_a_hot_sequence(spark, monkeypatch):
    """A conversation of a third of all rows and copies beyond one piece of an end list."""
    monkeypatch.setattr(trie, "PIECE", 7)
    monkeypatch.setattr(trie, "STRETCH", 3)
    rows = [(1001, t, "user", f"t{t % 7}") for t in range(150)]
    rows += [(5000 + i, t, "user", "same") for i in range(60) for t in range(3)]
    rows += [(9000, t, "user", "same") for t in range(5)]
    check(spark, rows)


def test_end_lists_are_hashed_in_numeric_order(spark):
    rows = [(c, 0, "user", "x") for c in (9, 10, 100, 1000, 99)]
    check(spark, rows)

import random

from cellscope.llm import mixing
from tests.llm import cases

import pytest
from pyspark.sql import functions as F


def fill(sizes: dict, weights=(3, 1, 2), percent=150, times=2):
    """Targets by sharing out again and again until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, open_ = sum(sizes.values()) * percent / 100, {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        over = {s for s in open_ if share[s] > times * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = times * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(6))
def test_targets_equal_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 100, 1000, 10_000]) for i in range(rng.randrange(1, 9))}
    sizes[None] = 40
    df = spark.createDataFrame([(1, s, n) for s, n in sizes.items()], "doc_id long, source string, size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = fill(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6)


def test_rank_of_a_slot_counts_earlier_points(spark):
    bits = 6
    points = [int(f"{i:06b}"[::-1], 2) for i in range(64)]
    rows = spark.range(64).select("id", mixing._reversed(F.col("id"), bits).alias("p"), *[
        mixing._points_below(F.col("id"), F.lit(b).cast("long"), bits).alias(f"b{b}") for b in (0, 1, 13, 40, 64)]).collect()
    for r in rows:
        assert r.p == points[r.id]
        for b in (0, 1, 13, 40, 64):
            assert r[f"b{b}"] == sum(p < b for p in points[:r.id])


def test_mix_takes_targets_and_covers_blocks(spark):
    rng = random.Random(3)
    rows = [(i, f"s{min(i % 7, 3)}", rng.choice([0, 1, 30, 700, 9000])) for i in range(400)]
    docs = spark.createDataFrame([(i, s, "w " * n) for i, s, n in rows], "doc_id long, source string, text string")
    stream, mixed = mixing.mix(docs)
    got = mixing.taken_words(docs).collect()
    sizes = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        sizes.setdefault(r.source, []).append(r)
    for s, rs in sizes.items():
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= 1
        assert rs[0].source_size == sum(r["size"] for r in rs)
    # Blocks are of equal size, and any stretch of slots mixes sources by target.
    slots = mixed.groupBy("slot", "source_key").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("n")).collect()
    assert len({r.slot for r in slots}) == len(slots)
    assert max(r.n for r in slots) <= mixing.BLOCK_WORDS
    order = sorted(slots, key=lambda r: r.slot)
    half = order[:len(order) // 2]
    for s, rs in sizes.items():
        whole = sum(r.source_key == "s" + s for r in order)
        assert abs(sum(r.source_key == "s" + s for r in half) - whole / 2) <= 3


def test_mix_reruns_agree_and_pieces_are_of_the_document(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", "w " * (i % 50)) for i in range(200)],
                                 "doc_id long, source string, text string")
    a, b = (sorted(map(tuple, mixing.taken_words(docs.repartition(n)).collect())) for n in (1, 5))
    assert a == b


def test_edges(spark):
    got = mixing.taken_words(cases.documents(spark)).collect()
    assert len(got) == len(cases.edge_texts())
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[2]["size"] == by[3]["size"] == by[4]["size"] == 0 and by[2].taken == 0
    assert by[6].source is None and by[6].source_size == 1
    assert sum(r.doc_id == 8 for r in got) == 2
    assert mixing.taken_words(cases.empty(spark)).collect() == []
    blank = cases.documents(spark, [(1, None), (2, "")])
    assert [(r.target, r.taken) for r in mixing.taken_words(blank).collect()] == [(0.0, 0)] * 2

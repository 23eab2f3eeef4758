import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cellscope.llm.common import Words, arrow_batches, fold, join_checked, words

PATTERN = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_words_of_a_batch_are_the_patterns_words():
    rng = random.Random(1)
    alphabet = "abAB é日 \t\n\x0b\x0c\r\x1c .,"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(300)] + [None, "", "a", " a"]
    w = Words(pa.array(texts))
    seen = {}
    for r, text in enumerate(texts):
        want = [x.translate(LOWER) for x in PATTERN.findall(text or "")]
        got = w.hashes[w.first[r]:w.first[r + 1]]
        assert len(got) == len(want)
        for h, x in zip(got.tolist(), want):
            assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)


def test_words_of_a_slice_and_of_long_batches():
    texts = pa.array(["skip me", "one two " * 200_000, "three"])
    w = Words(texts.slice(1))
    assert np.diff(w.first).tolist() == [400_000, 1]
    assert len(set(w.hashes[:400_000].tolist())) == 2


def test_batches_are_cut_by_bytes():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "c" * 3, "d" * 3]})
    sizes = [b.num_rows for b in arrow_batches([batch], "text", max_bytes=12)]
    assert sizes == [2, 1, 2]


def test_fold_is_crc32_of_the_id_text(spark):
    ids = [0, 1, 17, 123456789, -4, None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(
        "doc_id", fold(F.col("doc_id"), 7).alias("f")).collect()
    for r in got:
        assert r.f == zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 7


def test_spark_words(spark):
    texts = ["", None, "  ", "a", "\ta  b\n", "é ü x"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(words(F.col("t")).alias("w")).collect()
    assert [r.w for r in got] == [PATTERN.findall(t or "") for t in texts]


def test_salted_join_equals_broadcast(spark, monkeypatch):
    big = spark.range(300).selectExpr("id % 3 AS k", "id")
    small = spark.createDataFrame([(0, "x"), (1, "y")], "k long, v string")
    want = sorted(map(tuple, join_checked(big, small, ["k"], F.col("id")).select("k", "id", "v").collect()))
    monkeypatch.setattr("cellscope.llm.common.BROADCAST_ROWS", 0)
    got = sorted(map(tuple, join_checked(big, small, ["k"], F.col("id")).select("k", "id", "v").collect()))
    assert got == want and len(got) == 200

"""Rows that every text operator must survive: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

CLASHING = ("score", "predicted", "n_words", "h", "row", "key", "bucket", "size", "tokens", "kept", "label",
            "component_id", "taken", "n", "s1")


def prose(rng: random.Random, n: int) -> str:
    stems = "the of and to a in river stone light walk green open morning table paper wind house field voice night".split()
    out, line = [], []
    for _ in range(n):
        line.append(rng.choice(stems) + rng.choice(["", "", "s", "er", "ing"]))
        if rng.random() < 0.1:
            out.append(" ".join(line).capitalize() + ".")
            line = []
    return "\n".join([*out, " ".join(line)])


def edge_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    long_text = prose(rng, 30_000)
    a = prose(rng, 120)
    return [(1, a), (2, None), (3, ""), (4, " \t\n\x0b\x0c\r "), (5, long_text), (6, "word"), (7, "one two three"),
            (8, a), (8, a), (None, prose(rng, 60)), (None, None), (9, "É ß 日本 😀 <|endoftext|> #*$"),
            (10, "x" * 20_000), (11, a.upper())]


def documents(spark, rows=None, extra: bool = True):
    rows = edge_texts() if rows is None else rows
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    data = [(i, t, "en", None if i == 6 else f"s{(i or 0) % 3}", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        df = df.selectExpr(*names, *[f"'x' AS `{c}`" for c in CLASHING])
    return df


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

import random
import tempfile

import pytest

import corpus_pipeline as cp
from cellscope.llm.common import materialize
from tests.llm import cases
from tests.llm.test_decontamination import brute as held_items
from tests.llm.test_jaccard_join import brute as near_groups


@pytest.fixture(scope="module")
def folder(spark):
    """A small corpus with labels and a benchmark, as the stages read them."""
    rng = random.Random(12)
    path = tempfile.mkdtemp(prefix="cellscope-pipe-")
    items = [(i, " ".join(cases.prose(rng, 25).split())) for i in range(4)]
    rows, labels = [], []
    for i in range(500):
        toxic, good = rng.random() < 0.15, rng.random() < 0.8
        text = cases.prose(rng, rng.randrange(20, 90))
        if toxic:
            text = " ".join(w + (" flaxhead" if n % 7 == 3 else "") for n, w in enumerate(text.split(" ")))
        if not good:
            text = " ".join(w + "%%%" for w in text.split(" "))
        if rng.random() < 0.05:
            text += "\n" + rng.choice(items)[1]
        rows.append((i, text))
        if i % 2:
            labels.append((i, int(good), int(toxic)))
    rows += [(500 + i, rows[i][1]) for i in range(0, 60, 3)]
    rows += [(1000, None), (1001, ""), (None, rows[2][1])]
    cases.documents(spark, rows, extra=False).write.parquet(f"{path}/documents.parquet")
    cases.labels(spark, labels).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    out = [cp.documents(spark, folder)]
    for name, stage in cp.STAGES:
        out.append(materialize(stage(spark, out[-1], folder), "test-stage"))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect() if r.doc_id is not None)


def test_stages_keep_the_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_toxic_and_poor_documents_go_and_clean_ones_stay(stages):
    first = {r.doc_id: r.text or "" for r in stages[0].collect()}
    gone = set(ids(stages[0])) - set(ids(stages[1]))
    toxic = {i for i, t in first.items() if "flaxhead" in t}
    assert len(gone & toxic) >= 0.97 * len(toxic - {None}) and len(gone - toxic) <= 2
    second = {r.doc_id: r.text or "" for r in stages[1].collect()}
    poor = {i for i, t in second.items() if "%%%" in t and i is not None}
    gone = set(ids(stages[1])) - set(ids(stages[2]))
    assert len(gone & poor) >= 0.9 * len(poor) and len(gone - poor) <= 4


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    keep = {c for _, n, c in near_groups(rows) if n and c != "None"} | {d for d, n, _ in near_groups(rows) if not n}
    assert {str(i) for i in ids(stages[3])} == keep - {"None"}


def test_documents_with_benchmark_items_go(spark, folder, stages):
    rows = [(r.doc_id, r.text) for r in stages[3].collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    held = {d for d, _ in held_items(rows, items)}
    assert held and ids(stages[4]) == sorted({d for d, _ in rows if d is not None} - held)


def test_mix_takes_targets(stages):
    got = stages[5].collect()
    assert got and all(0 < r.taken <= 2 * r["size"] for r in got)
    for s in {r.source for r in got}:
        rows = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 80


def test_run_equals_the_stages(spark, folder, stages):
    got = cp.run(spark, folder)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages[5].collect()))


def test_empty_input(spark, folder):
    docs = cases.empty(spark)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.collect() == []


def test_edge_rows_and_clashing_columns(spark, folder):
    docs = cases.documents(spark)
    for name, stage in cp.STAGES:
        after = stage(spark, docs, folder)
        if name != cp.STAGES[-1][0]:
            assert after.columns == docs.columns
            docs = materialize(after, "test-edge")
        else:
            after.collect()


def test_rows_without_an_id_are_kept_judged_and_mixed(spark, folder):
    rng = random.Random(2)
    item = next(r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect())
    texts = [cases.prose(rng, 60) for _ in range(3)]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[2] + "\n" + item), (7, texts[2])]
    docs = cases.documents(spark, rows, extra=False)
    clean = materialize(cp.drop_contaminated(spark, docs, folder), "test-clean")
    assert sorted(map(str, clean.collect())) == sorted(str(r) for r in docs.collect() if item not in r.text)
    got = cp.mix_sources(spark, clean, folder).collect()
    want = cp.mixing.taken_words(clean).where("taken > 0").collect()
    assert any(r.doc_id is None for r in want)
    by = lambda r: (str(r.doc_id), r["size"], r.taken)
    assert sorted(map(by, got)) == sorted(map(by, want))


def test_repeated_ids_go_only_where_their_texts_link(spark, folder):
    rng = random.Random(3)
    a, b = cases.prose(rng, 80), cases.prose(rng, 80)
    rows = [(5, a), (5, b), (5, a), (9, b), (None, a), (4, b + " more"), (6, None), (6, "")]
    got = [cp.one_of_each_group(spark, cases.documents(spark, rows, extra=False).repartition(n), folder).collect()
           for n in (1, 5)]
    for found in got:
        assert sorted((str(r.doc_id), r.text or "") for r in found) == sorted(
            [("5", a), ("4", b + " more"), ("6", ""), ("6", "")])


def test_copies_without_an_id_go(spark, folder):
    rng = random.Random(4)
    a, b = cases.prose(rng, 80), cases.prose(rng, 80)
    rows = [(None, a), (None, a), (None, b), (3, b + " more"), (None, None), (None, "")]
    docs = cases.documents(spark, rows, extra=False)
    got = cp.one_of_each_group(spark, docs, folder).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in got) == sorted(
        [("None", a), ("3", b + " more"), ("None", ""), ("None", "")])


def test_keys_tell_rows_apart_by_where_a_null_is(spark):
    df = spark.createDataFrame([(1, "t", "x", None), (1, "t", None, "x")], "doc_id long, text string, lang string, source string")
    assert cp._keyed(df).select(cp.KEY).distinct().count() == 2


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)

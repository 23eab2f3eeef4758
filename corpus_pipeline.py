"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run`` writes as
Parquet into the shared scratch folder and reads again as the next stage's documents.
All but the last keep the columns of ``documents``.

1. toxicity: documents judged toxic go (rows of label 1 are learned from outside the
   held-out fold of the labels).
2. quality classifier: documents judged of low quality go.
3. n-gram Jaccard join: one document of each group stays, that of the smallest id (of
   equal ids, of the smallest hash of the row; one without an id only if none has one);
   documents without words are in no group and stay.
4. benchmark decontamination: documents that hold a benchmark item go, with an id or without.
5. mixing: sources are mixed to their target weights; documents that the mix takes
   words of stay, with size, source_size, target and taken.

Stages 3 to 5 tell rows apart by two 64-bit hashes of all columns, not by the id.

Cases: an empty input passes all stages as an empty table; rows that repeat an id are
documents of their own, unless their texts link (stage 3 leaves one); rows without an id are
judged like others; rows that are equal in all columns are copies (stage 3 leaves one if they
have words); further columns pass stages 1 to 4 unchanged (those that hold maps aren't hashed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.llm import decontamination, jaccard_join, mixing, quality_classifier, toxicity
from cellscope.llm.common import documents, materialize


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, _labels(spark, sf_dir))
    return _judged(docs, toxicity.score, model, "predicted = 0")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_classifier.train(docs, _labels(spark, sf_dir))
    return _judged(docs, quality_classifier.score, model, "predicted = 1")


def _judged(docs: DataFrame, score, model, keep: str) -> DataFrame:
    # Columns of the input that have the verdict's names are set aside under others.
    aside = {c: f"_input_{c}" for c in docs.columns if c in ("score", "predicted")}
    kept = score(docs.withColumnsRenamed(aside), model).where(keep).drop("score", "predicted")
    return kept.withColumnsRenamed({v: k for k, v in aside.items()}).select(docs.columns)


KEY = "_row_key"


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key made of two hashes of all their columns: equal for equal rows only."""
    columns = [F.col(f"`{c}`") for c, t in docs.dtypes if "map<" not in t]
    row = [*columns, *[c.isNull() for c in columns]]       # hashes pass over nulls
    return docs.withColumn(KEY, F.concat_ws("-", F.xxhash64(*row), F.xxhash64(F.lit(1), *row)))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    found = jaccard_join.groups(keyed.select(F.col(KEY).alias("doc_id"), "text")).where("n_shingles > 0")
    # One row for each key; a group may have as many as there are copies, so it is never one task's.
    linked = materialize(found.groupBy(F.col("doc_id").alias(KEY)).agg(
        F.first("component_id").alias("component_id"), F.count(F.lit(1)).alias("_copies")), "pipe-linked")
    ids = keyed.select(KEY, "doc_id").distinct()
    least = linked.join(ids, KEY).groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", KEY)).alias("least")).select(F.col(f"least.{KEY}").alias(KEY))
    gone = linked.select(KEY).join(least, KEY, "left_anti")
    again = linked.where("_copies > 1").select(KEY)
    gone, again = materialize(gone, "pipe-copies"), materialize(again, "pipe-repeated")
    kept = keyed.join(gone, KEY, "left_anti")
    # Only rows that are equal in all columns are gathered by their key.
    once = kept.join(again, KEY, "left_anti")
    return once.unionByName(kept.join(again, KEY, "left_semi").dropDuplicates([KEY])).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _keyed(docs)
    held = decontamination.overlaps(keyed.select(F.col(KEY).alias("doc_id"), "text"), benchmark)
    held = materialize(held.select(F.col("doc_id").alias(KEY)).distinct(), "pipe-held")
    return keyed.join(held, KEY, "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    names = ["size", "source_size", "target", "taken"]
    # Equal rows share a key; which of them has which words taken makes no difference.
    taken = materialize(mixing.taken_words(keyed, [KEY]).groupBy(KEY, *names).agg(
        F.count(F.lit(1)).alias("_copies")), "pipe-taken")
    repeated = materialize(taken.groupBy(KEY).agg(F.sum("_copies").alias("n")).where("n > 1").select(KEY),
                           "pipe-repeated")
    rows, taken = keyed.drop(*names), taken.where("taken > 0")
    single = rows.join(taken.join(repeated, KEY, "left_anti"), KEY)
    equal = rows.join(repeated, KEY, "left_semi").dropDuplicates([KEY]).join(taken, KEY)
    equal = equal.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).drop("_copy")
    return single.unionByName(equal).select([c for c in docs.columns if c not in names] + names)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_low_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipe-" + name.replace(" ", "-"))
    return docs


# A learned classifier isn't SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None

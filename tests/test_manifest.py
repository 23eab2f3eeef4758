import os

import pytest
from pyspark.sql import types as T

from cellscope.operators import manifest

SCHEMA = T.StructType([T.StructField("v", T.LongType()), T.StructField("h", T.StringType())])


def rows(spark, root, parts=None):
    return sorted((r.v, r.h) for r in manifest.read_versions(spark, root, SCHEMA, parts).collect())


def write(spark, root, part, values):
    df = spark.createDataFrame([(v, f"{v % 2}") for v in values], SCHEMA)
    return manifest.write_version(df, root, part, ["h"])


def test_a_run_replaces_its_part_alone(spark, workdir):
    assert rows(spark, workdir) == []
    write(spark, workdir, "h1", [1, 2, 3])
    write(spark, workdir, "h2", [10])
    write(spark, workdir, "h1", [4])
    assert rows(spark, workdir) == [(4, "0"), (10, "0")]
    assert rows(spark, workdir, ["h1"]) == [(4, "0")]
    write(spark, workdir, "h1", [])
    assert rows(spark, workdir) == [(10, "0")]


def test_a_run_killed_before_publishing_leaves_the_old_version(spark, workdir, monkeypatch):
    write(spark, workdir, "h1", [1, 2])

    def killed(*args):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(manifest, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            write(spark, workdir, "h1", [7, 8, 9])
    assert rows(spark, workdir) == [(1, "1"), (2, "0")]
    write(spark, workdir, "h1", [5])
    assert rows(spark, workdir) == [(5, "1")]


def test_a_failing_run_leaves_the_old_version(spark, workdir):
    from pyspark.sql import functions as F

    write(spark, workdir, "all", [1])
    bad = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(
        F.col("id")).cast("long").alias("v"), F.lit("x").alias("h"))
    with pytest.raises(Exception, match="broken"):
        manifest.write_version(bad, workdir, "all", ["h"])
    assert rows(spark, workdir) == [(1, "1")]


def test_two_runs_with_one_number(spark, workdir):
    """Of two runs that count the same records, one is published and the other fails."""
    from cellscope.sources import files

    write(spark, workdir, "p", [1])
    files.create(spark, f"{workdir}/commits/p/{1:012d}.a-first")
    with pytest.raises(Exception, match="exist|another run"):
        files.create(spark, f"{workdir}/commits/p/{1:012d}.a-first")
    version = write(spark, workdir, "p", [2])
    assert manifest.current(spark, workdir)["p"].endswith(version)


def test_vacuum_keeps_what_counts(spark, workdir):
    old = write(spark, workdir, "p", [1])
    new = write(spark, workdir, "p", [2])
    manifest.vacuum(spark, workdir, 3600)
    assert len(os.listdir(f"{workdir}/versions")) == 2        # a reader may be in the old one
    manifest.vacuum(spark, workdir, -1)
    assert [x for x in os.listdir(f"{workdir}/versions") if old in x] == []
    assert rows(spark, workdir) == [(2, "0")] and any(new in x for x in os.listdir(f"{workdir}/versions"))

"""Tables in versions, published by one commit record.

A table has parts (an hour, a day, or the whole).  A run writes a part's files into a version
folder of its own and then creates one empty record file, an operation that every store makes
whole or not at all::

    <root>/versions/version=<version>/...      the files
    <root>/commits/<part>/<n>.<version>        the record; the greatest n counts

Readers look at records only, so they see a part's old version until the new one is
published, whatever happens to the run in between; a folder without a record is never read.
Re-runs publish a new version.  Two runs that publish the same n: the second fails.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cellscope.sources import files


def _records(spark: SparkSession, root: str, part: str = "*") -> dict[str, list[tuple[int, str, int]]]:
    """part -> its commits (n, version, time), in order."""
    out: dict[str, list[tuple[int, str, int]]] = {}
    for path, changed, _ in files.listing(spark, f"{root.rstrip('/')}/commits/{part}/*"):
        name, record = path.rsplit("/", 2)[1:]
        n, version = record.split(".", 1)
        out.setdefault(name, []).append((int(n), version, changed))
    return {k: sorted(v) for k, v in out.items()}


def write_version(df: DataFrame, root: str, part: str = "all", partition_cols: Sequence[str] = ()) -> str:
    """Write ``df`` as the next version of ``part`` and publish it; the version's name."""
    spark, root = df.sparkSession, root.rstrip("/")
    version = f"{part}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_cols).parquet(f"{root}/versions/version={version}")
    publish(spark, root, part, version)
    return version


def publish(spark: SparkSession, root: str, part: str, version: str) -> None:
    done = _records(spark, root, part).get(part, [])
    n = done[-1][0] + 1 if done else 0
    files.create(spark, f"{root.rstrip('/')}/commits/{part}/{n:012d}.{version}")
    # A run that counted the same records publishes the same n under another name.
    same = [v for k, v, _ in _records(spark, root, part)[part] if k == n]
    if min(same) != version:
        files.delete(spark, f"{root.rstrip('/')}/commits/{part}/{n:012d}.{version}")
        raise RuntimeError(f"another run published version {n} of {part}")


def current(spark: SparkSession, root: str) -> dict[str, str]:
    """part -> folder of its published version."""
    return {part: f"{root.rstrip('/')}/versions/version={done[-1][1]}" for part, done in _records(spark, root).items()}


def read_versions(spark: SparkSession, root: str, schema: T.StructType, parts: Sequence[str] | None = None) -> DataFrame:
    """The published versions of all parts (or of ``parts``); empty if none is."""
    found = current(spark, root)
    paths = [p for part, p in sorted(found.items()) if parts is None or part in parts]
    if not paths:
        return spark.createDataFrame([], schema)
    layout = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    base = f"{root.rstrip('/')}/versions"
    return spark.read.option("basePath", base).schema(layout).parquet(*paths).select(*schema.names)


def vacuum(spark: SparkSession, root: str, retain_seconds: int) -> None:
    """Remove versions that were replaced more than the retention time ago (a reader may still
    be in a younger one), and folders as old that were never published."""
    cutoff, keep = (time.time() - retain_seconds) * 1000, set()
    for part, done in _records(spark, root).items():
        for (n, version, _), after in zip(done, [*done[1:], None]):
            if after is None or after[2] > cutoff:
                keep.add(version)
            else:
                files.delete(spark, f"{root.rstrip('/')}/commits/{part}/{n:012d}.{version}")
    for path, changed, _ in files.listing(spark, f"{root.rstrip('/')}/versions/*"):
        if path.rsplit("/version=", 1)[1] not in keep and changed <= cutoff:
            files.delete(spark, path)

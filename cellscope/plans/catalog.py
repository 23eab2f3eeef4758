"""Registry of named queries: Spark builder + equivalent DuckDB oracle SQL.

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
supplied tables (or data Spark derives from them).  Oracle SQL runs on the
same tables registered as views; columns are aliased identically on both
sides and timestamps are exposed as strings / epoch ms, never as zoned types.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules registers their queries.
    from cellscope.plans import batch_queries, source_queries, stream_queries  # noqa: F401
    return REGISTRY

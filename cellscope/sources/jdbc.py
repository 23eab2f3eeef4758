"""JDBC table scans (user index kept in an external SQL store).

The original jobs read the index table over JDBC as one full-table,
single-partition scan.  Here the reader is split into ``num_partitions``
range scans over a numeric column when bounds are given, so a large table is
read in parallel.  The driver jar must be on the classpath; none ships with
this repository, so only the option building is exercised offline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10000) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC scans need lower/upper bounds and a count")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                     "upperBound": str(upper_bound), "numPartitions": str(num_partitions)})
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    """``spark.read.format("jdbc")`` with :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()

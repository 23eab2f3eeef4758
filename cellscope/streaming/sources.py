"""Streaming sources for the live signal feed.

Production reads string messages from a Kafka topic; the same parse step
serves a folder of text files (used offline, as no Kafka broker or connector
jar is present here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope.sources.delimited import parse_signals_full, parse_signals_lenient


def kafka_lines(spark: SparkSession, servers: str, topic: str,
                starting_offsets: str = "latest", max_offsets: int | None = None) -> DataFrame:
    """``value`` strings from a topic; resumes from the query checkpoint."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    return reader.load().select(F.col("value").cast("string").alias("value"))


def text_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """``value`` strings from files arriving in a folder."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def signal_stream(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Parsed signals plus an event-time column ``ts`` and a tie-break ``event_id``.

    ``event_id`` is the epoch-ms time combined with a hash of the line, so two
    signals of one user at the same millisecond still order deterministically.
    """
    sig = parse_signals_full(lines, strict=strict)
    return (sig.withColumn("ts", F.timestamp_millis("procedureStartTime"))
               .withColumn("event_id", F.xxhash64("imsi", "laccell", "procedureStartTime")))


def signal_pair_stream(lines: DataFrame) -> DataFrame:
    """Signals of a feed whose lines may hold only (imsi, laccell): every line with these two
    fields counts, at its time of arrival (for processing-time windows)."""
    pairs = parse_signals_lenient(lines).withColumn("ts", F.current_timestamp())
    return (pairs.withColumn("procedureStartTime", F.unix_millis("ts"))
                 .withColumn("event_id", F.xxhash64("imsi", "laccell", "procedureStartTime")))


def parquet_table_stream(spark: SparkSession, folder: str, table: str,
                         max_files: int | None = None) -> DataFrame:
    """Stream one ``<table>.parquet`` file of a folder (schema from the file)."""
    schema: T.StructType = spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet").schema
    reader = (spark.readStream.schema(schema)
              .option("pathGlobFilter", f"{table}.parquet"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(folder)

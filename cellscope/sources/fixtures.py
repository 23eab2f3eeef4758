"""Signalling-shaped views over the supplied test tables (see FIXTURES.md).

M1 (events / nation / customer) drives correctness and streaming, M2
(lineitem / supplier / part) drives the scale benchmark.  Each view exists
twice: as a Spark DataFrame and as DuckDB SQL text for the oracle, written
side by side so the two derivations can be read against each other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.functions.scalar import epoch_ms
from cellscope.schemas import LABELS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class Mapping:
    """The four inputs of the batch jobs plus event order columns."""
    signals: DataFrame      # imsi, laccell, latitude, longitude, procedureStartTime, ts, event_id
    region_cell: DataFrame  # region_id, laccell
    user_info: DataFrame    # imsi, gender, age
    indexed_users: DataFrame  # imsi of users that get a bitmap id


# ---------------------------------------------------------------- M1 (Spark)

def m1_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_signals(table(spark, sf_dir, "events"))


def events_as_signals(events: DataFrame) -> DataFrame:
    """Mapping M1 on an events DataFrame (batch or streaming)."""
    e = events
    k = F.get_json_object("props", "$.k").cast("int")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.col("user_id").cast("string").alias("imsi"),
        (k % 30).cast("string").alias("laccell"),
        F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"),
        epoch_ms(ts).alias("procedureStartTime"),
        ts.alias("ts"),
        F.col("event_id"),
    )


def m1_region_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_regionkey").cast("string").alias("region_id"),
                    F.col("n_nationkey").cast("string").alias("laccell"))


def m1_user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("imsi"),
                    (F.col("c_custkey") % 2).cast("string").alias("gender"),
                    (F.col("c_custkey") % 70).cast("int").alias("age"))


def m1_indexed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return (c.where(F.col("c_custkey") % 11 != 0)
             .select(F.col("c_custkey").cast("string").alias("imsi")))


def m1(spark: SparkSession, sf_dir: str) -> Mapping:
    return Mapping(m1_signals(spark, sf_dir), m1_region_cell(spark, sf_dir),
                   m1_user_info(spark, sf_dir), m1_indexed_users(spark, sf_dir))


# ---------------------------------------------------------------- M2 (Spark)

def m2_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ts = F.col("l_shipdate").cast("timestamp")
    return li.select(
        F.col("l_partkey").cast("string").alias("imsi"),
        F.col("l_suppkey").cast("string").alias("laccell"),
        F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"),
        epoch_ms(ts).alias("procedureStartTime"),
        ts.alias("ts"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_id"),
    )


def m2_region_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_nationkey").cast("string").alias("region_id"),
                    F.col("s_suppkey").cast("string").alias("laccell"))


def m2_user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    brand = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    return p.select(F.col("p_partkey").cast("string").alias("imsi"),
                    (brand % 3).cast("string").alias("gender"),
                    F.col("p_size").cast("int").alias("age"))


def m2_indexed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("imsi"))


def m2(spark: SparkSession, sf_dir: str) -> Mapping:
    return Mapping(m2_signals(spark, sf_dir), m2_region_cell(spark, sf_dir),
                   m2_user_info(spark, sf_dir), m2_indexed_users(spark, sf_dir))


# ---------------------------------------------------------------- M3 (Spark)

def m3(spark: SparkSession, sf_dir: str) -> Mapping:
    """M2 with every order line as a user of its own (many ids)."""
    li = m2_signals(spark, sf_dir).withColumn("imsi", F.col("event_id").cast("string"))
    return Mapping(li, m2_region_cell(spark, sf_dir), m2_user_info(spark, sf_dir), li.select("imsi"))


# -------------------------------------------------------- M1 (DuckDB oracle)

# CTE prelude shared by every oracle query.  ``ts`` is naive UTC wall time.
ORACLE_M1 = f"""
signals AS (
  SELECT CAST(user_id AS VARCHAR) AS imsi,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 30 AS VARCHAR) AS laccell,
         0.0::DOUBLE AS latitude, 0.0::DOUBLE AS longitude,
         CAST(epoch_us(ts) // 1000 AS BIGINT) AS procedureStartTime,
         ts, event_id
  FROM events
),
region_cell AS (
  SELECT CAST(n_regionkey AS VARCHAR) AS region_id, CAST(n_nationkey AS VARCHAR) AS laccell
  FROM nation
),
user_info AS (
  SELECT CAST(c_custkey AS VARCHAR) AS imsi,
         CAST(c_custkey % 2 AS VARCHAR) AS gender,
         CAST(c_custkey % 70 AS INTEGER) AS age
  FROM customer
),
user_index AS (
  SELECT imsi, CAST(row_number() OVER (ORDER BY imsi) - 1 AS BIGINT) AS bitmap_id
  FROM (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS imsi FROM customer
        WHERE c_custkey % 11 <> 0) u
),
stay_rows AS (
  SELECT DISTINCT rc.region_id, strftime(s.ts, '%Y%m%d%H') AS produce_hour, ui.bitmap_id
  FROM signals s
  LEFT JOIN region_cell rc ON s.laccell = rc.laccell
  LEFT JOIN user_index ui ON s.imsi = ui.imsi
),
portrait_rows AS (
  SELECT DISTINCT portrait_id, portrait_value, comment, bitmap_id FROM (
    SELECT CASE WHEN u.gender = '1' THEN 1 WHEN u.gender = '0' THEN 2 END AS portrait_id,
           u.gender AS portrait_value,
           CASE WHEN u.gender = '1' THEN '{LABELS[1]}' WHEN u.gender = '0' THEN '{LABELS[2]}' END AS comment,
           ui.bitmap_id
    FROM user_info u JOIN user_index ui ON u.imsi = ui.imsi WHERE u.age >= 10
    UNION ALL
    SELECT CASE WHEN u.age < 20 THEN 3 WHEN u.age < 40 THEN 4 ELSE 5 END,
           CASE WHEN u.age < 20 THEN '10' WHEN u.age < 40 THEN '20' ELSE '40' END,
           CASE WHEN u.age < 20 THEN '{LABELS[3]}' WHEN u.age < 40 THEN '{LABELS[4]}'
                ELSE '{LABELS[5]}' END,
           ui.bitmap_id
    FROM user_info u JOIN user_index ui ON u.imsi = ui.imsi WHERE u.age >= 10
  ) p WHERE portrait_id IS NOT NULL
),
enriched AS (
  SELECT s.imsi, s.laccell, s.ts, s.event_id, s.procedureStartTime,
         rc.region_id, u.gender, u.age
  FROM signals s
  JOIN user_info u ON s.imsi = u.imsi
  JOIN region_cell rc ON s.laccell = rc.laccell
)
"""


def oracle(body: str) -> str:
    """Prefix an oracle query with the M1 view definitions."""
    return "WITH " + ORACLE_M1.strip() + "\n" + body.strip()

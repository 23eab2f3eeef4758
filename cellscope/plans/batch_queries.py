"""Batch queries over mapping M1 (events as signals, see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.functions import containers
from cellscope.functions.scalar import (age_band, age_portrait_comment, age_portrait_id,
                                        gender_portrait_comment, gender_portrait_id,
                                        hour_bucket)
from cellscope.operators import persona, portrait, segments, stay
from cellscope.operators.index import build_user_index, extend_user_index, unique_id_index
from cellscope.operators.joins import asof_join
from cellscope.operators.sinks import write_hourly
from cellscope.plans.catalog import query
from cellscope.schemas import LABELS, PERSONA_COLUMNS
from cellscope.session import scratch_path
from cellscope.sources import fixtures
from cellscope.sources.fixtures import oracle

# Segment lookup parameters (a point query is the feature of these keys).
SEGMENT_REGION, SEGMENT_HOUR, SEGMENT_PORTRAIT = "1", "2024010810", 4
LOOKUP_REGION = "1"


def _ts_text(col: str) -> F.Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


# ------------------------------------------------------------------ builders

def m1_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_user_index(fixtures.m1_indexed_users(spark, sf_dir))


def m1_stay_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.m1(spark, sf_dir)
    return stay.region_hour_stay(m.signals, m.region_cell, build_user_index(m.indexed_users))


def m1_portrait_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.m1(spark, sf_dir)
    return portrait.portrait_bitmaps(m.user_info, build_user_index(m.indexed_users))


def m1_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.m1(spark, sf_dir)
    return persona.enrich(m.signals, m.user_info, m.region_cell)


def m1_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return persona.region_flow(m1_enriched(spark, sf_dir))


# ------------------------------------------------------------ index (Q1, W1)

ALL_USERS = """
SELECT imsi, CAST(row_number() OVER (ORDER BY imsi) - 1 AS BIGINT) AS bitmap_id
FROM (SELECT DISTINCT imsi FROM user_info) u"""


@query("user_bitmap_index", oracle(ALL_USERS))
def q_user_bitmap_index(spark, sf_dir):
    """Every customer gets an id."""
    return build_user_index(fixtures.m1_user_info(spark, sf_dir))


@query("user_bitmap_index_parity", oracle("""
SELECT imsi, true AS is_unique FROM (SELECT DISTINCT imsi FROM user_info) u"""))
def q_user_bitmap_index_parity(spark, sf_dir):
    """Ids in the layout of one id per input line: unique, every user covered."""
    ids = unique_id_index(fixtures.m1_user_info(spark, sf_dir))
    per_id = ids.groupBy("bitmap_id").agg(F.count(F.lit(1)).alias("n"))
    return ids.join(per_id, "bitmap_id").select("imsi", (F.col("n") == 1).alias("is_unique"))


@query("user_index_extend", oracle("""
SELECT imsi, bitmap_id FROM user_index
UNION ALL
SELECT imsi, CAST((SELECT max(bitmap_id) + 1 FROM user_index)
                  + row_number() OVER (ORDER BY imsi) - 1 AS BIGINT) AS bitmap_id
FROM (SELECT DISTINCT imsi FROM user_info
      WHERE imsi NOT IN (SELECT imsi FROM user_index)) fresh"""))
def q_user_index_extend(spark, sf_dir):
    """Next day's index: every customer, yesterday's ids kept."""
    return extend_user_index(m1_index(spark, sf_dir), fixtures.m1_user_info(spark, sf_dir))


# ---------------------------------------------------------- stay (Q2, Q2b)

@query("region_hour_stay", oracle("""
SELECT region_id, produce_hour, bitmap_id FROM stay_rows WHERE bitmap_id IS NOT NULL"""))
def q_region_hour_stay(spark, sf_dir):
    return containers.decode(m1_stay_bitmaps(spark, sf_dir), stay.STAY_KEYS)


@query("stay_user_count", oracle("""
SELECT region_id, produce_hour, CAST(count(bitmap_id) AS BIGINT) AS user_count
FROM stay_rows GROUP BY region_id, produce_hour"""))
def q_stay_user_count(spark, sf_dir):
    return stay.stay_user_count(m1_stay_bitmaps(spark, sf_dir))


@query("bitmap_build", oracle("""
SELECT region_id, produce_hour,
       CASE WHEN bitmap_id IS NULL THEN NULL ELSE bitmap_id // 32768 + 1 END AS bucket,
       CAST(count(bitmap_id) AS BIGINT) AS bit_count
FROM stay_rows GROUP BY ALL"""))
def q_bitmap_build(spark, sf_dir):
    bm = m1_stay_bitmaps(spark, sf_dir)
    return bm.select("region_id", "produce_hour", "bucket",
                     F.col("n").cast("long").alias("bit_count"))


@query("stay_id_sets", oracle("""
SELECT region_id, produce_hour,
       CASE WHEN bitmap_id IS NULL THEN NULL ELSE bitmap_id // 32768 + 1 END AS bucket, bitmap_id
FROM stay_rows"""))
def q_stay_id_sets(spark, sf_dir):
    """Every member of every set (a group without ids has one empty set)."""
    m = fixtures.m1(spark, sf_dir)
    sets = stay.stay_id_sets(m.signals, m.region_cell, build_user_index(m.indexed_users))
    return sets.select("region_id", "produce_hour", "bucket",
                       F.explode_outer("bitmap_ids").alias("bitmap_id"))


@query("bitmap_from_ids", oracle("""
SELECT region_id, produce_hour, bitmap_id FROM stay_rows WHERE bitmap_id IS NOT NULL"""))
def q_bitmap_from_ids(spark, sf_dir):
    m = fixtures.m1(spark, sf_dir)
    sets = stay.stay_id_sets(m.signals, m.region_cell, build_user_index(m.indexed_users))
    bms = containers.from_ids(sets, stay.STAY_KEYS, "bitmap_ids")
    return containers.decode(bms, stay.STAY_KEYS)


@query("bitmap_two_buckets", """
WITH u AS (SELECT CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS imsi, l_suppkey, l_shipdate FROM lineitem),
i AS (SELECT imsi, CAST(row_number() OVER (ORDER BY imsi) - 1 AS BIGINT) AS bitmap_id
  FROM (SELECT DISTINCT imsi FROM u) d)
SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS region_id, strftime(l_shipdate, '%Y%m%d%H') AS produce_hour,
  bitmap_id // 32768 + 1 AS bucket, bitmap_id
FROM u JOIN i ON i.imsi = u.imsi JOIN supplier ON s_suppkey = l_suppkey""")
def q_bitmap_two_buckets(spark, sf_dir):
    """Mapping M3: every order line is a user, so ids pass one bucket at sf0.01."""
    m = fixtures.m3(spark, sf_dir)
    bitmaps = stay.region_hour_stay(m.signals, m.region_cell, build_user_index(m.indexed_users))
    return containers.decode(bitmaps, [*stay.STAY_KEYS, "bucket"])


@query("bitmap_roundtrip", oracle("""
SELECT region_id, produce_hour, bitmap_id FROM stay_rows WHERE bitmap_id IS NOT NULL"""))
def q_bitmap_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "stay-bitmaps")
    m1_stay_bitmaps(spark, sf_dir).write.mode("overwrite").parquet(path)
    return containers.decode(spark.read.parquet(path), stay.STAY_KEYS)


@query("bitmap_merge", oracle("""
SELECT region_id, substr(produce_hour, 1, 8) AS produce_day,
       CAST(count(DISTINCT bitmap_id) AS BIGINT) AS user_count
FROM stay_rows GROUP BY ALL"""))
def q_bitmap_merge(spark, sf_dir):
    day = stay.rollup_day(m1_stay_bitmaps(spark, sf_dir))
    return containers.cardinality(day, ["region_id", "produce_day"])


# ------------------------------------------------------ portraits (Q3, Q3b)

@query("portrait_bitmaps", oracle("""
SELECT portrait_id, portrait_value, comment, bitmap_id FROM portrait_rows"""))
def q_portrait_bitmaps(spark, sf_dir):
    return containers.decode(m1_portrait_bitmaps(spark, sf_dir), portrait.PORTRAIT_KEYS)


@query("bitmap_cardinality", oracle("""
SELECT portrait_id, portrait_value, comment, CAST(count(*) AS BIGINT) AS user_count
FROM portrait_rows GROUP BY ALL"""))
def q_bitmap_cardinality(spark, sf_dir):
    return containers.cardinality(m1_portrait_bitmaps(spark, sf_dir), portrait.PORTRAIT_KEYS)


@query("portrait_id_sets", oracle("""
SELECT portrait_id, portrait_value, comment, bitmap_id // 32768 + 1 AS bucket,
       CAST(count(*) AS INTEGER) AS set_size, min(bitmap_id) AS min_id, max(bitmap_id) AS max_id
FROM portrait_rows GROUP BY ALL"""))
def q_portrait_id_sets(spark, sf_dir):
    m = fixtures.m1(spark, sf_dir)
    sets = portrait.portrait_id_sets(m.user_info, build_user_index(m.indexed_users))
    return sets.select(*portrait.PORTRAIT_KEYS, "bucket",
                       F.size("bitmap_ids").alias("set_size"),
                       F.array_min("bitmap_ids").alias("min_id"),
                       F.array_max("bitmap_ids").alias("max_id"))


@query("portrait_union", oracle("""
SELECT portrait_id, portrait_value, comment, CAST(count(*) AS BIGINT) AS user_count
FROM portrait_rows GROUP BY ALL"""))
def q_portrait_union(spark, sf_dir):
    m = fixtures.m1(spark, sf_dir)
    return portrait.portrait_union(m.user_info, build_user_index(m.indexed_users))


@query("filter_min_age", oracle("SELECT imsi, gender, age FROM user_info WHERE age >= 10"))
def q_filter_min_age(spark, sf_dir):
    return fixtures.m1_user_info(spark, sf_dir).where(F.col("age") >= 10)


@query("inner_join_index", oracle("""
SELECT u.imsi, u.gender, u.age, ui.bitmap_id
FROM user_info u JOIN user_index ui ON u.imsi = ui.imsi"""))
def q_inner_join_index(spark, sf_dir):
    return (fixtures.m1_user_info(spark, sf_dir)
            .join(m1_index(spark, sf_dir), "imsi", "inner")
            .select("imsi", "gender", "age", "bitmap_id"))


@query("age_band", oracle("""
SELECT imsi, age, CASE WHEN age >= 10 AND age < 20 THEN '10'
                       WHEN age >= 20 AND age < 40 THEN '20'
                       WHEN age >= 40 THEN '40' END AS age_flag
FROM user_info"""))
def q_age_band(spark, sf_dir):
    u = fixtures.m1_user_info(spark, sf_dir)
    return u.select("imsi", "age", age_band("age").alias("age_flag"))


@query("portrait_labels", oracle(f"""
SELECT imsi,
       CASE WHEN gender = '1' THEN 1 WHEN gender = '0' THEN 2 END AS gender_portrait_id,
       CASE WHEN gender = '1' THEN '{LABELS[1]}' WHEN gender = '0' THEN '{LABELS[2]}' END AS gender_comment,
       CASE WHEN age >= 10 AND age < 20 THEN 3 WHEN age >= 20 AND age < 40 THEN 4
            WHEN age >= 40 THEN 5 END AS age_portrait_id,
       CASE WHEN age >= 10 AND age < 20 THEN '{LABELS[3]}'
            WHEN age >= 20 AND age < 40 THEN '{LABELS[4]}'
            WHEN age >= 40 THEN '{LABELS[5]}' END AS age_comment
FROM user_info"""))
def q_portrait_labels(spark, sf_dir):
    u = fixtures.m1_user_info(spark, sf_dir)
    g, a = F.col("gender"), age_band("age")
    return u.select("imsi",
                    gender_portrait_id(g).alias("gender_portrait_id"),
                    gender_portrait_comment(g).alias("gender_comment"),
                    age_portrait_id(a).alias("age_portrait_id"),
                    age_portrait_comment(a).alias("age_comment"))


# ------------------------------------------------------------ joins / F1

@query("left_join_region", oracle("""
SELECT s.event_id, s.imsi, s.laccell, rc.region_id
FROM signals s LEFT JOIN region_cell rc ON s.laccell = rc.laccell"""))
def q_left_join_region(spark, sf_dir):
    m = fixtures.m1(spark, sf_dir)
    cells = m.region_cell
    return (m.signals.join(cells, "laccell", "left")
            .select("event_id", "imsi", "laccell", "region_id"))


@query("left_join_index", oracle("""
SELECT s.event_id, s.imsi, ui.bitmap_id
FROM signals s LEFT JOIN user_index ui ON s.imsi = ui.imsi"""))
def q_left_join_index(spark, sf_dir):
    m = fixtures.m1(spark, sf_dir)
    return (m.signals.join(build_user_index(m.indexed_users), "imsi", "left")
            .select("event_id", "imsi", "bitmap_id"))


@query("hour_bucket", oracle("""
SELECT event_id, procedureStartTime, strftime(ts, '%Y%m%d%H') AS produce_hour FROM signals"""))
def q_hour_bucket(spark, sf_dir):
    s = fixtures.m1_signals(spark, sf_dir)
    return s.select("event_id", "procedureStartTime",
                    hour_bucket("procedureStartTime").alias("produce_hour"))


# ---------------------------------------------------- segments (Q4, Q5)

_SEG_WHERE = (f"s.region_id = '{SEGMENT_REGION}' AND s.produce_hour = '{SEGMENT_HOUR}' "
              f"AND p.portrait_id = {SEGMENT_PORTRAIT}")


@query("segment_count", oracle(f"""
SELECT CAST(count(*) AS BIGINT) AS cnt
FROM stay_rows s JOIN portrait_rows p ON s.bitmap_id = p.bitmap_id WHERE {_SEG_WHERE}"""))
def q_segment_count(spark, sf_dir):
    return segments.segment_count(m1_stay_bitmaps(spark, sf_dir),
                                  m1_portrait_bitmaps(spark, sf_dir),
                                  SEGMENT_REGION, SEGMENT_HOUR, SEGMENT_PORTRAIT)


@query("segment_users", oracle(f"""
SELECT s.bitmap_id
FROM stay_rows s JOIN portrait_rows p ON s.bitmap_id = p.bitmap_id WHERE {_SEG_WHERE}"""))
def q_segment_users(spark, sf_dir):
    return segments.segment_users(m1_stay_bitmaps(spark, sf_dir),
                                  m1_portrait_bitmaps(spark, sf_dir),
                                  SEGMENT_REGION, SEGMENT_HOUR, SEGMENT_PORTRAIT)


@query("segment_requests", oracle("""
, requests AS (SELECT DISTINCT CAST(o_custkey % 7 AS VARCHAR) AS region_id,
    strftime(TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * CAST(o_orderkey % 740 AS INTEGER), '%Y%m%d%H') AS produce_hour,
    CAST(o_orderkey % 6 AS INTEGER) AS portrait_id FROM orders)
SELECT r.region_id, r.produce_hour, r.portrait_id, CAST(count(p.bitmap_id) AS BIGINT) AS cnt
FROM requests r LEFT JOIN stay_rows s ON s.region_id = r.region_id AND s.produce_hour = r.produce_hour
LEFT JOIN portrait_rows p ON p.bitmap_id = s.bitmap_id AND p.portrait_id = r.portrait_id
GROUP BY r.region_id, r.produce_hour, r.portrait_id"""))
def q_segment_requests(spark, sf_dir):
    """A table of requests, derived from the orders (unknown regions, hours and portraits
    among them), answered by one job from the stored stay table."""
    orders, path = fixtures.table(spark, sf_dir, "orders"), scratch_path(spark, "stay-requests")
    hour = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, CAST(o_orderkey % 740 AS INT))")
    requests = orders.select(F.expr("CAST(o_custkey % 7 AS STRING)").alias("region_id"),
                             F.date_format(hour, "yyyyMMddHH").alias("produce_hour"),
                             F.expr("CAST(o_orderkey % 6 AS INT)").alias("portrait_id"))
    write_hourly(m1_stay_bitmaps(spark, sf_dir), path)
    return segments.segment_counts(requests, stay.read_stay_table(spark, path), m1_portrait_bitmaps(spark, sf_dir))


@query("container_sizes", """
WITH u AS (SELECT CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS imsi, l_suppkey, l_shipdate FROM lineitem),
i AS (SELECT imsi, row_number() OVER (ORDER BY imsi) - 1 AS id FROM (SELECT DISTINCT imsi FROM u) d),
v AS (SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS region_id, strftime(l_shipdate, '%Y%m%d%H') AS produce_hour,
    id // 32768 + 1 AS bucket, id FROM u JOIN i ON i.imsi = u.imsi JOIN supplier ON s_suppkey = l_suppkey),
r AS (SELECT *, id - lag(id) OVER (PARTITION BY region_id, produce_hour, bucket ORDER BY id) AS gap FROM v)
SELECT region_id, produce_hour, CAST(bucket AS BIGINT) AS bucket, CAST(count(*) AS INTEGER) AS n,
  CAST(least(2 * count(*), 4 * count(*) FILTER (WHERE gap IS NULL OR gap > 1), 4096) AS INTEGER) AS n_bytes
FROM r GROUP BY region_id, produce_hour, bucket""")
def q_container_sizes(spark, sf_dir):
    """Mapping M3: what every container of the stay table takes."""
    m = fixtures.m3(spark, sf_dir)
    table = stay.region_hour_stay(m.signals, m.region_cell, build_user_index(m.indexed_users))
    return table.select("region_id", "produce_hour", "bucket", "n", containers.stored_bytes(table).alias("n_bytes"))


# Region of a cell over time: versions of a cell from the orders, placed in the events' month.
@query("asof_enrich", oracle("""
, versions AS (SELECT CAST(o_custkey % 30 AS VARCHAR) AS laccell,
    TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * CAST(o_orderkey % 43200 AS INTEGER) AS valid_from,
    max(CAST(o_orderkey AS BIGINT)) AS version FROM orders GROUP BY ALL)
SELECT s.event_id, s.laccell, v.version, CAST(v.version % 9 AS VARCHAR) AS region_id
FROM signals s ASOF LEFT JOIN versions v ON s.laccell = v.laccell AND s.ts >= v.valid_from"""))
def q_asof_enrich(spark, sf_dir):
    """Each signal with the region that its cell belonged to at the signal's time."""
    orders = fixtures.table(spark, sf_dir, "orders")
    valid = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(o_orderkey % 43200 AS INT))")
    versions = orders.select(F.expr("CAST(o_custkey % 30 AS STRING)").alias("laccell"), valid.alias("valid_from"),
                             F.col("o_orderkey").cast("long").alias("version"),
                             F.expr("CAST(o_orderkey % 9 AS STRING)").alias("region_id"))
    signals = fixtures.m1_signals(spark, sf_dir).select("event_id", "laccell", "ts")
    return asof_join(signals, versions, ["laccell"], "ts", ["version", "region_id"]).drop("ts")


@query("segment_matrix", oracle("""
SELECT s.region_id, s.produce_hour, p.portrait_id, CAST(count(*) AS BIGINT) AS user_count
FROM stay_rows s JOIN portrait_rows p ON s.bitmap_id = p.bitmap_id GROUP BY ALL"""))
def q_segment_matrix(spark, sf_dir):
    m = fixtures.m1(spark, sf_dir)
    index = build_user_index(m.indexed_users)
    return segments.segment_matrix(stay.stay_rows(m.signals, m.region_cell, index),
                                   portrait.portrait_rows(m.user_info, index))


@query("segment_matrix_and", oracle("""
SELECT s.region_id, s.produce_hour, p.portrait_id, CAST(count(*) AS BIGINT) AS user_count
FROM stay_rows s JOIN portrait_rows p ON s.bitmap_id = p.bitmap_id GROUP BY ALL"""))
def q_segment_matrix_and(spark, sf_dir):
    m = fixtures.m1(spark, sf_dir)
    index = build_user_index(m.indexed_users)
    return segments.segment_matrix_and(stay.region_hour_stay(m.signals, m.region_cell, index),
                                       portrait.portrait_bitmaps(m.user_info, index))


@query("result_json", oracle(f"""
SELECT s.bitmap_id // 32768 + 1 AS bucket,
       CAST(json_object('users', list(s.bitmap_id ORDER BY s.bitmap_id)) AS VARCHAR) AS doc
FROM stay_rows s JOIN portrait_rows p ON s.bitmap_id = p.bitmap_id WHERE {_SEG_WHERE}
GROUP BY ALL"""))
def q_result_json(spark, sf_dir):
    users = segments.segment_users(m1_stay_bitmaps(spark, sf_dir),
                                   m1_portrait_bitmaps(spark, sf_dir),
                                   SEGMENT_REGION, SEGMENT_HOUR, SEGMENT_PORTRAIT)
    return segments.users_json(users)


@query("count_json", oracle(f"""
SELECT CAST(json_object('cnt', count(*)) AS VARCHAR) AS doc
FROM stay_rows s JOIN portrait_rows p ON s.bitmap_id = p.bitmap_id WHERE {_SEG_WHERE}"""))
def q_count_json(spark, sf_dir):
    return segments.count_json(q_segment_count(spark, sf_dir))


@query("users_json_empty", oracle("""
SELECT CAST(NULL AS BIGINT) AS bucket, CAST(json_object('users', []) AS VARCHAR) AS doc
FROM (SELECT count(*) AS n FROM stay_rows WHERE region_id = 'nowhere') WHERE n = 0"""))
def q_users_json_empty(spark, sf_dir):
    """A segment without users is a document with an empty list."""
    users = segments.segment_users(m1_stay_bitmaps(spark, sf_dir), m1_portrait_bitmaps(spark, sf_dir),
                                   "nowhere", SEGMENT_HOUR, SEGMENT_PORTRAIT)
    return segments.users_json(users)


# ----------------------------------------------- persona batch twins (A5-A7)

_IND = """
  CAST(sum(CASE WHEN gender = '1' THEN 1 ELSE 0 END) AS BIGINT) AS man,
  CAST(sum(CASE WHEN gender = '1' THEN 0 ELSE 1 END) AS BIGINT) AS women,
  CAST(sum(CASE WHEN age >= 10 AND age < 20 THEN 1 ELSE 0 END) AS BIGINT) AS age_10_20,
  CAST(sum(CASE WHEN age >= 20 AND age < 40 THEN 1 ELSE 0 END) AS BIGINT) AS age_20_40,
  CAST(sum(CASE WHEN age >= 40 THEN 1 ELSE 0 END) AS BIGINT) AS age_40"""


@query("persona_window", oracle(f"""
SELECT region_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('minute', ts) + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
       {_IND}
FROM enriched GROUP BY ALL"""))
def q_persona_window(spark, sf_dir):
    pw = persona.persona_window(m1_enriched(spark, sf_dir))
    return pw.select("region_id", _ts_text("window_start").alias("window_start"),
                     _ts_text("window_end").alias("window_end"), *PERSONA_COLUMNS)


@query("persona_window_preagg", oracle(f"""
SELECT region_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('minute', ts) + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
       {_IND}
FROM enriched GROUP BY ALL"""))
def q_persona_window_preagg(spark, sf_dir):
    m = fixtures.m1(spark, sf_dir)
    pw = persona.persona_window_preagg(m.signals, m.user_info, m.region_cell)
    return pw.select("region_id", _ts_text("window_start").alias("window_start"),
                     _ts_text("window_end").alias("window_end"), *PERSONA_COLUMNS)


_RUN = ", ".join(
    f"CAST(sum({cond}) OVER (PARTITION BY region_id, date_trunc('minute', ts) "
    f"ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS {n}"
    for n, cond in [
        ("man", "CASE WHEN gender = '1' THEN 1 ELSE 0 END"),
        ("women", "CASE WHEN gender = '1' THEN 0 ELSE 1 END"),
        ("age_10_20", "CASE WHEN age >= 10 AND age < 20 THEN 1 ELSE 0 END"),
        ("age_20_40", "CASE WHEN age >= 20 AND age < 40 THEN 1 ELSE 0 END"),
        ("age_40", "CASE WHEN age >= 40 THEN 1 ELSE 0 END")])


@query("persona_running", oracle(f"""
SELECT region_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       event_id, imsi, {_RUN}
FROM enriched"""))
def q_persona_running(spark, sf_dir):
    run = persona.persona_running(m1_enriched(spark, sf_dir))
    return run.select("region_id", _ts_text("window_start").alias("window_start"),
                      "event_id", "imsi", *PERSONA_COLUMNS)


FLOWS_SQL = """
flows_base AS (
  SELECT *, lag(region_id) OVER (PARTITION BY imsi ORDER BY ts, event_id) AS prev_region
  FROM enriched
),
changes AS (
  SELECT imsi, ts, event_id, region_id, gender, age,
         lag(region_id) OVER w AS left_region, lag(gender) OVER w AS left_gender,
         lag(age) OVER w AS left_age
  FROM flows_base
  WHERE prev_region IS NULL OR prev_region <> region_id
  WINDOW w AS (PARTITION BY imsi ORDER BY ts, event_id)
),
flows AS (
  SELECT imsi, ts, event_id, 1 AS is_in, region_id, gender, age FROM changes
  UNION ALL
  SELECT imsi, ts, event_id, 0 AS is_in, left_region, left_gender, left_age FROM changes
  WHERE left_region IS NOT NULL
)
"""


def flows_oracle(body: str) -> str:
    return "WITH " + fixtures.ORACLE_M1.strip() + ",\n" + FLOWS_SQL.strip() + "\n" + body.strip()


_SIGNED = """
  CAST(sum(CASE WHEN gender = '1' THEN s ELSE 0 END) AS BIGINT) AS man,
  CAST(sum(CASE WHEN gender = '1' THEN 0 ELSE s END) AS BIGINT) AS women,
  CAST(sum(CASE WHEN age >= 10 AND age < 20 THEN s ELSE 0 END) AS BIGINT) AS age_10_20,
  CAST(sum(CASE WHEN age >= 20 AND age < 40 THEN s ELSE 0 END) AS BIGINT) AS age_20_40,
  CAST(sum(CASE WHEN age >= 40 THEN s ELSE 0 END) AS BIGINT) AS age_40"""

HEADCOUNT_SQL = f"""
headcount AS (
  SELECT region_id, {_SIGNED}
  FROM (SELECT *, CASE WHEN is_in = 1 THEN 1 ELSE -1 END AS s FROM flows) f
  GROUP BY region_id
)
"""


def headcount_oracle(body: str) -> str:
    return ("WITH " + fixtures.ORACLE_M1.strip() + ",\n" + FLOWS_SQL.strip() + ",\n"
            + HEADCOUNT_SQL.strip() + "\n" + body.strip())


@query("region_flow", flows_oracle("""
SELECT imsi, event_id, CAST(is_in AS INTEGER) AS is_in, region_id, gender, age FROM flows"""))
def q_region_flow(spark, sf_dir):
    return m1_flows(spark, sf_dir).select("imsi", "event_id", "is_in", "region_id",
                                          "gender", "age")


@query("region_headcount", headcount_oracle("SELECT * FROM headcount"))
def q_region_headcount(spark, sf_dir):
    return persona.region_headcount(m1_flows(spark, sf_dir))


@query("persona_lookup", headcount_oracle(
    f"SELECT * FROM headcount WHERE region_id = '{LOOKUP_REGION}'"))
def q_persona_lookup(spark, sf_dir):
    path = scratch_path(spark, "persona")
    persona.region_headcount(m1_flows(spark, sf_dir)).write.mode("overwrite").parquet(path)
    return persona.persona_lookup(spark.read.parquet(path), LOOKUP_REGION)


@query("persona_lookup_json_miss", headcount_oracle("""
SELECT 'nowhere' AS region_id, '{}' AS doc FROM (SELECT count(*) AS n FROM headcount
WHERE region_id = 'nowhere') m WHERE n = 0"""))
def q_persona_lookup_json_miss(spark, sf_dir):
    """An unknown region is an empty document."""
    return persona.persona_lookup_json(persona.region_headcount(m1_flows(spark, sf_dir)), "nowhere")


@query("persona_cells", headcount_oracle("""
SELECT region_id, qualifier, value FROM (
  SELECT region_id, 'man' AS qualifier, CAST(man AS VARCHAR) AS value FROM headcount
  UNION ALL SELECT region_id, 'women', CAST(women AS VARCHAR) FROM headcount
  UNION ALL SELECT region_id, 'age_10_20', CAST(age_10_20 AS VARCHAR) FROM headcount
  UNION ALL SELECT region_id, 'age_20_40', CAST(age_20_40 AS VARCHAR) FROM headcount
  UNION ALL SELECT region_id, 'age_40', CAST(age_40 AS VARCHAR) FROM headcount) c"""))
def q_persona_cells(spark, sf_dir):
    return persona.persona_cells(persona.region_headcount(m1_flows(spark, sf_dir)))


@query("persona_json", headcount_oracle("""
SELECT region_id,
       CAST(json_object('man', CAST(man AS VARCHAR), 'women', CAST(women AS VARCHAR),
                        'age_10_20', CAST(age_10_20 AS VARCHAR),
                        'age_20_40', CAST(age_20_40 AS VARCHAR),
                        'age_40', CAST(age_40 AS VARCHAR)) AS VARCHAR) AS doc
FROM headcount"""))
def q_persona_json(spark, sf_dir):
    return persona.persona_json(persona.region_headcount(m1_flows(spark, sf_dir)))


@query("enrich_rejects", oracle("""
SELECT s.event_id, s.imsi, s.laccell,
       CASE WHEN u.imsi IS NULL THEN 'unknown_user' ELSE 'unknown_cell' END AS reason
FROM signals s LEFT JOIN user_info u ON s.imsi = u.imsi
LEFT JOIN region_cell rc ON s.laccell = rc.laccell
WHERE u.imsi IS NULL OR rc.laccell IS NULL"""))
def q_enrich_rejects(spark, sf_dir):
    m = fixtures.m1(spark, sf_dir)
    return (persona.enrich_rejects(m.signals, m.user_info, m.region_cell)
            .select("event_id", "imsi", "laccell", "reason"))


@query("portrait_rejects", """
WITH user_info AS (
  SELECT CAST(p_partkey AS VARCHAR) AS imsi,
         CAST(CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) % 3 AS VARCHAR) AS gender,
         CAST(p_size AS INTEGER) AS age
  FROM part
),
user_index AS (
  SELECT imsi, CAST(row_number() OVER (ORDER BY imsi) - 1 AS BIGINT) AS bitmap_id
  FROM (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS imsi FROM part) p
)
SELECT u.gender AS portrait_value, ui.bitmap_id
FROM user_info u JOIN user_index ui ON u.imsi = ui.imsi
WHERE u.age >= 10 AND u.gender NOT IN ('0', '1')""")
def q_portrait_rejects(spark, sf_dir):
    """Mapping M2 (parts as users): brand number % 3 = 2 is an unknown gender."""
    m = fixtures.m2(spark, sf_dir)
    rejects = portrait.portrait_rejects(m.user_info, build_user_index(m.indexed_users))
    return rejects.select("portrait_value", "bitmap_id")

"""Sources, parsing, dimensions and sinks over mapping M1.

Delimited-text inputs are produced by Spark from the supplied tables and
written under the shared checkpoint folder, then read back through the
operator under test.  The signal feed carries defects derived from the data:
an ``error`` event becomes a short line (``imsi`` only) when its value is
below 20 and a bad-number line (``imsi|laccell|x``) otherwise; a customer
with a negative balance has a non-numeric age.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope.functions import containers
from cellscope.functions.scalar import hour_bucket
from cellscope.operators import stay
from cellscope.operators.index import build_user_index
from cellscope.operators.sinks import write_hourly, write_partitioned, write_table
from cellscope.plans.batch_queries import ALL_USERS, SEGMENT_HOUR, SEGMENT_REGION, m1_stay_bitmaps
from cellscope.plans import jobs
from cellscope.plans.catalog import query
from cellscope.schemas import SIGNAL
from cellscope.session import scratch_path
from cellscope.sources import delimited, files, fixtures
from cellscope.sources.dimensions import user_dimension
from cellscope.sources.fixtures import oracle

SIGNAL_FIELDS = ["imsi", "laccell", "latitude", "longitude", "procedureStartTime"]


def _signal_lines(spark: SparkSession, sf_dir: str, with_defects: bool) -> str:
    e = fixtures.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    s = fixtures.m1_signals(spark, sf_dir).join(e, "event_id")
    good = F.concat_ws("|", *[F.col(c).cast("string") for c in SIGNAL_FIELDS])
    line = good
    if with_defects:
        line = (F.when((F.col("event_type") == "error") & (F.col("value") < 20), F.col("imsi"))
                 .when(F.col("event_type") == "error",
                       F.concat_ws("|", "imsi", "laccell", F.lit("x")))
                 .otherwise(good))
    path = scratch_path(spark, "signal-lines")
    s.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def _user_lines(spark: SparkSession, sf_dir: str, with_defects: bool) -> str:
    c = fixtures.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    u = fixtures.m1_user_info(spark, sf_dir).join(
        c.select(F.col("c_custkey").cast("string").alias("imsi"), "c_acctbal"), "imsi")
    age = F.col("age").cast("string")
    if with_defects:
        age = F.when(F.col("c_acctbal") < 0, F.lit("n/a")).otherwise(age)
    path = scratch_path(spark, "user-lines")
    u.select(F.concat_ws("|", "imsi", "gender", age).alias("value")) \
     .write.mode("overwrite").text(path)
    return path


def _cell_lines(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "cell-lines")
    delimited.write_lines(fixtures.m1_region_cell(spark, sf_dir), path, ["region_id", "laccell"])
    return path


# ------------------------------------------------------------ typed scans

@query("scan_signals", oracle(
    "SELECT imsi, laccell, latitude, longitude, procedureStartTime FROM signals"))
def q_scan_signals(spark, sf_dir):
    return delimited.read_signals(spark, _signal_lines(spark, sf_dir, False))


@query("scan_region_cell", oracle("SELECT region_id, laccell FROM region_cell"))
def q_scan_region_cell(spark, sf_dir):
    return delimited.read_region_cell(spark, _cell_lines(spark, sf_dir))


@query("scan_user_info", oracle("SELECT imsi, gender, age FROM user_info"))
def q_scan_user_info(spark, sf_dir):
    return delimited.read_user_info(spark, _user_lines(spark, sf_dir, False))


@query("text_first_field", oracle("SELECT imsi FROM user_info"))
def q_text_first_field(spark, sf_dir):
    lines = delimited.read_lines(spark, _user_lines(spark, sf_dir, True))
    return delimited.first_field(lines, "imsi")


@query("hour_partition_scan", oracle(f"""
SELECT imsi, laccell, procedureStartTime FROM signals
WHERE strftime(ts, '%Y%m%d%H') = '{SEGMENT_HOUR}'"""))
def q_hour_partition_scan(spark, sf_dir):
    path = scratch_path(spark, "signals-by-hour")
    s = fixtures.m1_signals(spark, sf_dir).select(*SIGNAL_FIELDS)
    hour = hour_bucket("procedureStartTime")
    write_partitioned(s.withColumn("dt", F.substring(hour, 1, 8))
                       .withColumn("hh", F.substring(hour, 9, 2)), path, ["dt", "hh"])
    schema = T.StructType(SIGNAL.fields + [T.StructField("dt", T.StringType()),
                                           T.StructField("hh", T.StringType())])
    one_hour = (spark.read.schema(schema).parquet(path)
                .where((F.col("dt") == SEGMENT_HOUR[:8]) & (F.col("hh") == SEGMENT_HOUR[8:])))
    return one_hour.select("imsi", "laccell", "procedureStartTime")


# ----------------------------------------------------------------- parsing

@query("parse_signals_lenient", oracle("""
SELECT s.imsi, s.laccell FROM signals s JOIN events e ON s.event_id = e.event_id
WHERE NOT (e.event_type = 'error' AND e.value < 20)"""))
def q_parse_signals_lenient(spark, sf_dir):
    lines = delimited.read_lines(spark, _signal_lines(spark, sf_dir, True))
    return delimited.parse_signals_lenient(lines)


@query("parse_users_lenient", oracle("""
SELECT u.imsi, u.gender, u.age FROM user_info u
JOIN customer c ON u.imsi = CAST(c.c_custkey AS VARCHAR) WHERE c.c_acctbal >= 0"""))
def q_parse_users_lenient(spark, sf_dir):
    lines = delimited.read_lines(spark, _user_lines(spark, sf_dir, True))
    return delimited.parse_users_lenient(lines)


@query("parse_region_cell_lenient", oracle("SELECT laccell, region_id FROM region_cell"))
def q_parse_region_cell_lenient(spark, sf_dir):
    lines = delimited.read_lines(spark, _cell_lines(spark, sf_dir))
    return delimited.parse_region_cell_lenient(lines)


@query("parse_strict", oracle(
    "SELECT imsi, laccell, latitude, longitude, procedureStartTime FROM signals"))
def q_parse_strict(spark, sf_dir):
    return delimited.read_strict(spark, _signal_lines(spark, sf_dir, False), SIGNAL)


@query("parse_rejects", oracle("""
SELECT CASE WHEN e.value < 20 THEN s.imsi ELSE s.imsi || '|' || s.laccell || '|x' END AS line
FROM signals s JOIN events e ON s.event_id = e.event_id WHERE e.event_type = 'error'"""))
def q_parse_rejects(spark, sf_dir):
    lines = delimited.read_lines(spark, _signal_lines(spark, sf_dir, True))
    return delimited.rejects(lines, delimited.line_is_valid(SIGNAL))


def _split(lines, parsed, valid):
    """Parsed rows and rejects in one table: together they must be all lines."""
    kept = parsed.select(F.lit("kept").alias("part"),
                         F.concat_ws("|", *[F.col(c).cast("string") for c in parsed.columns]).alias("line"))
    return kept.unionByName(delimited.rejects(lines, valid).select(F.lit("reject").alias("part"), "line"))


# Defects by event or customer number: empty, negative, missing and further fields.
_BAD_SIGNAL = """
SELECT event_id, CASE event_id % 7 WHEN 1 THEN imsi || '|' || laccell || '|||1' WHEN 2 THEN imsi || '|' || laccell || '|1|2|'
  WHEN 3 THEN imsi || '|' || laccell || '|1|2|3|4' WHEN 4 THEN imsi WHEN 5 THEN ''
  ELSE imsi || '|' || laccell || '|0.5|0.25|' || procedureStartTime END AS line FROM signals"""


@query("parse_rejects_signals", oracle(f"""
SELECT CASE WHEN event_id % 7 IN (0, 6) THEN 'kept' ELSE 'reject' END AS part, line
FROM ({_BAD_SIGNAL}) b"""))
def q_parse_rejects_signals(spark, sf_dir):
    s, n = fixtures.m1_signals(spark, sf_dir), F.col("event_id") % 7
    pair = F.concat_ws("|", "imsi", "laccell")
    line = (F.when(n == 1, F.concat(pair, F.lit("|||1"))).when(n == 2, F.concat(pair, F.lit("|1|2|")))
             .when(n == 3, F.concat(pair, F.lit("|1|2|3|4"))).when(n == 4, F.col("imsi"))
             .when(n == 5, F.lit(""))
             .otherwise(F.concat_ws("|", pair, F.lit("0.5"), F.lit("0.25"), "procedureStartTime")))
    path = delimited.write_lines(s.select(line.alias("value")), scratch_path(spark, "bad-signals"))
    lines = delimited.read_lines(spark, path)
    return _split(lines, delimited.parse_signals_full(lines), delimited.signal_is_valid())


@query("parse_rejects_users", oracle("""
SELECT CASE WHEN c % 5 IN (0, 4) THEN 'kept' ELSE 'reject' END AS part,
  CASE c % 5 WHEN 1 THEN imsi || '|1|' WHEN 2 THEN imsi || '|1|-5' WHEN 3 THEN imsi || '|1'
  ELSE imsi || '|' || gender || '|' || age END AS line
FROM (SELECT *, CAST(imsi AS BIGINT) AS c FROM user_info) u"""))
def q_parse_rejects_users(spark, sf_dir):
    """Lines with a fourth field are kept for their first three."""
    u, n = fixtures.m1_user_info(spark, sf_dir), F.col("imsi").cast("long") % 5
    whole = F.concat_ws("|", "imsi", "gender", "age")
    line = (F.when(n == 1, F.concat("imsi", F.lit("|1|"))).when(n == 2, F.concat("imsi", F.lit("|1|-5")))
             .when(n == 3, F.concat("imsi", F.lit("|1"))).when(n == 4, F.concat(whole, F.lit("|x")))
             .otherwise(whole))
    path = delimited.write_lines(u.select(line.alias("value")), scratch_path(spark, "bad-users"))
    lines = delimited.read_lines(spark, path)
    return _split(lines, delimited.parse_users_lenient(lines), delimited.user_is_valid())


@query("parse_rejects_cells", oracle("""
SELECT CASE WHEN c % 3 = 1 THEN 'reject' ELSE 'kept' END AS part,
  CASE c % 3 WHEN 1 THEN region_id ELSE laccell || '|' || region_id END AS line
FROM (SELECT *, CAST(laccell AS BIGINT) AS c FROM region_cell) r"""))
def q_parse_rejects_cells(spark, sf_dir):
    r, n = fixtures.m1_region_cell(spark, sf_dir), F.col("laccell").cast("long") % 3
    pair = F.concat_ws("|", "region_id", "laccell")
    line = F.when(n == 1, F.col("region_id")).when(n == 2, F.concat(pair, F.lit("|more"))).otherwise(pair)
    path = delimited.write_lines(r.select(line.alias("value")), scratch_path(spark, "bad-cells"))
    lines = delimited.read_lines(spark, path)
    return _split(lines, delimited.parse_region_cell_lenient(lines), delimited.cell_is_valid())


# -------------------------------------------------------------- dimensions

_EDITED_USERS = """
SELECT u.imsi, u.gender,
       CASE WHEN c.c_acctbal < 0 THEN u.age + 1 ELSE u.age END AS age
FROM user_info u JOIN customer c ON u.imsi = CAST(c.c_custkey AS VARCHAR)"""


@query("dim_latest_per_key", oracle(_EDITED_USERS))
def q_dim_latest_per_key(spark, sf_dir):
    """Base profile file, then an edit file in which every customer with a
    negative balance appears twice (age+5, then age+1): the last line wins."""
    path = scratch_path(spark, "user-dimension")
    users = fixtures.m1_user_info(spark, sf_dir)
    delimited.write_lines(users, f"{path}/v1", ["imsi", "gender", "age"])
    c = fixtures.table(spark, sf_dir, "customer")
    edited = (users.join(c.where(F.col("c_acctbal") < 0)
                          .select(F.col("c_custkey").cast("string").alias("imsi")), "imsi")
                   .select("imsi", "gender", "age",
                           F.explode(F.array(F.lit(5), F.lit(1))).alias("bump")))
    edits = (edited.withColumn("seq", F.when(F.col("bump") == 5, 0).otherwise(1))
                   .withColumn("age", F.col("age") + F.col("bump"))
                   .repartitionByRange("imsi").sortWithinPartitions("imsi", "seq"))
    delimited.write_lines(edits, f"{path}/v2", ["imsi", "gender", "age"])
    return user_dimension(spark, f"{path}/*").select("imsi", "gender", "age")


@query("dim_ttl", oracle("""
SELECT imsi, gender, age FROM user_info WHERE CAST(imsi AS BIGINT) % 3 <> 0"""))
def q_dim_ttl(spark, sf_dir):
    """Two folders, one of which was last written beyond the TTL: its keys are gone."""
    path = scratch_path(spark, "user-dimension-ttl")
    users, old = fixtures.m1_user_info(spark, sf_dir), F.col("imsi").cast("long") % 3 == 0
    delimited.write_lines(users.where(~old), f"{path}/new", ["imsi", "gender", "age"])
    delimited.write_lines(users.where(old), f"{path}/old", ["imsi", "gender", "age"])
    for file, changed, _ in files.listing(spark, f"{path}/old", deep=True):
        files.set_time(spark, file, changed - 3 * 86400 * 1000)
    return user_dimension(spark, f"{path}/*", ttl_seconds=86400).select("imsi", "gender", "age")


# ------------------------------------------------------------------- sinks

@query("sink_overwrite", oracle(ALL_USERS))
def q_sink_overwrite(spark, sf_dir):
    """The index job run twice: the second run replaces, never duplicates."""
    path = scratch_path(spark, "user-index")
    for _ in range(2):
        write_table(build_user_index(fixtures.m1_user_info(spark, sf_dir)), path)
    return spark.read.parquet(path)




@query("sink_hour_overwrite", oracle("""
SELECT region_id, produce_hour, CAST(count(bitmap_id) AS BIGINT) AS user_count
FROM stay_rows GROUP BY region_id, produce_hour"""))
def q_sink_hour_overwrite(spark, sf_dir):
    """All hours written once, then one hour re-run: only that hour is replaced."""
    path = scratch_path(spark, "stay-hourly")
    bitmaps = m1_stay_bitmaps(spark, sf_dir)
    write_hourly(bitmaps, path)
    rerun = m1_stay_bitmaps(spark, sf_dir).where(F.col("produce_hour") == SEGMENT_HOUR)
    write_hourly(rerun, path, hours=[SEGMENT_HOUR])
    return stay.stay_user_count(stay.read_stay_table(spark, path))


@query("parameterised_query", oracle(f"""
SELECT region_id, produce_hour, CAST(count(bitmap_id) AS BIGINT) AS user_count
FROM stay_rows WHERE region_id = '{SEGMENT_REGION}' AND produce_hour = '{SEGMENT_HOUR}'
GROUP BY region_id, produce_hour"""))
def q_parameterised_query(spark, sf_dir):
    counts = stay.stay_user_count(m1_stay_bitmaps(spark, sf_dir))
    return spark.sql(
        "SELECT region_id, produce_hour, user_count FROM {stay_counts} "
        "WHERE region_id = :region AND produce_hour = :hour",
        args={"region": SEGMENT_REGION, "hour": SEGMENT_HOUR}, stay_counts=counts)


# ---------------------------------------------------------- scheduled jobs

@query("job_daily_index", oracle("""
SELECT imsi, bitmap_id FROM user_index
UNION ALL
SELECT imsi, CAST((SELECT max(bitmap_id) + 1 FROM user_index)
                  + row_number() OVER (ORDER BY imsi) - 1 AS BIGINT) AS bitmap_id
FROM (SELECT DISTINCT imsi FROM user_info
      WHERE imsi NOT IN (SELECT imsi FROM user_index)) fresh"""))
def q_job_daily_index(spark, sf_dir):
    """First run over some users, next day over all: known ids stay."""
    base = scratch_path(spark, "daily-index")
    jobs.daily_index_job(spark, fixtures.m1_indexed_users(spark, sf_dir), f"{base}/none", f"{base}/v1",
                         first_run=True)
    return jobs.daily_index_job(spark, fixtures.m1_user_info(spark, sf_dir), f"{base}/v1", f"{base}/v2")


@query("job_daily_portraits", oracle("""
SELECT portrait_id, portrait_value, comment, CAST(count(*) AS BIGINT) AS user_count
FROM portrait_rows GROUP BY ALL"""))
def q_job_daily_portraits(spark, sf_dir):
    base = scratch_path(spark, "daily-portraits")
    m = fixtures.m1(spark, sf_dir)
    for _ in range(2):
        table = jobs.daily_portrait_job(spark, m.user_info, build_user_index(m.indexed_users), base)
    return containers.cardinality(table, ["portrait_id", "portrait_value", "comment"])


@query("job_hourly_stay", oracle(f"""
SELECT region_id, produce_hour, CAST(count(bitmap_id) AS BIGINT) AS user_count
FROM stay_rows WHERE substr(produce_hour, 1, 8) = '{SEGMENT_HOUR[:8]}'
GROUP BY region_id, produce_hour"""))
def q_job_hourly_stay(spark, sf_dir):
    """The hourly job over one day (its feature: one run for each hour folder of a day).  A day's delimited hour folders, each holding some signals of the hour before it
    (late); one hour is first run on rows that a corrected feed no longer has, then again."""
    m, root = fixtures.m1(spark, sf_dir), scratch_path(spark, "hour-folders")
    out, index = scratch_path(spark, "hourly-stay"), build_user_index(m.indexed_users)
    day = m.signals.withColumn("hour", hour_bucket("procedureStartTime")).where(
        F.substring("hour", 1, 8) == SEGMENT_HOUR[:8])
    late = (F.col("event_id") % 5 == 0) & (F.substring("hour", 9, 2) < "23")
    folder = F.substring("hour", 9, 2).cast("int") + F.when(late, 1).otherwise(0)
    line = F.concat_ws("|", *[F.col(c).cast("string") for c in SIGNAL_FIELDS]).alias("value")
    lines = day.select(line, F.lit(SEGMENT_HOUR[:8]).alias("dt"), F.lpad(folder.cast("string"), 2, "0").alias("hh"))
    lines.write.partitionBy("dt", "hh").text(root)
    hours = [f"{SEGMENT_HOUR[:8]}{h:02}" for h in range(24)]
    wrong = scratch_path(spark, "wrong-folders")
    lines.withColumn("value", F.regexp_replace("value", r"\d{6}$", "000000")).where("hh = '05'").write.partitionBy(
        "dt", "hh").text(wrong)
    for source, hour in [(wrong, hours[5]), *[(root, h) for h in hours], (root, hours[5])]:
        jobs.hourly_stay_job(spark, source, hour, m.region_cell, index, out, fmt="delimited")
    return stay.stay_user_count(jobs.read_hourly_stay(spark, out))

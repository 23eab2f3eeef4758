import datetime as dt

import pytest

from cellscope.functions import containers
from cellscope.operators import stay
from cellscope.operators.sinks import write_partitioned
from cellscope.plans import jobs
from cellscope.schemas import SIGNAL

H10 = int(dt.datetime(2024, 1, 1, 10, 30, tzinfo=dt.timezone.utc).timestamp() * 1000)
H11 = H10 + 3_600_000


def _signals(spark, root, rows):
    df = spark.createDataFrame([(i, c, 0.0, 0.0, t, d, h) for i, c, t, d, h in rows],
                               "imsi string, laccell string, latitude double, longitude double, "
                               "procedureStartTime long, dt string, hh string")
    write_partitioned(df, root, ["dt", "hh"])


def test_daily_and_hourly_jobs(spark, workdir):
    users = spark.createDataFrame([("u1", "1", 25), ("u2", "0", 15)],
                                  "imsi string, gender string, age int")
    cells = spark.createDataFrame([("A", "c1")], "region_id string, laccell string")
    idx = jobs.daily_index_job(spark, users, f"{workdir}/index/v0", f"{workdir}/index/v1",
                               first_run=True)
    assert {r.imsi: r.bitmap_id for r in idx.collect()} == {"u1": 0, "u2": 1}
    more = users.unionByName(spark.createDataFrame([("u0", "1", 50)], users.schema))
    idx2 = jobs.daily_index_job(spark, more, f"{workdir}/index/v1", f"{workdir}/index/v2")
    assert {r.imsi: r.bitmap_id for r in idx2.collect()} == {"u1": 0, "u2": 1, "u0": 2}
    port = jobs.daily_portrait_job(spark, users, idx2, f"{workdir}/portraits")
    assert containers.cardinality(port, ["portrait_id"]).count() == 4

    root, out = f"{workdir}/signals", f"{workdir}/stay"
    # Folder 10 holds u1 at 10:30; folder 11 holds u2 at 11:30 and a late u2 at 10:30.
    _signals(spark, root, [("u1", "c1", H10, "20240101", "10"),
                           ("u2", "c1", H11, "20240101", "11"),
                           ("u2", "c1", H10, "20240101", "11")])
    jobs.hourly_stay_job(spark, root, "2024010110", cells, idx2, out)
    jobs.hourly_stay_job(spark, root, "2024010111", cells, idx2, out)
    jobs.hourly_stay_job(spark, root, "2024010111", cells, idx2, out)   # re-run
    counts = {r.produce_hour: r.user_count for r in
              stay.stay_user_count(jobs.read_hourly_stay(spark, out)).collect()}
    # The late u2 row joins hour 10 without replacing u1.
    assert counts == {"2024010110": 2, "2024010111": 1}
    assert SIGNAL.fieldNames() == ["imsi", "laccell", "latitude", "longitude",
                                   "procedureStartTime"]


def test_missing_index_is_an_error_unless_first_run(spark, workdir):
    users = spark.createDataFrame([("u1",)], "imsi string")
    with pytest.raises(Exception):
        jobs.daily_index_job(spark, users, f"{workdir}/nothing", f"{workdir}/v1")


def test_rerun_of_an_emptied_source_hour_removes_it(spark, workdir):
    cells = spark.createDataFrame([("A", "c1")], "region_id string, laccell string")
    idx = spark.createDataFrame([("u1", 0), ("u2", 1)], "imsi string, bitmap_id long")
    first, second, out = (f"{workdir}/{n}" for n in ("first", "second", "stay"))
    _signals(spark, first, [("u1", "c1", H10, "20240101", "11"), ("u2", "c1", H11, "20240101", "11")])
    _signals(spark, second, [("u2", "c1", H11, "20240101", "11")])
    jobs.hourly_stay_job(spark, first, "2024010111", cells, idx, out)
    jobs.hourly_stay_job(spark, second, "2024010111", cells, idx, out)
    counts = {r.produce_hour: r.user_count for r in
              stay.stay_user_count(jobs.read_hourly_stay(spark, out)).collect()}
    assert counts == {"2024010111": 1}


def test_new_users_are_placed_by_group(spark, workdir):
    old = spark.createDataFrame([("u5",)], "imsi string")
    jobs.daily_index_job(spark, old, "", f"{workdir}/v1", first_run=True)
    users = spark.createDataFrame([(f"u{i}",) for i in range(8)], "imsi string")
    home = spark.createDataFrame([(f"u{i}", str(i % 2)) for i in range(8)], "imsi string, home_region string")
    got = {r.imsi: r.bitmap_id for r in jobs.daily_index_job(
        spark, users, f"{workdir}/v1", f"{workdir}/v2", locality=home).collect()}
    assert got == {"u5": 0, "u0": 1, "u2": 2, "u4": 3, "u6": 4, "u1": 5, "u3": 6, "u7": 7}

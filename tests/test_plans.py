"""Physical-plan assertions for the scale-relevant properties."""

import os

import pytest

from cellscope.operators import persona, portrait, segments, stay
from cellscope.operators.index import build_user_index
from cellscope.operators.sinks import write_hourly, write_table
from cellscope.sources import fixtures

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stay_scan_reads_only_needed_columns(spark):
    m = fixtures.m2(spark, SF)
    idx = build_user_index(m.indexed_users)
    plan = _plan(stay.region_hour_stay(m.signals, m.region_cell, idx))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz>" in plan
    # Visits are de-duplicated map-side before any shuffle on imsi.
    assert "HashAggregate(keys=[imsi" in plan


def test_segment_lookup_prunes_hours_and_pushes_filters(spark, workdir):
    m = fixtures.m2(spark, SF)
    idx = build_user_index(m.indexed_users)
    write_hourly(stay.region_hour_stay(m.signals, m.region_cell, idx), f"{workdir}/stay")
    write_table(portrait.portrait_bitmaps(m.user_info, idx), f"{workdir}/port")
    s = stay.read_stay_table(spark, f"{workdir}/stay")
    p = spark.read.parquet(f"{workdir}/port")
    plan = _plan(segments.segment_count(s, p, "3", "1995010200", 4))
    assert "PartitionFilters: [isnotnull(produce_hour" in plan
    assert "EqualTo(region_id,3)" in plan and "EqualTo(portrait_id,4)" in plan


def test_flows_never_gather_a_user_in_one_task(spark):
    m = fixtures.m1(spark, SF)
    flows = persona.region_flow(persona.enrich(m.signals, m.user_info, m.region_cell))
    plan = _plan(flows)
    # Both passes run over the range partitions that were written once: rows are neither
    # exchanged nor sorted again.
    assert "Exchange" not in plan and "Window" not in plan
    assert plan.count("Scan ExistingRDD") == 1


def test_enrich_counts_no_dimension_in_one_task(spark):
    m = fixtures.m1(spark, SF)
    plan = _plan(persona.enrich(m.signals, m.user_info, m.region_cell))
    assert "SinglePartition" not in plan

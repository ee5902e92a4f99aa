"""Physical plans: nothing that would not survive a thousand times the data."""

from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from checks import frames
from checks.registry import BUILDS
from curbsight.functions.common import with_deviation
from curbsight.operators import air_gold, traffic_gold
from curbsight.plans import jobs

SF = "/root/testdata/sf0.001"
# Queries that run a job or a stream while they are built; the rest are plain plans.
BUILT = ("rt_", "st_", "job_", "src_", "cdc_decode", "cdc_flatten")
PLAIN = [name for name in BUILDS if not name.startswith(BUILT)]


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAIN)
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(BUILDS[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["aq_q1", "aq_q2", "aq_q3", "tr_q1", "tr_q2", "tr_q5", "tr_q8", "doc_q1"])
def test_look_back_reaches_the_scan(spark, name):
    assert "GreaterThanOrEqual(ts," in plan_of(BUILDS[name](spark, SF))


@pytest.mark.parametrize("name", ["aq_q6", "tr_q3", "tr_q7", "tr_q10"])
def test_long_look_back_reaches_the_scan(spark, name):
    assert "GreaterThanOrEqual(o_orderdate," in plan_of(BUILDS[name](spark, SF))


@pytest.mark.parametrize("name", ["gold_air_hourly", "gold_traffic_hourly", "gold_congestion_trends", "aq_q1", "tr_q1"])
def test_aggregates_hash_and_do_not_sort(spark, name):
    plan = plan_of(BUILDS[name](spark, SF))
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Expand" not in plan


def test_readings_are_hashed_before_anything_sorts(spark):
    plan = plan_of(BUILDS["gold_air_daily"](spark, SF))
    # The plan prints from the result down to the scan.
    assert plan.rindex("HashAggregate") > plan.rindex("SortAggregate")


def test_only_needed_columns_are_read(spark):
    plan = plan_of(BUILDS["silver_data_range"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(BUILDS["aq_q3"](spark, SF))


@pytest.mark.parametrize("domain", [jobs.AIR, jobs.TRAFFIC])
def test_stored_rollups_send_their_rows_once(spark, domain):
    silver = {jobs.AIR: frames.air, jobs.TRAFFIC: frames.traffic}[domain](spark, SF)
    assert domain.rollup.arranged
    plan = plan_of(domain.rollup.build(silver))
    assert plan.count("Exchange") == 1 and "Sort" not in plan


@pytest.mark.parametrize("table", [t for t in jobs.AIR.tables if t.arranged])
def test_sensor_tables_send_the_rollup_once(spark, table):
    plan = plan_of(table.build(jobs.AIR.rollup.build(frames.air(spark, SF))))
    assert plan.count("Exchange") == 2  # one of them of the rollup


def test_deviations_sort_merged_parts_only(spark):
    """Windows see parts of equal size as one."""
    for build, frame, domain in ((air_gold.stored_zone_hours, frames.air, jobs.AIR),
                                 (traffic_gold.stored_intersection_hours, frames.traffic, jobs.TRAFFIC)):
        plan = plan_of(build(domain.rollup.build(frame(spark, SF))))
        # The plan prints from the result down to the scan.
        below = plan[plan.index("Window "):].split("Scan")[0]
        assert below.count("HashAggregate") == 4  # two of them of the rollup


def test_deviations_by_parts_of_equal_size_are_those_of_the_readings(spark):
    rows = [("a", x, n) for x, n in ((1e9 + 0.25, 1), (1e9 + 0.5, 1), (1e9, 3), (1e9 + 2, 3), (1e9 + 7, 2))]
    rows += [(None, 4.0, 1), (None, 6.0, 1), ("b", 5.0, 1), ("c", None, 0)]
    parts = spark.createDataFrame(
        [(k, None if x is None else x * n, n, 0.0) for k, x, n in rows], "k string, v__sum double, v__n long, v__m2 double")
    keyed = parts.select("k").distinct().withColumn("dev", F.lit(None).cast("double"))
    found = {r.k: r.dev for r in with_deviation(keyed, parts, ("k",), "v", "dev").collect()}
    for key in ("a", None):
        each = [x - (1e9 if key else 0) for k, x, n in rows if k == key for _ in range(n)]
        assert found[key] == pytest.approx(statistics.stdev(each), rel=1e-9)
    assert found["b"] is None and found["c"] is None

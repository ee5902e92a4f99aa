"""Reports over stored gold tables give what they give when computed straight from silver."""

from __future__ import annotations

import pytest

from checks import frames
from checks.compare import rows_of
from checks.registry import BUILDS, comparable
from curbsight.plans import jobs, saved

SF = "/root/testdata/sf0.001"
DIRECT = {
    "weekly_trend": "aq_q1",
    "today_by_sensor": "aq_q2",
    "most_polluted_zones": "aq_q3",
    "week_over_week": "aq_q5",
    "weather_and_aqi": "aq_q7",
    "missing_sensor_days": "aq_q8",
    "worst_hours": "doc_q1",
    "congested_hours": "doc_q2",
    "air_with_traffic": "doc_q3",
    "today_by_intersection": "tr_q2",
    "rush_hours": "tr_q4",
    "incident_profile": "tr_q5",
    "congested_quarter_hours": "tr_q6",
    "dangerous_intersections": "tr_q8",
    "flow_efficiency": "tr_q9",
}


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("gold"))
    for silver, domain in ((frames.air(spark, SF), jobs.AIR), (frames.traffic(spark, SF), jobs.TRAFFIC)):
        jobs.build_gold(silver, base, domain, frames.RUN_AT)
        jobs.register_gold(spark, "saved_gold", base, domain)
    jobs.store_quality(frames.air(spark, SF), base, frames.RUN_AT, "saved_gold")
    yield "saved_gold"
    spark.sql("DROP DATABASE saved_gold CASCADE")


@pytest.mark.parametrize("name", list(saved.REPORTS))
def test_report(spark, database, name):
    report = comparable(saved.run_report(spark, database, name, frames.AS_OF))
    rows = rows_of(report.columns, report.collect())
    if name in DIRECT:
        direct = comparable(BUILDS[DIRECT[name]](spark, SF))
        assert rows == rows_of(direct.columns, direct.collect())
    elif name != "congestion_hotspots":
        assert rows


def test_stored_tables_are_pruned(spark, database):
    plan = saved.run_report(spark, database, "weekly_trend", frames.AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "year" in plan.split("PartitionFilters: [")[1].split("]")[0]

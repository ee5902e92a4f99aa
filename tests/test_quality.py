from __future__ import annotations

import datetime as dt

import pytest

from curbsight.operators import quality
from tests.rows import air


@pytest.mark.parametrize(
    ("change", "valid"),
    [
        ({"pm25": 0.0}, True), ({"pm25": 499.99}, True), ({"pm25": 500.0}, False), ({"pm25": -0.1}, False),
        ({"pm25": None}, False),
        ({"temperature_celsius": -50.0}, True), ({"temperature_celsius": 60.0}, True),
        ({"temperature_celsius": 60.1}, False), ({"temperature_celsius": None}, False),
        ({"latitude": 90.0, "longitude": -180.0}, True), ({"latitude": 90.1}, False), ({"longitude": None}, False),
        ({"sensor_id": None}, False),
    ],
)
def test_rule_edges(spark, change, valid):
    rows, rules = air(spark, change), quality.air_rules()
    assert quality.accepted(rows, rules).count() == int(valid)
    assert quality.quarantine(rows, rules).count() == int(not valid)


def test_quarantine_names_every_failed_rule(spark):
    row = quality.quarantine(air(spark, {"pm25": None, "latitude": 95.0, "sensor_id": None}), quality.air_rules()).first()
    assert row.failed_rules == ["pm25", "coordinates", "sensor_id"]


def test_summary_counts_add_up(spark):
    rows = air(spark, {}, {"pm25": None}, {"pm25": 999.0, "sensor_id": None})
    row = rows.agg(*quality.summary(quality.air_rules())).first()
    assert (row.rows_in, row.rows_valid, row.rows_rejected, row.failed_pm25, row.failed_sensor_id) == (3, 1, 2, 2, 1)


def test_documented_ranges_allow_missing(spark):
    rows = air(spark, {"pm10": None}, {"pm10": 500.0}, {"pm10": 500.1})
    report = {r.rule: r.violations for r in quality.rule_report(rows, quality.documented_air_rules(rows.columns)).collect()}
    assert report["pm10"] == 1 and "co" not in report


def test_gold_rules(spark):
    frame = spark.sql(
        "SELECT * FROM VALUES (timestamp '2024-01-01 10:00:00', 1L), (timestamp '2024-01-01 10:15:00', 0L), "
        "(timestamp '2010-01-01 10:00:00', 1L), (timestamp '2024-03-01 10:00:00', 1L) AS t(ts, n)"
    )
    rules = quality.gold_rules("ts", "n", dt.datetime(2024, 2, 29), 60)
    report = {r.rule: r.violations for r in quality.rule_report(frame, rules).collect()}
    assert report == {"reading_count_positive": 1, "within_ten_years": 2, "bucket_aligned": 1}

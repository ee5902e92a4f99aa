from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curbsight import schemas
from curbsight.functions import air, common, traffic
from curbsight.functions.documents import decode_documents
from curbsight.plans.jobs import whole_months
from curbsight.plans.traffic_reports import elapsed_hours


def values(spark, column_of, inputs, kind="double"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}").coalesce(1)
    return [r[0] for r in frame.select(column_of(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


def test_pm25_index_at_its_break_points(spark):
    got = values(spark, air.pm25_index, [0.0, 12.0, 12.01, 35.4, 35.5, 55.4, 55.5, 150.4, 250.0, None])
    assert got == [0, 50, 50, 100, 100, 150, 150, 200, 252, None]


def test_pm25_index_survives_absurd_values(spark):
    assert values(spark, air.pm25_index, [1e300, -1.0]) == [None, -4]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(0, 500), min_size=1, max_size=50))
def test_pm25_index_never_falls(spark, readings):
    got = values(spark, air.pm25_index, sorted(readings))
    assert got == sorted(got)


def test_pm10_index(spark):
    assert values(spark, air.pm10_index, [0.0, 54.9, 55.0, 154.0, 604.0, 605.0, 700.0, -1.0]) == [
        0, 50, 51, 100, 500, 501, 596, None,
    ]


def test_overall_index_skips_missing(spark):
    row = spark.range(1).select(air.overall_index(F.lit(None).cast("int"), F.lit(7)).alias("x")).first()
    assert row.x == 7


def test_categories(spark):
    assert values(spark, air.index_category, [50, 51, 150, 151, 200, 201], "int") == [
        "Good", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy", "Unhealthy", "Very Unhealthy",
    ]
    assert values(spark, air.report_category, [300.0, 300.5]) == ["Very Unhealthy", "Hazardous"]


def test_congestion_level(spark):
    assert values(spark, traffic.congestion_level, [25, 26, 50, 51, 70, 71], "int") == [
        "low", "moderate", "moderate", "high", "high", "severe",
    ]
    assert values(spark, traffic.congestion_ordinal, ["low", "severe", "other", None], "string") == [
        0.1, 1.0, None, None,
    ]


@pytest.mark.parametrize(
    ("speed", "vehicles", "job", "documented"),
    [
        (4.9, 61, "Critical", "critical"),
        (4.9, 60, "High", "critical"),
        (9.9, 51, "High", "high"),
        (10.0, 90, "Moderate", "high"),
        (20.0, 90, "Moderate", "moderate"),
    ],
)
def test_severity_rules_differ(spark, speed, vehicles, job, documented):
    row = spark.range(1).select(
        traffic.incident_severity(F.lit(vehicles), F.lit(speed)).alias("job"),
        traffic.documented_severity(F.lit(0.4), F.lit(speed)).alias("documented"),
    ).first()
    assert (row.job, row.documented) == (job, documented)


def test_flow_and_candidates(spark):
    row = spark.range(1).select(
        traffic.flow_band(F.lit(29), F.lit(41.0)).alias("a"),
        traffic.flow_band(F.lit(49), F.lit(41.0)).alias("b"),
        traffic.flow_band(F.lit(50), F.lit(41.0)).alias("c"),
        traffic.flow_band(F.lit(10), F.lit(15.0)).alias("d"),
        traffic.incident_candidate(F.lit(61), F.lit(7.9)).alias("e"),
        traffic.incident_candidate(F.lit(60), F.lit(7.9)).alias("f"),
    ).first()
    assert tuple(row) == ("Excellent", "Good", "Fair", "Poor", True, False)


def test_night_wraps_around_midnight(spark):
    assert values(spark, traffic.rush_period, [21, 22, 0, 5, 6, 7, 9, 10, 17, 19], "int") == [
        "Off-Peak", "Night", "Night", "Night", "Off-Peak", "Morning Rush", "Morning Rush", "Off-Peak",
        "Evening Rush", "Evening Rush",
    ]


def test_sunday_is_day_zero(spark):
    row = spark.sql("SELECT date '2024-01-07' AS a, date '2024-01-13' AS b").select(
        common.day_of_week("a"), common.day_of_week("b")
    ).first()
    assert tuple(row) == (0, 6)


def test_elapsed_hours_do_not_wrap(spark):
    now = dt.datetime(2024, 1, 30, 23, 59, 59)
    frame = spark.sql("SELECT timestamp '2024-01-30 00:00:00' AS a, timestamp '2024-01-31 12:00:00' AS b")
    row = frame.select(elapsed_hours(F.col("a"), now), elapsed_hours(F.col("b"), now)).first()
    assert tuple(row) == (24, 1)


def test_months():
    assert common.months_back(dt.date(2024, 2, 29), 3) == dt.date(2023, 11, 1)
    assert common.week_start(dt.date(2024, 1, 30)) == dt.date(2024, 1, 29)
    days = whole_months([dt.date(2024, 2, 5), dt.date(2024, 2, 6), None])
    assert len(days) == 30 and dt.date(2024, 2, 29) in days and None in days


def test_partition_bounds(spark):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 9), dt.date(2024, 1, 10), dt.date(2024, 2, 1)]
    table = spark.createDataFrame([(d, d.year, d.month, d.day) for d in days], "date date, year int, month int, day int")
    kept = common.on_or_after(table, "date", dt.date(2024, 1, 10))
    assert {r.date for r in kept.collect()} == set(days[2:])
    assert table.filter(common.days_predicate(days[:2])).count() == 2
    assert table.filter(common.days_predicate([])).count() == 0
    assert {r.date for r in common.on_day(table, "date", days[1]).collect()} == {days[1]}


def test_moment_is_read_in_the_session_zone(spark):
    row = spark.range(1).select(
        common.moment(dt.datetime(2024, 1, 1, 5, 0)).cast("string").alias("s")
    ).first()
    assert row.s == "2024-01-01 05:00:00"


def test_rounding_absorbs_addition_noise(spark):
    assert values(spark, lambda c: common.rounded(c, 2), [34.495, 34.494999999999997, 34.49499]) == [34.5, 34.5, 34.49]


def test_distinct_hours(spark):
    frame = spark.createDataFrame([(0,), (23,), (23,), (None,)], "h int")
    assert frame.agg(common.distinct_hours(F.col("h"))).first()[0] == 2
    assert frame.filter("h is null").agg(common.distinct_hours(F.col("h"))).first()[0] == 0


def test_typed_documents(spark):
    target = schemas.struct(
        ("s", schemas.TEXT), ("i", schemas.WHOLE), ("big", schemas.BIG), ("d", schemas.REAL), ("b", schemas.FLAG),
        ("nothing", schemas.TEXT), ("absent", schemas.TEXT),
    )
    text = (
        '{"s":{"S":"x"},"i":{"N":"3.0"},"big":{"N":"9007199254740993"},"d":{"N":"not a number"},'
        '"b":{"BOOL":false},"nothing":{"NULL":true},"unknown":{"Q":1}}'
    )
    frame = spark.createDataFrame([(text,), (None,)], "doc string")
    first, second = decode_documents(frame, {"doc": target}).collect()
    assert tuple(first.doc) == ("x", 3, 9007199254740993, None, False, None, None)
    assert second.doc is None

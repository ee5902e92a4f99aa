from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from curbsight.operators import air_gold, traffic_gold
from curbsight.plans import air_reports, documented, jobs, traffic_reports
from tests.rows import AT, air, minutes, traffic


def test_single_reading_has_no_deviation(spark):
    row = air_gold.hourly_by_zone(air(spark)).first()
    assert row.stddev_pm25 is None and row.reading_count == 1 and row.active_sensor_count == 1


def test_unhealthy_limit_is_exclusive(spark):
    row = air_gold.hourly_by_zone(air(spark, {"pm25": 35.4}, {"pm25": 35.5}, {"pm25": None})).first()
    assert row.unhealthy_reading_count == 1


def test_peak_hour_of_equals_is_the_later(spark):
    rows = air(spark, {"pm25": 30.0}, {"pm25": 30.0, "reading_datetime": minutes(180)},
               {"pm25": 29.0, "reading_datetime": minutes(300)})
    row = air_gold.daily_by_zone(air_gold.sensor_hours(rows)).first()
    assert row.peak_pollution_hour == 11 and row.total_readings == 3 and row.unique_sensors == 1


def test_daily_means_skip_missing_values(spark):
    rows = air(spark, {"pm25": 10.0}, {"pm25": None}, {"pm25": 20.0, "reading_datetime": minutes(60)})
    row = air_gold.daily_by_zone(air_gold.sensor_hours(rows)).first()
    assert (row.daily_avg_pm25, row.total_readings) == (15.0, 3)


def test_health_takes_the_latest_reading(spark):
    rows = air(
        spark,
        {"reading_datetime": minutes(30), "battery_level": 15, "device_status": "active", "firmware_version": "b"},
        {"reading_datetime": AT, "battery_level": 90, "device_status": "maintenance", "firmware_version": "a"},
        {"reading_datetime": minutes(90), "battery_level": 60, "device_status": "active", "firmware_version": "c"},
    )
    row = air_gold.sensor_health(air_gold.sensor_hours(rows)).first()
    assert (row.latest_battery_level, row.latest_status, row.firmware_version) == (60, "active", "c")
    assert (row.health_status, row.active_hours, str(row.uptime_percent)) == ("Healthy", 2, "8.33")
    assert (row.min_battery_level, row.readings_count, row.avg_battery_level) == (15, 3, 55.0)


def test_rollup_and_readings_give_the_same_table(spark):
    rows = air(spark, *({"pm25": float(i), "reading_datetime": minutes(7 * i), "sensor_id": f"s{i % 3}"} for i in range(40)))
    a = air_gold.daily_by_sensor(air_gold.reading_parts(rows))
    b = air_gold.daily_by_sensor(air_gold.sensor_hours(rows))
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())


def test_category_list_is_the_full_list(spark):
    rows = air(spark, {"aqi_category": "Moderate"}, {}, {}, {"aqi_category": None})
    row = air_gold.category_list(air_gold.aqi_trends(rows)).first()
    assert row.aqi_category_list == ["Good", "Good", "Moderate"]
    assert (row.aqi_category_count, row.reading_count) == (2, 4)


def level(name, n):
    return [{"congestion_level": name}] * n


def test_dominant_level(spark):
    def dominant(*changes):
        return traffic_gold.hourly_by_intersection(traffic(spark, *changes)).first()

    assert dominant(*level("high", 2), *level("moderate", 2)).dominant_congestion_level == "moderate"
    assert dominant(*level("high", 3), *level("moderate", 2)).dominant_congestion_level == "high"
    assert dominant(*level("severe", 1), *level("low", 9)).dominant_congestion_level == "severe"
    row = dominant(*level("severe", 1), *level("high", 1), *level("low", 1))
    assert row.congestion_score == 60.0
    assert row.severe_congestion_count + row.high_congestion_count + row.low_congestion_count == row.reading_count


def test_daily_traffic_counts(spark):
    rows = traffic(
        spark, {}, {"sensor_id": "TR_2", "congestion_level": "high", "reading_datetime": minutes(61)},
        {"intersection": "Other", "incident_detected": True, "vehicle_count": None},
    )
    row = traffic_gold.daily_by_road_type(traffic_gold.sensor_hours(rows)).first()
    assert (row.unique_sensors, row.unique_intersections, row.active_hours) == (2, 2, 2)
    assert (row.total_vehicles, row.daily_avg_vehicles, row.total_incidents) == (40, 20.0, 1)
    assert (row.congestion_percentage, row.coverage_score) == (33.33, 8.33)


def test_windows_are_aligned(spark):
    row = traffic_gold.congestion_trends(traffic(spark, {"reading_datetime": minutes(14.9)})).select(
        F.col("time_window_start").cast("string").alias("a"), F.col("time_window_end").cast("string").alias("b"),
        "congestion_trend",
    ).first()
    assert tuple(row) == ("2024-01-10 08:00:00", "2024-01-10 08:15:00", "Improving")


def test_zero_vehicles_give_no_rate(spark):
    days = spark.sql(
        "SELECT date '2024-01-10' AS date, 'c' AS city, 'local' AS road_type, 0L AS total_vehicles, "
        "1D AS daily_avg_speed, 3L AS total_incidents, 0L AS unique_intersections"
    )
    row = traffic_reports.daily_by_city(days, dt.date(2024, 1, 10)).first()
    assert row.incidents_per_1000_vehicles is None and row.avg_vehicles_per_intersection is None


def test_incidents_are_not_multiplied_by_the_baseline(spark):
    rows = traffic(
        spark,
        *({"incident_detected": True, "avg_speed_mph": 4.0, "vehicle_count": 80} for _ in range(10)),
        *({"reading_datetime": minutes(60 * h), "avg_speed_mph": 40.0} for h in range(1, 5)),
    )
    row = traffic_reports.dangerous_intersections(
        traffic_gold.incidents(rows), traffic_gold.hourly_by_intersection(rows), dt.date(2024, 1, 10)
    ).first()
    assert (row.total_incidents, row.critical_incidents, row.days_with_incidents) == (10, 10, 1)
    assert (row.normal_avg_speed, row.speed_reduction_during_incidents) == (32.8, 28.8)


def zone_days(spark, *rows):
    return spark.createDataFrame(
        [(dt.date(2024, 1, d), "c", "z", aqi, float(aqi)) for d, aqi in rows],
        "date date, city string, zone string, daily_max_aqi int, daily_avg_aqi double",
    )


def test_previous_day_must_be_the_day_before(spark):
    rows = documented.aqi_change(zone_days(spark, (1, 50), (2, 80), (4, 60))).orderBy("date").collect()
    assert [(r.previous_day_aqi, r.aqi_change, r.aqi_trend) for r in rows] == [
        (None, None, None), (50, 30, "worsening"), (None, None, None),
    ]


def test_streaks_end_at_gaps_and_good_days(spark):
    rows = documented.unhealthy_streaks(zone_days(spark, (1, 150), (2, 150), (3, 90), (4, 150), (6, 150), (7, 150)))
    assert [r.consecutive_unhealthy_days for r in rows.orderBy("date").collect()] == [1, 2, 1, 1, 2]


def test_alerts_say_why(spark):
    rows = documented.aqi_alerts(zone_days(spark, (1, 60), (2, 160), (3, 100))).orderBy("date").collect()
    assert [(r.alert_triggered, r.alert_reason) for r in rows] == [
        (False, None), (True, "max AQI above 150; AQI up by 50 or more in a day"), (False, None),
    ]


def test_missing_days_need_no_cross_join(spark):
    rows = air(spark, {"reading_datetime": AT}, {"reading_datetime": minutes(-24 * 60)})
    days = air_gold.daily_by_sensor(air_gold.reading_parts(rows))
    health = air_gold.sensor_health(air_gold.sensor_hours(rows))
    missing = air_reports.missing_sensor_days(days, health, AT.date())
    assert [r.expected_date.day for r in missing.collect()] == [8, 7, 6, 5, 4, 3]


# --- tables from the stored rollup ------------------------------------------------------------


def rounded_rows(frame, columns):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r) for r in frame.select(*columns).collect()), key=repr)


def mixed_air(spark):
    draw = random.Random(4)
    return air(spark, *({
        "pm25": draw.choice([None, 0.1, 35.4, 35.5, draw.uniform(0, 400)]), "reading_datetime": minutes(11 * i),
        "sensor_id": f"s{draw.randint(0, 4)}", "zone": draw.choice(["a", "b", None]), "aqi_value": draw.choice([None, 40, 101, 180]),
        "aqi_category": draw.choice(["Good", None, "Moderate"]), "co2": draw.choice([None, 400.5]), "firmware_version": draw.choice("xy"),
        "battery_level": draw.randint(0, 99)} for i in range(150)), {"reading_datetime": None})


def mixed_traffic(spark):
    draw = random.Random(5)
    return traffic(spark, *({
        "event_id": str(i), "vehicle_count": draw.choice([None, 5, 40, 90]), "reading_datetime": minutes(4 * i),
        "sensor_id": f"s{draw.randint(0, 3)}", "intersection": draw.choice(["a", "b", None]), "road_type": draw.choice(["local", "major"]),
        "congestion_level": draw.choice(["low", "moderate", "high", "severe", None, "odd"]), "bike_count": draw.choice([None, 3]),
        "avg_speed_mph": draw.choice([None, 3.5, 40.25]), "incident_detected": draw.random() < 0.2} for i in range(150)))


def test_air_tables_from_the_rollup_are_those_from_readings(spark):
    rows = mixed_air(spark)
    hours = air_gold.sensor_hours(rows)
    for direct, merged in ((air_gold.hourly_by_zone(rows), air_gold.zone_hours(hours)),
                           (air_gold.aqi_trends(rows), air_gold.category_hours(hours))):
        assert {(f.name, f.dataType) for f in direct.schema} == {(f.name, f.dataType) for f in merged.schema}
        assert rounded_rows(direct, direct.columns) == rounded_rows(merged, direct.columns)


def test_traffic_tables_from_the_rollup_are_those_from_readings(spark):
    rows = mixed_traffic(spark)
    quarters = traffic_gold.sensor_quarters(rows)
    pairs = (
        (traffic_gold.hourly_by_intersection(rows), traffic_gold.intersection_hours(quarters)),
        (traffic_gold.daily_by_road_type(traffic_gold.sensor_hours(rows)), traffic_gold.road_days(quarters)),
        (traffic_gold.congestion_trends(rows), traffic_gold.trend_quarters(quarters)),
        (traffic_gold.quarter_hours_by_intersection(rows), traffic_gold.intersection_quarters(quarters)),
        (documented.hourly_congestion(rows), traffic_gold.congestion_hours(quarters)),
    )
    for direct, merged in pairs:
        assert {(f.name, f.dataType) for f in direct.schema} <= {(f.name, f.dataType) for f in merged.schema}
        assert rounded_rows(direct, direct.columns) == rounded_rows(merged, direct.columns)


def test_merged_deviations_keep_their_digits(spark):
    """Readings that are nearly alike and far from zero: a difference of summed squares would be noise."""
    rows = air(spark, *({"pm25": 450.0 + 1e-7 * (i % 2), "sensor_id": f"s{i % 7}", "firmware_version": str(i % 3)} for i in range(84)))
    merged = air_gold.zone_hours(air_gold.sensor_hours(rows)).first().stddev_pm25
    assert abs(merged - air_gold.hourly_by_zone(rows).first().stddev_pm25) < 1e-13
    same = air(spark, *({"pm25": 0.1, "sensor_id": f"s{i % 7}"} for i in range(30)))
    assert air_gold.zone_hours(air_gold.sensor_hours(same)).first().stddev_pm25 < 1e-15
    assert air_gold.zone_hours(air_gold.sensor_hours(air(spark))).first().stddev_pm25 is None


def test_silver_is_read_once_for_all_tables():
    """Only the list of single incidents needs silver itself, by a filter."""
    assert [t.name for t in jobs.AIR.tables if not t.from_rollup] == []
    assert [t.name for t in jobs.TRAFFIC.tables if not t.from_rollup] == ["traffic_incidents"]


def test_incidents_are_filtered_in_the_scan(spark, tmp_path):
    mixed_traffic(spark).write.parquet(str(tmp_path / "silver"))
    plan = traffic_gold.incidents(spark.read.parquet(str(tmp_path / "silver")))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(incident_detected,true)" in plan and "Exchange" not in plan


def test_merging_deviations_is_one_shuffle(spark, tmp_path):
    air_gold.sensor_hours(mixed_air(spark)).write.parquet(str(tmp_path / "hours"))
    plan = air_gold.zone_hours(spark.read.parquet(str(tmp_path / "hours")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_sequences_carried_over_periods_are_those_of_one_pass(spark):
    draw = random.Random(6)
    days = spark.createDataFrame(
        [(dt.date(2024, 1, 1) + dt.timedelta(days=d), "c", zone, draw.choice([None, 90, 150, 170, 180]), 0.0)
         for zone in ("a", "b", None) for d in range(80) if draw.random() < 0.9],
        "date date, city string, zone string, daily_max_aqi int, daily_avg_aqi double")
    nothing = spark.createDataFrame([], documented.SEQUENCE_STATE)
    whole = sorted(documented.zone_sequences(days, nothing, above=100).collect(), key=repr)
    for cuts in ((31, 60), (1, 2, 3, 40, 79)):
        edges = [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in (0, *cuts, 200)]
        state, found = nothing, []
        for first, end in zip(edges, edges[1:]):
            rows = documented.zone_sequences(days.filter((F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(end))), state, above=100)
            state = spark.createDataFrame(documented.closing_state(rows, state).collect(), documented.SEQUENCE_STATE)
            found += rows.collect()
            assert state.count() <= 3
        assert sorted(found, key=repr) == whole
    streaks = {(r.date, r.zone): r.consecutive_unhealthy_days for r in documented.unhealthy_streaks(days, above=100).collect()}
    assert {(r.date, r.zone): r.consecutive_unhealthy_days for r in whole if r.consecutive_unhealthy_days} == streaks
    changes = {(r.date, r.zone): r.aqi_change for r in documented.aqi_change(days).collect()}
    assert {(r.date, r.zone): r.aqi_change for r in whole} == changes

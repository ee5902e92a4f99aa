"""Saved traffic reports. Each takes gold frames and a reference time, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbsight.functions import traffic as classify
from curbsight.functions.common import (
    day_of_week,
    grade,
    moment,
    months_back,
    on_day,
    on_or_after,
    rounded,
)

DAY = dt.timedelta(days=1)

# Sunday first.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def day_name(number: Column) -> Column:
    return F.element_at(F.array(*(F.lit(n) for n in DAY_NAMES)), number + 1)


def congestion_hotspots(
    quarter_hours: DataFrame, as_of: dt.datetime, *, hours: int = 24, more_than: int = 10, top: int = 10
) -> DataFrame:
    """Intersections with many highly congested quarter hours."""
    recent = on_or_after(quarter_hours, "time_window_start", as_of - dt.timedelta(hours=hours))
    rows = recent.filter("congestion_level = 'high'").groupBy("intersection", "city").agg(
        F.count(F.lit(1)).alias("high_congestion_periods"),
        F.avg("avg_speed_mph").alias("avg_speed"),
        F.max("vehicle_count").alias("peak_vehicle_count"),
        F.min("avg_speed_mph").alias("slowest_speed"),
        rounded(F.avg("vehicle_count"), 0).alias("avg_vehicle_count"),
    )
    return (
        rows.filter(F.col("high_congestion_periods") > more_than)
        .orderBy(F.col("high_congestion_periods").desc(), "avg_speed", "intersection")
        .limit(top)
    )


def elapsed_hours(start: Column, now: dt.datetime) -> Column:
    """Whole hours from ``start`` to one hour past ``now``; at least one, and not wrapped at a day."""
    seconds = F.unix_seconds(moment(now)) - F.unix_seconds(start) + F.lit(3600)
    return F.greatest(F.floor(seconds / 3600), F.lit(1))


def today_by_intersection(hourly: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The hours of one day per intersection, with volume per elapsed hour."""
    rate = F.col("total_vehicles").cast("double") / elapsed_hours(F.col("hour_timestamp"), as_of)
    return (
        on_day(hourly, "hour_timestamp", as_of.date())
        .select(
            "hour_timestamp", "intersection", "city", "total_vehicles", "avg_speed_mph",
            F.col("incidents_detected").alias("incident_count"),
            classify.speed_status(F.col("avg_speed_mph")).alias("traffic_status"),
            rounded(rate, 0).alias("vehicles_per_hour"),
        )
        .orderBy(F.col("hour_timestamp").desc(), F.col("total_vehicles").desc(), "intersection")
    )


def daily_by_city(days: DataFrame, as_of: dt.date, back: int = 7) -> DataFrame:
    """Volume, speed and incident rate per day, city and road type."""
    volume = F.col("total_vehicles").cast("double")
    return (
        on_or_after(days, "date", as_of - back * DAY)
        .select(
            "date", "city", "road_type", "total_vehicles", "daily_avg_speed", "total_incidents",
            "unique_intersections",
            rounded(F.try_divide(volume, F.col("unique_intersections")), 0).alias("avg_vehicles_per_intersection"),
            rounded(F.try_divide(F.col("total_incidents") * 1000.0, volume), 2).alias("incidents_per_1000_vehicles"),
        )
        .orderBy(F.col("date").desc(), F.col("total_vehicles").desc(), "city", "road_type")
    )


def rush_hours(hourly: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Weekday profile by hour of the day."""
    recent = on_or_after(hourly, "hour_timestamp", as_of - days * DAY)
    stamped = recent.select(
        F.hour("hour_timestamp").alias("hour_of_day"),
        day_of_week("hour_timestamp").alias("weekday"),
        "total_vehicles", "avg_speed_mph", "intersection",
    ).filter(F.col("weekday").between(1, 5))
    rows = stamped.groupBy("hour_of_day", "weekday").agg(
        rounded(F.avg("total_vehicles"), 0).alias("avg_vehicles"),
        rounded(F.avg("avg_speed_mph"), 2).alias("avg_speed_mph"),
        F.count_distinct("intersection").alias("active_intersections"),
    )
    return rows.orderBy("weekday", "hour_of_day").select(
        "hour_of_day",
        day_name(F.col("weekday")).alias("day_name"),
        "avg_vehicles", "avg_speed_mph", "active_intersections",
        classify.rush_period(F.col("hour_of_day")).alias("time_period"),
    )


def incident_profile(incidents: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Incidents per day, intersection, congestion level and severity."""
    recent = on_or_after(incidents, "incident_datetime", dt.datetime.combine(as_of - days * DAY, dt.time()))
    rows = (
        recent.filter(F.col("congestion_level").isNotNull())
        .groupBy(
            F.to_date("incident_datetime").alias("date"), "intersection", "congestion_level", "incident_severity"
        )
        .agg(
            F.count(F.lit(1)).alias("incident_count"),
            F.avg("vehicle_count").alias("avg_vehicles_during_incident"),
            F.avg("avg_speed_mph").alias("avg_speed_during_incident"),
            F.min("avg_speed_mph").alias("min_speed_observed"),
            rounded(F.avg(F.hour("incident_datetime")), 1).alias("avg_hour_of_occurrence"),
        )
    )
    return rows.orderBy(
        F.col("date").desc(), F.col("incident_count").desc(), "intersection", "congestion_level", "incident_severity"
    )


def congested_quarter_hours(quarter_hours: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """Highly and severely congested windows per hour and intersection."""
    recent = on_or_after(quarter_hours, "time_window_start", as_of - days * DAY)
    rows = recent.groupBy(
        F.to_date("time_window_start").alias("date"),
        F.hour("time_window_start").alias("hour"),
        "intersection", "city", "congestion_level",
    ).agg(
        F.count(F.lit(1)).alias("interval_count"),
        F.avg("avg_speed_mph").alias("avg_speed"),
        F.avg("vehicle_count").alias("avg_vehicles"),
        F.min("avg_speed_mph").alias("min_speed"),
        F.max("vehicle_count").alias("max_vehicles"),
    )
    return rows.filter(F.col("congestion_level").isin("high", "severe")).orderBy(
        F.col("date").desc(), "hour", F.col("interval_count").desc(), "intersection", "congestion_level"
    )


def weekday_against_weekend(days: DataFrame, as_of: dt.date, back: int = 30) -> DataFrame:
    """Mean weekday and weekend traffic side by side, per city and road type."""
    kinds = {"Weekday": "weekday", "Weekend": "weekend"}
    weekend = day_of_week("date").isin(0, 6)
    recent = on_or_after(days, "date", as_of - back * DAY)
    wide = (
        recent.withColumn("day_type", F.when(weekend, "Weekend").otherwise("Weekday"))
        .groupBy("city", "road_type")
        .pivot("day_type", list(kinds))
        .agg(F.avg("total_vehicles").alias("vehicles"), F.avg("daily_avg_speed").alias("speed"))
    )
    named = wide.select(
        "city", "road_type",
        *(F.col(f"{k}_vehicles").alias(f"{n}_avg_vehicles") for k, n in kinds.items()),
        *(F.col(f"{k}_speed").alias(f"{n}_avg_speed") for k, n in kinds.items()),
    )
    gain = F.col("weekday_avg_vehicles") - F.col("weekend_avg_vehicles")
    return named.withColumn(
        "weekday_increase_pct", rounded(F.try_divide(gain * 100.0, F.col("weekend_avg_vehicles")), 2)
    ).orderBy(F.col("weekday_increase_pct").desc(), "city", "road_type")


def dangerous_intersections(
    incidents: DataFrame, hourly: DataFrame, as_of: dt.date, *, days: int = 90, at_least: int = 10, top: int = 15
) -> DataFrame:
    """Intersections with the most critical incidents, with the speed usual on those days.

    Both sides are brought to one row per intersection and day before they meet, so an incident
    is counted once. The usual speed weighs each day by its incidents, as a join of single rows would.
    """
    first = as_of - days * DAY
    start = dt.datetime.combine(first, dt.time())
    key = ["intersection", "date"]
    speed = F.col("avg_speed_mph")
    per_day = (
        on_or_after(incidents, "incident_datetime", start)
        .groupBy("intersection", "city", F.to_date("incident_datetime").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("incident_severity") == "Critical").alias("critical"),
            F.count_if(F.col("incident_severity") == "High").alias("high"),
            F.sum(speed).alias("speed_sum"),
            F.count(speed).alias("speed_n"),
        )
    )
    usual = (
        on_or_after(hourly, "hour_timestamp", start)
        .groupBy("intersection", F.to_date("hour_timestamp").alias("date"))
        .agg(F.sum(speed).alias("usual_sum"), F.count(speed).alias("usual_n"))
    )
    during = F.try_divide(F.sum("speed_sum"), F.sum("speed_n"))
    normal = F.try_divide(F.sum(F.col("usual_sum") * F.col("n")), F.sum(F.col("usual_n") * F.col("n")))
    rows = (
        per_day.join(usual, key, "left")
        .groupBy("city", "intersection")
        .agg(
            F.count_distinct("date").alias("days_with_incidents"),
            F.sum("n").alias("total_incidents"),
            F.sum("critical").alias("critical_incidents"),
            F.sum("high").alias("high_severity_incidents"),
            during.alias("avg_speed_during_incidents"),
            normal.alias("normal_avg_speed"),
        )
    )
    return (
        rows.filter(F.col("total_incidents") >= at_least)
        .withColumn(
            "speed_reduction_during_incidents",
            rounded(F.col("normal_avg_speed") - F.col("avg_speed_during_incidents"), 2),
        )
        .orderBy(F.col("critical_incidents").desc(), F.col("total_incidents").desc(), "intersection")
        .limit(top)
    )


# Efficiency labels.
EFFICIENCY = ((80, "🟢 Excellent"), (60, "🟡 Good"), (40, "🟠 Fair"))
EFFICIENCY_BELOW = "🔴 Poor"


def flow_efficiency(hourly: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Speed against free flow, reduced by incidents (by half at most)."""
    recent = on_or_after(hourly, "hour_timestamp", as_of - days * DAY)
    means = recent.groupBy("intersection", "city", "road_type").agg(
        F.avg("avg_speed_mph").alias("speed"),
        F.avg("total_vehicles").alias("volume"),
        F.sum("incidents_detected").alias("total_incidents"),
    )
    penalty = F.least(F.col("total_incidents") / 100.0, F.lit(0.5))
    score = F.col("speed") / classify.expected_speed(F.col("road_type")) * (1 - penalty) * 100
    return (
        means.withColumn("efficiency_score", rounded(score, 2))
        .select(
            "intersection", "city", "road_type",
            rounded("speed", 2).alias("avg_speed_mph"),
            rounded("volume", 0).alias("avg_daily_vehicles"),
            "total_incidents", "efficiency_score",
            grade(F.col("efficiency_score"), EFFICIENCY, EFFICIENCY_BELOW).alias("performance_rating"),
        )
        .orderBy(F.col("efficiency_score").desc(), "intersection")
    )


def monthly_growth(days: DataFrame, as_of: dt.date, months: int = 6) -> DataFrame:
    """Monthly volume per city against the month listed before it."""
    recent = on_or_after(days, "date", months_back(as_of, months))
    monthly = recent.groupBy(F.trunc("date", "month").alias("month"), "city").agg(
        F.sum("total_vehicles").alias("total_vehicles"),
        rounded(F.avg("daily_avg_speed"), 2).alias("avg_speed_mph"),
    )
    # One row per city and month: the window is bounded by the calendar, not by the readings.
    in_order = Window.partitionBy("city").orderBy("month")
    before = F.col("prev_month_vehicles")
    return (
        monthly.withColumn("prev_month_vehicles", F.lag("total_vehicles").over(in_order))
        .withColumn(
            "month_over_month_growth_pct",
            rounded(F.try_divide((F.col("total_vehicles") - before) * 100.0, before), 2),
        )
        .orderBy(F.col("month").desc(), "city")
    )

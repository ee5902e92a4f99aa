"""Saved air-quality reports. Each takes gold frames and a reference time, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbsight.functions.air import report_category
from curbsight.functions.common import (
    averages,
    band,
    moment,
    months_back,
    on_day,
    on_or_after,
    over,
    percent,
    rounded,
    under,
    week_start,
)

DAY = dt.timedelta(days=1)


def weekly_trend(sensor_days: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """Mean index per day and zone over the last days, with its category."""
    recent = on_or_after(sensor_days, "date", as_of - days * DAY)
    rows = recent.groupBy("date", "zone").agg(
        *averages({"daily_avg_aqi": "avg_aqi", "daily_avg_pm25": "avg_pm25", "daily_avg_pm10": "avg_pm10"}),
        F.count_distinct("sensor_id").alias("active_sensors"),
    )
    return rows.withColumn("air_quality_category", report_category(F.col("daily_avg_aqi"))).orderBy(
        F.col("date").desc(), "zone"
    )


# Status labels of the day's dashboard.
STATUS_LIMITS = ((50, "🟢 Good"), (100, "🟡 Moderate"), (150, "🟠 USG"))
STATUS_ABOVE = "🔴 Unhealthy"


def today_by_sensor(sensor_hours: DataFrame, as_of: dt.date) -> DataFrame:
    """The hours of one day per sensor."""
    return (
        on_day(sensor_hours, "hour_timestamp", as_of)
        .select(
            "hour_timestamp", "sensor_id", "zone", "avg_aqi", "avg_pm25", "avg_pm10",
            "avg_temperature", "avg_humidity", "reading_count",
            band(F.col("avg_aqi"), STATUS_LIMITS, STATUS_ABOVE).alias("status_emoji"),
        )
        .orderBy(F.col("hour_timestamp").desc(), "sensor_id")
    )


def most_polluted_zones(
    sensor_hours: DataFrame, as_of: dt.datetime, *, hours: int = 24, above: float = 100.0, top: int = 10
) -> DataFrame:
    """Zones whose mean index over the last hours lies above a limit, worst first."""
    recent = on_or_after(sensor_hours, "hour_timestamp", as_of - dt.timedelta(hours=hours))
    rows = recent.groupBy("zone").agg(
        F.avg("avg_aqi").alias("avg_aqi_24h"),
        F.max("avg_aqi").alias("peak_aqi"),
        F.avg("avg_pm25").alias("avg_pm25_24h"),
        F.max("avg_pm25").alias("peak_pm25"),
        F.count(F.lit(1)).alias("hourly_readings"),
        F.count_distinct("sensor_id").alias("sensor_count"),
    )
    return rows.filter(F.col("avg_aqi_24h") > above).orderBy(F.col("avg_aqi_24h").desc(), "zone").limit(top)


# Uptime labels.
UPTIME_STEPS = ((90, "🔴 Critical"), (95, "🟠 Warning"), (99, "🟡 Monitor"))
UPTIME_ABOVE = "🟢 Healthy"


def devices_needing_attention(health: DataFrame, as_of: dt.date) -> DataFrame:
    """Sensors of one day with low uptime, battery or data quality, the most urgent first."""
    uptime, battery, quality = F.col("uptime_percent"), F.col("avg_battery_level"), F.col("data_quality_score")
    offline, flat, doubtful = uptime < 90, battery < 20, quality < 0.8
    rows = on_day(health, "date", as_of).filter((uptime < 99) | (battery < 30) | (quality < 0.9))
    urgency = F.coalesce(*(F.when(c, F.lit(n)) for n, c in ((1, offline), (2, flat), (3, doubtful))), F.lit(4))
    action = F.coalesce(
        F.when(flat, "Replace Battery"),
        F.when(offline, "Check Connection"),
        F.when(doubtful, "Calibrate Sensor"),
        F.lit("No Action Needed"),
    )
    return (
        rows.withColumn("urgency", urgency)
        .orderBy("urgency", "uptime_percent", "sensor_id")
        .select(
            "sensor_id", "zone", "uptime_percent", "avg_battery_level", "data_quality_score", "readings_count",
            under(uptime, UPTIME_STEPS, UPTIME_ABOVE).alias("health_status"),
            action.alias("recommended_action"),
        )
    )


def week_over_week(sensor_days: DataFrame, as_of: dt.date) -> DataFrame:
    """This calendar week against the one before, for zones seen in both."""
    monday = week_start(as_of)
    this_week = F.col("date") >= moment(monday)
    both = (
        on_or_after(sensor_days, "date", monday - 7 * DAY)
        .filter(F.col("zone").isNotNull())
        .groupBy("zone")
        .agg(
            F.avg(F.when(this_week, F.col("avg_aqi"))).alias("now_aqi"),
            F.avg(F.when(~this_week, F.col("avg_aqi"))).alias("then_aqi"),
            F.count_if(this_week).alias("now_days"),
            F.count_if(~this_week).alias("then_days"),
        )
        .filter((F.col("now_days") > 0) & (F.col("then_days") > 0))
    )
    change = F.col("now_aqi") - F.col("then_aqi")
    return (
        both.orderBy(F.abs(change).desc(), "zone")
        .select(
            "zone",
            rounded("now_aqi", 2).alias("current_week_aqi"),
            rounded("then_aqi", 2).alias("previous_week_aqi"),
            rounded(change, 2).alias("aqi_change"),
            rounded(F.try_divide(change, F.col("then_aqi")) * 100, 2).alias("percent_change"),
            F.when(change > 0, "📈 Worsening").when(change < 0, "📉 Improving").otherwise("➡️ Stable").alias("trend"),
        )
    )


def monthly_summary(days: DataFrame, as_of: dt.date, months: int = 3) -> DataFrame:
    """Good, moderate and unhealthy days per month and zone; ``days`` has date, zone, avg_aqi."""
    aqi = F.col("avg_aqi")
    good = F.count_if(aqi <= 50)
    recent = on_or_after(days, "date", months_back(as_of, months))
    rows = recent.groupBy(F.trunc("date", "month").alias("month"), "zone").agg(
        F.count_distinct("date").alias("days_monitored"),
        F.avg(aqi).alias("monthly_avg_aqi"),
        F.max(aqi).alias("worst_daily_aqi"),
        F.min(aqi).alias("best_daily_aqi"),
        good.alias("good_days"),
        F.count_if((aqi > 50) & (aqi <= 100)).alias("moderate_days"),
        F.count_if(aqi > 100).alias("unhealthy_days"),
        rounded(percent(good, F.count(F.lit(1))), 2).alias("good_days_percentage"),
    )
    return rows.orderBy(F.col("month").desc(), "zone")


def weather_and_aqi(sensor_days: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Mean temperature, humidity and index per day and zone, banded."""
    recent = on_or_after(sensor_days, "date", as_of - days * DAY)
    rows = recent.groupBy("date", "zone").agg(
        *averages({
            "avg_temp": "avg_temperature",
            "avg_humidity": "avg_humidity",
            "avg_aqi": "avg_aqi",
            "avg_pm25": "avg_pm25",
        })
    )
    return rows.withColumns({
        "temp_category": over(F.col("avg_temp"), ((30, "Hot"), (20, "Warm")), "Cool"),
        "humidity_category": over(F.col("avg_humidity"), ((70, "High"), (40, "Moderate")), "Low"),
    }).orderBy(F.col("date").desc(), "zone")


def missing_sensor_days(
    sensor_days: DataFrame, health: DataFrame, as_of: dt.date, days: int = 7
) -> DataFrame:
    """Days before ``as_of`` on which a sensor that reports today sent nothing.

    Every sensor is given its expected days by a generator; the days that exist are then taken
    away with an anti join, so neither side is multiplied with the other.
    """
    first = as_of - days * DAY
    expected = F.explode(F.sequence(F.lit(first), F.lit(as_of - DAY)))
    spine = (
        on_day(health, "date", as_of)
        .select("sensor_id", "zone")
        .distinct()
        .withColumn("expected_date", expected)
    )
    present = on_or_after(sensor_days, "date", first).select(
        "sensor_id", F.col("date").alias("expected_date")
    )
    return (
        spine.join(present, ["sensor_id", "expected_date"], "left_anti")
        .select("expected_date", "sensor_id", "zone", F.lit("❌ Missing").alias("data_status"))
        .orderBy(F.col("expected_date").desc(), "sensor_id")
    )


def worst_hours(zone_hours: DataFrame, as_of: dt.datetime, *, hours: int = 24, top: int = 10) -> DataFrame:
    """The hours with the highest mean PM2.5."""
    recent = on_or_after(zone_hours, "hour_timestamp", as_of - dt.timedelta(hours=hours))
    return (
        recent.select("city", "zone", "hour_timestamp", "avg_pm25", "max_aqi")
        .orderBy(F.col("avg_pm25").desc(), "hour_timestamp", "zone")
        .limit(top)
    )

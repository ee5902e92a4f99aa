"""Metrics and queries the data dictionary describes but no job computes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbsight.functions import traffic as classify
from curbsight.functions.air import index_category
from curbsight.functions.common import calendar, on_or_after, percent, rounded
from curbsight.operators.quality import air_rules, all_hold, holds
from curbsight.operators.traffic_gold import WINDOW_MINUTES

READING = "reading_datetime"

# Ours, because the dictionary names the columns without a rule.
ALERT_AQI = 150
ALERT_RISE = 50
UNHEALTHY_DAY_AQI = 100
CONGESTED_SHARE = 0.7
EXPECTED_READINGS_PER_DAY = 288


def direction(change: Column, up: str, down: str) -> Column:
    """Name of the sign of a change; NULL without one."""
    return F.when(change > 0, up).when(change < 0, down).when(change == 0, "stable")


# --- air ------------------------------------------------------------------------------------


def aqi_change(zone_days: DataFrame) -> DataFrame:
    """Daily index against the calendar day before; NULL where that day has no row.

    The window holds one row per zone and day, so it is bounded by the calendar.
    """
    by_day = Window.partitionBy("city", "zone").orderBy("date")
    consecutive = F.lag("date").over(by_day) == F.date_sub("date", 1)
    change = F.col("daily_max_aqi") - F.col("previous_day_aqi")
    return (
        zone_days.select("date", "city", "zone", "daily_max_aqi", "daily_avg_aqi")
        .withColumn("aqi_category", index_category(F.col("daily_max_aqi")))
        .withColumn("previous_day_aqi", F.when(consecutive, F.lag("daily_max_aqi").over(by_day)))
        .withColumn("aqi_change", change)
        .withColumn("aqi_trend", direction(F.col("aqi_change"), "worsening", "improving"))
    )


def aqi_alerts(zone_days: DataFrame, *, limit: int = ALERT_AQI, rise: int = ALERT_RISE) -> DataFrame:
    """Alert flag and reason per zone and day."""
    high = F.col("daily_max_aqi") > limit
    jump = F.coalesce(F.col("aqi_change") >= rise, F.lit(False))
    reason = F.concat_ws(
        "; ", F.when(high, f"max AQI above {limit}"), F.when(jump, f"AQI up by {rise} or more in a day")
    )
    return aqi_change(zone_days).select(
        "date", "city", "zone", "daily_max_aqi", "aqi_change",
        (high | jump).alias("alert_triggered"),
        F.nullif(reason, F.lit("")).alias("alert_reason"),
    )


def unhealthy_streaks(zone_days: DataFrame, *, above: int = UNHEALTHY_DAY_AQI) -> DataFrame:
    """Length of the run of unhealthy days each day belongs to, counted up to that day.

    Days of one run share the difference between their date and their rank.
    """
    by_day = Window.partitionBy("city", "zone").orderBy("date")
    bad = zone_days.filter(F.col("daily_max_aqi") > above).select("date", "city", "zone", "daily_max_aqi")
    runs = bad.withColumn("run", F.date_sub("date", F.row_number().over(by_day)))
    within = Window.partitionBy("city", "zone", "run").orderBy("date")
    return runs.withColumn("consecutive_unhealthy_days", F.row_number().over(within)).drop("run")


SEQUENCE_STATE = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("city", T.StringType()), T.StructField("zone", T.StringType()),
    T.StructField("daily_max_aqi", T.IntegerType()), T.StructField("consecutive_unhealthy_days", T.IntegerType()),
])


def zone_sequences(zone_days: DataFrame, before: DataFrame, *, above: int = UNHEALTHY_DAY_AQI) -> DataFrame:
    """Previous day, change and streak of unhealthy days for the days of a period, carried on from ``before``.

    ``before`` has a row per zone at most: its last day ahead of the period with the streak it had reached (0 on a healthy
    day, see ``closing_state``). So a new period reads one row per zone of all that went before, and periods chained like
    this give what a single pass over all days gives.
    """
    by_day = Window.partitionBy("city", "zone").orderBy("date")
    days = zone_days.select("date", "city", "zone", F.col("daily_max_aqi").cast("int").alias("daily_max_aqi"))
    joined = days.withColumn("reached", F.lit(None).cast("int")).unionByName(
        before.select("date", "city", "zone", "daily_max_aqi", F.col("consecutive_unhealthy_days").alias("reached")))
    follows = F.lag("date").over(by_day) == F.date_sub("date", 1)
    bad = F.when(F.col("reached").isNull(), F.col("daily_max_aqi") > above).otherwise(F.col("reached") > 0)
    marked = joined.withColumns({
        "previous_day_aqi": F.when(follows, F.lag("daily_max_aqi").over(by_day)),
        "bad": F.coalesce(bad, F.lit(False)),
    })
    # A run begins where the day before is missing or healthy; the rank within it counts its days.
    starts = marked.withColumn(
        "starts", F.coalesce(~(follows & F.lag("bad").over(by_day)), F.lit(True)).cast("int"))
    runs = starts.withColumn("run", F.sum("starts").over(by_day.rowsBetween(Window.unboundedPreceding, 0)))
    within = Window.partitionBy("city", "zone", "run").orderBy("date")
    carried = F.coalesce(F.first("reached").over(within) - 1, F.lit(0))
    return runs.select(
        "date", "city", "zone", "daily_max_aqi", "previous_day_aqi",
        (F.col("daily_max_aqi") - F.col("previous_day_aqi")).alias("aqi_change"),
        F.when(F.col("bad"), F.row_number().over(within) + carried).otherwise(0).cast("int").alias("consecutive_unhealthy_days"),
        "reached",
    ).where("reached is null").drop("reached")


def closing_state(sequences: DataFrame, before: DataFrame) -> DataFrame:
    """The last day of each zone with its streak: all that the next period needs."""
    names = SEQUENCE_STATE.names
    rows = sequences.select(*names).unionByName(before.select(*names))
    last = rows.groupBy("city", "zone").agg(F.max(F.struct("date", "daily_max_aqi", "consecutive_unhealthy_days")).alias("last"))
    return last.select("city", "zone", "last.*").select(*names)


def good_air_share(zone_hours: DataFrame) -> DataFrame:
    """Share of hours with good air and true hours above 100, from the hourly table."""
    aqi = F.col("avg_aqi")
    good = F.count_if(aqi <= 50)
    return zone_hours.groupBy(F.to_date("hour_timestamp").alias("date"), "city", "zone").agg(
        F.count(F.lit(1)).alias("hours_observed"),
        F.count_if(aqi > 100).alias("unhealthy_hours"),
        percent(good, F.count(F.lit(1))).alias("good_air_quality_percentage"),
    )


def quality_scores(candidates: DataFrame) -> DataFrame:
    """Share of readings per sensor and day that pass the silver rules."""
    ok = holds(all_hold(air_rules()))
    return (
        candidates.filter(F.col("sensor_id").isNotNull())
        .groupBy(F.to_date(READING).alias("date"), "sensor_id")
        .agg(
            F.avg(ok.cast("double")).alias("data_quality_score"),
            F.max("calibration_date").alias("last_calibration_date"),
        )
    )


def quality_days(candidates: DataFrame) -> DataFrame:
    """``quality_scores`` as a table by day."""
    return quality_scores(candidates).withColumns(calendar("date"))


def with_quality(health: DataFrame, candidates: DataFrame) -> DataFrame:
    """Attach quality scores; both sides hold one row per sensor and day."""
    return health.join(quality_scores(candidates), ["date", "sensor_id"], "left")


def documented_sensor_health(
    health: DataFrame, candidates: DataFrame, *, expected: int = EXPECTED_READINGS_PER_DAY
) -> DataFrame:
    """Uptime by expected readings, battery status, data quality and days since calibration."""
    battery = F.col("avg_battery_level")
    return with_quality(health, candidates).select(
        "date", "sensor_id", "zone",
        F.col("latest_status").alias("device_status"),
        F.col("readings_count").alias("total_readings"),
        F.lit(expected).cast("bigint").alias("expected_readings"),
        percent(F.col("readings_count"), F.lit(expected)).alias("uptime_percent"),
        battery.alias("avg_battery_percent"),
        F.col("min_battery_level").alias("min_battery_percent"),
        F.when(battery < 20, "critical").when(battery < 50, "low").otherwise("healthy").alias("battery_status"),
        "firmware_version",
        "last_calibration_date",
        F.date_diff("date", "last_calibration_date").alias("days_since_calibration"),
        "data_quality_score",
    )


# --- traffic --------------------------------------------------------------------------------


def with_ordinal(silver: DataFrame) -> DataFrame:
    return silver.withColumn("congestion", classify.congestion_ordinal(F.col("congestion_level")))


def hourly_congestion(silver: DataFrame) -> DataFrame:
    """Mean and highest congestion per hour and intersection, on the 0-1 scale."""
    return (
        with_ordinal(silver)
        .groupBy(F.date_trunc("hour", READING).alias("hour_timestamp"), "intersection", "city", "road_type")
        .agg(
            F.avg("congestion").alias("hourly_avg_congestion"),
            F.max("congestion").alias("hourly_max_congestion"),
            F.count_if("incident_detected").alias("hourly_incidents"),
        )
    )


def daily_congestion(silver: DataFrame, *, above: float = CONGESTED_SHARE) -> DataFrame:
    """Mean and highest congestion per day, and the hours spent above a share."""
    hourly = (
        with_ordinal(silver)
        .groupBy(F.to_date(READING).alias("date"), F.hour(READING).alias("hour"), "city", "road_type")
        .agg(
            F.sum("congestion").alias("c_sum"),
            F.count("congestion").alias("c_n"),
            F.max("congestion").alias("c_max"),
        )
    )
    hour_mean = F.try_divide(F.col("c_sum"), F.col("c_n"))
    hours = F.count_if(hour_mean > above)
    return hourly.groupBy("date", "city", "road_type").agg(
        F.try_divide(F.sum("c_sum"), F.sum("c_n")).alias("daily_avg_congestion"),
        F.max("c_max").alias("daily_max_congestion"),
        hours.alias("congestion_hours"),
        percent(hours, F.lit(24)).alias("congestion_percentage"),
    )


def congestion_change(silver: DataFrame) -> DataFrame:
    """15-minute congestion per road type against the window right before it."""
    windows = (
        with_ordinal(silver)
        .groupBy(F.window(READING, f"{WINDOW_MINUTES} minutes").alias("span"), "city", "road_type")
        .agg(
            F.avg("congestion").alias("window_avg_congestion"),
            F.max("congestion").alias("window_max_congestion"),
            F.avg("avg_speed_mph").alias("window_avg_speed_mph"),
            F.sum("vehicle_count").alias("window_vehicle_count"),
        )
        .withColumn("time_window", F.col("span.start"))
        .drop("span")
    )
    # One row per road type and quarter hour: bounded by the calendar.
    in_order = Window.partitionBy("city", "road_type").orderBy("time_window")
    adjacent = F.lag("time_window").over(in_order) == F.col("time_window") - F.expr(
        f"INTERVAL {WINDOW_MINUTES} MINUTES"
    )
    return (
        windows.withColumn(
            "previous_window_congestion", F.when(adjacent, F.lag("window_avg_congestion").over(in_order))
        )
        # Rounded, so that the sign does not depend on the order in which doubles were added.
        .withColumn(
            "congestion_change",
            rounded(F.col("window_avg_congestion") - F.col("previous_window_congestion"), 6),
        )
        .withColumn("trend_indicator", direction(F.col("congestion_change"), "worsening", "improving"))
        .withColumn("peak_period", classify.is_peak(F.hour("time_window")))
    )


def documented_incidents(silver: DataFrame) -> DataFrame:
    """Incidents with the severity rule and score of the data dictionary."""
    rows = with_ordinal(silver).filter("incident_detected")
    return rows.withColumn(
        "severity", classify.documented_severity(F.col("congestion"), F.col("avg_speed_mph"))
    ).select(
        "event_id",
        F.col(READING).alias("incident_datetime"),
        "sensor_id", "intersection", "city", "road_type", "vehicle_count", "avg_speed_mph",
        F.col("congestion").alias("congestion_level"),
        "severity",
        classify.severity_score(F.col("severity")).alias("severity_score"),
    )


def congested_hours(
    hourly: DataFrame, as_of: dt.datetime, *, hours: int = 24, above: float = CONGESTED_SHARE
) -> DataFrame:
    """Hours of the last day with mean congestion above a share."""
    recent = on_or_after(hourly, "hour_timestamp", as_of - dt.timedelta(hours=hours))
    return (
        recent.filter(F.col("hourly_avg_congestion") > above)
        .select("hour_timestamp", "intersection", "city", "hourly_avg_congestion", "hourly_incidents")
        .orderBy(F.col("hourly_avg_congestion").desc(), "hour_timestamp", "intersection")
    )


# --- both domains ---------------------------------------------------------------------------


def air_with_traffic(
    zone_hours: DataFrame, hourly: DataFrame, as_of: dt.datetime, *, hours: int = 24
) -> DataFrame:
    """Air quality of each zone next to the traffic of its city in the same hour.

    Traffic is brought to one row per city and hour first. Joining intersections with zones
    directly would emit every pair of them.
    """
    since = as_of - dt.timedelta(hours=hours)
    city_hours = (
        on_or_after(hourly, "hour_timestamp", since)
        .groupBy("city", "hour_timestamp")
        .agg(
            F.avg("hourly_avg_congestion").alias("city_avg_congestion"),
            F.sum("hourly_incidents").alias("city_incidents"),
        )
    )
    air = on_or_after(zone_hours, "hour_timestamp", since).select("city", "hour_timestamp", "zone", "max_aqi")
    return air.join(city_hours, ["city", "hour_timestamp"])

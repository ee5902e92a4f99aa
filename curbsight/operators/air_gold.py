"""Gold tables and support rollups of the air-quality domain.

Tables are built from parts. A part holds sums, counts, squares and extremes that merge: one reading is
the finest part, ``sensor_hours`` merges them to one row per sensor, state and hour. That level has plain
number buffers and keys which a partial hash aggregate shrinks before the shuffle. Everything that
would sort or copy readings (the newest state, the hour of the peak, distinct counts) runs over the
few rows left. Stored, the rollup is all that the other tables need, so silver is read once.
``hourly_by_zone`` and ``aqi_trends`` also exist straight from readings, for reports without stored tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight.functions.common import (
    averages,
    band,
    calendar,
    day_keys,
    dealt_by_day,
    distinct_hours,
    finished_means,
    mean_parts,
    merged_deviation,
    merged_parts,
    squares,
    with_deviation,
)

READING = "reading_datetime"

# PM2.5 above which a reading counts as unhealthy, and index alert limits.
UNHEALTHY_PM25 = 35.4
ELEVATED_AQI = 100
UNHEALTHY_AQI = 150

# Hourly and daily labels by mean index.
HOURLY_STATUS = ((50, "Good"), (100, "Moderate"), (150, "Unhealthy for Sensitive Groups"))
DAILY_RATING = ((50, "Excellent"), (100, "Good"), (150, "Fair"))

HOURLY_MEANS = {
    "avg_pm25": "pm25",
    "avg_pm10": "pm10",
    "avg_co2": "co2",
    "avg_no2": "no2",
    "avg_o3": "o3",
    "avg_temperature": "temperature_celsius",
    "avg_humidity": "humidity_percent",
    "avg_pressure": "pressure_hpa",
    "avg_aqi": "aqi_value",
    "avg_battery_level": "battery_level",
}


def hour_bucket() -> Column:
    return F.date_trunc("hour", READING).alias("hour_timestamp")


def hourly_by_zone(silver: DataFrame) -> DataFrame:
    """One row per hour and zone."""
    rows = silver.groupBy(hour_bucket(), "zone", "city", "country").agg(
        *averages(HOURLY_MEANS),
        F.min("pm25").alias("min_pm25"),
        F.max("pm25").alias("max_pm25"),
        F.stddev_samp("pm25").alias("stddev_pm25"),
        F.max("aqi_value").alias("max_aqi"),
        F.count_distinct("sensor_id").alias("active_sensor_count"),
        F.count(F.lit(1)).alias("reading_count"),
        F.count_if(F.col("pm25") > UNHEALTHY_PM25).alias("unhealthy_reading_count"),
    )
    return _with_status(rows)


def _with_status(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {**calendar("hour_timestamp", hour=True), "aqi_status": band(F.col("avg_aqi"), HOURLY_STATUS, "Unhealthy")}
    )


_ZONE_HOUR = ("hour_timestamp", "zone", "city", "country")


def zone_hours(hours: DataFrame) -> DataFrame:
    """``hourly_by_zone`` from the sensor-hour rollup, in one shuffle and a sort."""
    return _zone_hours(*merged_deviation(hours, _ZONE_HOUR, "pm25"))


def stored_zone_hours(hours: DataFrame) -> DataFrame:
    """``zone_hours`` from a stored rollup, of which two columns are read once more instead of sorting all of it."""
    return with_deviation(_zone_hours(hours, F.lit(None).cast("double")), hours, _ZONE_HOUR, "pm25", "stddev_pm25")


def _zone_hours(parts: DataFrame, deviation: Column) -> DataFrame:
    rows = parts.groupBy(*_ZONE_HOUR).agg(
        *finished_means(HOURLY_MEANS),
        F.min("low_pm25").alias("min_pm25"),
        F.max("peak_pm25").alias("max_pm25"),
        deviation.alias("stddev_pm25"),
        F.max("peak_aqi").alias("max_aqi"),
        F.count_distinct("sensor_id").alias("active_sensor_count"),
        F.sum("readings").alias("reading_count"),
        F.sum("unhealthy_pm25").alias("unhealthy_reading_count"),
    )
    return _with_status(rows)


# --- sensor-hour rollup ---------------------------------------------------------------------

_MEANS = (
    "pm25", "pm10", "co2", "no2", "o3", "temperature_celsius", "humidity_percent", "pressure_hpa", "aqi_value",
    "battery_level", "signal_strength_dbm",
)
_LOWEST = {"low_pm25": "pm25", "low_temp": "temperature_celsius", "low_battery": "battery_level"}
_HIGHEST = {
    "peak_pm25": "pm25",
    "peak_aqi": "aqi_value",
    "peak_temp": "temperature_celsius",
    "last_seen": READING,
}
_TOTALS = ("readings", "elevated", "unhealthy", "unhealthy_pm25")
_STATE = ("device_status", "firmware_version", "aqi_category")


def newness() -> Column:
    """Orders readings by time and then by their event, as one number.

    A number of this kind fits the fixed buffers of a hash aggregate, which a struct or the event's text doesn't.
    Equal times are rare, so it is enough that their order is fixed: it is that of the first 60 bits of the MD5.
    """
    event = F.conv(F.substring(F.md5(F.coalesce("source_cdc_event_id", F.lit("")).cast("binary")), 1, 15), 16, 10)
    time = F.unix_micros(READING).cast("decimal(19,0)") * F.lit(1 << 60).cast("decimal(19,0)")
    return (time + event.cast("decimal(19,0)")).cast("decimal(38,0)")


def reading_parts(silver: DataFrame) -> DataFrame:
    """Every reading as a part of its own, for tables that need no rollup before them."""
    return silver.select(
        *day_keys(silver),
        hour_bucket(), "sensor_id", "zone", "city", "country", *_STATE,
        *mean_parts(_MEANS),
        *(F.col(c).alias(name) for name, c in {**_LOWEST, **_HIGHEST}.items()),
        F.col("battery_level").alias("last_battery"),
        newness().alias("newness"),
        F.lit(1).cast("bigint").alias("readings"),
        (F.col("aqi_value") > ELEVATED_AQI).cast("bigint").alias("elevated"),
        (F.col("aqi_value") > UNHEALTHY_AQI).cast("bigint").alias("unhealthy"),
        (F.col("pm25") > UNHEALTHY_PM25).cast("bigint").alias("unhealthy_pm25"),
    )


def sensor_hours(silver: DataFrame) -> DataFrame:
    """Parts merged per hour, sensor, device state and category."""
    return _sensor_hours(reading_parts(silver))


def stored_sensor_hours(silver: DataFrame) -> DataFrame:
    """``sensor_hours`` for a table by day: readings travel once, before they are parts, which are three times as wide."""
    return _sensor_hours(reading_parts(dealt_by_day(silver, READING, "sensor_id", hour_bucket())))


def _sensor_hours(parts: DataFrame) -> DataFrame:
    keys = ("hour_timestamp", "sensor_id", "zone", "city", "country", *_STATE)
    rows = parts.groupBy(*keys, *day_keys(parts)).agg(
        *merged_parts(_MEANS),
        squares("low_pm25").alias("pm25__m2"),
        *(F.min(c).alias(c) for c in _LOWEST),
        *(F.max(c).alias(c) for c in _HIGHEST),
        F.max_by("last_battery", "newness").alias("last_battery"),
        F.max("newness").alias("newness"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _TOTALS),
    )
    return rows.withColumns(calendar("hour_timestamp")).drop("_lane")


def daily_by_zone(hours: DataFrame) -> DataFrame:
    """One row per day and zone, with the hour of the highest PM2.5 (the later one of equals)."""
    rows = hours.groupBy(F.to_date("hour_timestamp").alias("date"), "zone", "city").agg(
        *finished_means({
            "daily_avg_pm25": "pm25", "daily_avg_aqi": "aqi_value", "daily_avg_temp": "temperature_celsius",
        }),
        F.min("low_pm25").alias("daily_min_pm25"),
        F.max("peak_pm25").alias("daily_max_pm25"),
        F.max("peak_aqi").alias("daily_max_aqi"),
        F.min("low_temp").alias("daily_min_temp"),
        F.max("peak_temp").alias("daily_max_temp"),
        F.sum("readings").alias("total_readings"),
        F.count_distinct("sensor_id").alias("unique_sensors"),
        F.sum("elevated").alias("moderate_plus_hours"),
        F.sum("unhealthy").alias("unhealthy_hours"),
        F.max(F.struct("peak_pm25", F.hour("hour_timestamp").alias("hour"))).alias("peak"),
    )
    return rows.withColumns({
        **calendar("date"),
        "peak_pollution_hour": F.col("peak.hour"),
        "air_quality_rating": band(F.col("daily_avg_aqi"), DAILY_RATING, "Poor"),
    }).drop("peak")


def sensor_health(hours: DataFrame) -> DataFrame:
    """One row per day and sensor: last seen status, battery, signal and hours on air.

    "Latest" is the reading with the highest time, of equal times the one its event decides; status, firmware
    and battery are those of this one reading.
    """
    newest = F.struct("newness", "last_seen", "device_status", "firmware_version", "last_battery")
    rows = hours.groupBy(F.to_date("hour_timestamp").alias("date"), "sensor_id", "zone", *day_keys(hours)).agg(
        *finished_means({"avg_battery_level": "battery_level", "avg_signal_strength": "signal_strength_dbm"}),
        F.max(newest).alias("newest"),
        F.min("low_battery").alias("min_battery_level"),
        F.sum("readings").alias("readings_count"),
        distinct_hours(F.hour("hour_timestamp")).alias("active_hours"),
    )
    critical = (F.col("latest_battery_level") < 20) | (F.col("latest_status") == "maintenance")
    warning = (F.col("latest_battery_level") < 50) | (F.col("avg_signal_strength") < -70)
    return (
        rows.withColumns({
            **calendar("date"),
            "latest_status": F.col("newest.device_status"),
            "firmware_version": F.col("newest.firmware_version"),
            "latest_battery_level": F.col("newest.last_battery"),
            "last_reading_time": F.col("newest.last_seen"),
            "uptime_percent": (F.col("active_hours") / F.lit(24.0) * 100).cast("decimal(5,2)"),
        })
        .withColumn("health_status", F.when(critical, "Critical").when(warning, "Warning").otherwise("Healthy"))
        .drop("newest", "_lane")
    )


_SENSOR_MEANS = {
    "avg_aqi": "aqi_value",
    "avg_pm25": "pm25",
    "avg_pm10": "pm10",
    "avg_temperature": "temperature_celsius",
    "avg_humidity": "humidity_percent",
}


def daily_by_sensor(parts: DataFrame) -> DataFrame:
    """One row per day and sensor, from readings or from the rollup."""
    rows = parts.groupBy(F.to_date("hour_timestamp").alias("date"), "sensor_id", "zone", *day_keys(parts)).agg(
        *finished_means(_SENSOR_MEANS), F.sum("readings").alias("reading_count")
    )
    return rows.withColumns(calendar("date")).drop("_lane")


def hourly_by_sensor(parts: DataFrame) -> DataFrame:
    """One row per hour and sensor, from readings or from the rollup."""
    rows = parts.groupBy("hour_timestamp", "sensor_id", "zone", *day_keys(parts)).agg(
        *finished_means(_SENSOR_MEANS), F.sum("readings").alias("reading_count")
    )
    return rows.withColumns(calendar("hour_timestamp")).drop("_lane")


def by_sensor(build: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """A table per sensor from the rollup, of which the rows travel once for the aggregate and the folders by day."""
    return lambda hours: build(dealt_by_day(hours, "hour_timestamp", "sensor_id"))


# --- categories -----------------------------------------------------------------------------


def aqi_trends(silver: DataFrame) -> DataFrame:
    """Categories seen per hour and zone.

    The list of categories, one entry per reading, has no order, so it is stored as one
    (category, count) pair per distinct value. That says the same in a row of bounded size;
    ``category_list`` writes it out.
    """
    parts = silver.select(
        F.to_date(READING).alias("date"), F.hour(READING).alias("hour"), "zone", "aqi_category",
        *mean_parts(["aqi_value"]),
    )
    return _category_rows(parts.withColumn("readings", F.lit(1)))


def category_hours(hours: DataFrame) -> DataFrame:
    """``aqi_trends`` from the sensor-hour rollup."""
    return _category_rows(hours.select(
        F.to_date("hour_timestamp").alias("date"), F.hour("hour_timestamp").alias("hour"), "zone", "aqi_category",
        "aqi_value__sum", "aqi_value__n", "readings",
    ))


def _category_rows(parts: DataFrame) -> DataFrame:
    per_category = parts.groupBy("date", "hour", "zone", "aqi_category").agg(
        *merged_parts(["aqi_value"]), F.sum("readings").alias("readings")
    )
    pair = F.when(
        F.col("aqi_category").isNotNull(),
        F.struct(F.col("aqi_category").alias("category"), F.col("readings").alias("readings")),
    )
    rows = per_category.groupBy("date", "hour", "zone").agg(
        F.count("aqi_category").alias("aqi_category_count"),
        F.sort_array(F.collect_list(pair)).alias("aqi_categories"),
        *finished_means({"avg_aqi": "aqi_value"}),
        F.sum("readings").alias("reading_count"),
    )
    return rows.withColumns(calendar("date"))


def category_list(trends: DataFrame) -> DataFrame:
    """The category list written out, one entry per reading and sorted, for consumers of the plain form."""
    entries = F.transform(
        "aqi_categories", lambda pair: F.array_repeat(pair["category"], pair["readings"].cast("int"))
    )
    return trends.withColumn("aqi_category_list", F.flatten(entries))

"""Gold tables and support rollups of the traffic domain.

``sensor_quarters`` merges readings to one row per sensor and quarter of an hour, with parts from which all tables but the
incidents follow, so that silver is read once for them. Functions over silver serve reports and streams without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight.functions import traffic as classify
from curbsight.functions.common import (
    averages,
    calendar,
    day_keys,
    dealt_by_day,
    distinct_hours,
    finished_means,
    grade,
    mean_parts,
    merged_deviation,
    merged_parts,
    percent,
    rounded,
    squares,
    with_deviation,
)

READING = "reading_datetime"

# Daily rating by mean flow score, and the limits of the flow trend label.
DAILY_RATING = ((85, "Excellent"), (70, "Good"), (50, "Fair"))
TREND_WORSENING_BELOW = 40
TREND_IMPROVING_ABOVE = 70
WINDOW_MINUTES = 15


def level_counts(pattern: str) -> list[Column]:
    """Readings per congestion level, named by ``pattern``."""
    return [F.count_if(F.col("congestion_level") == x).alias(pattern.format(x)) for x in classify.LEVELS]


def dominant_level(pattern: str) -> Column:
    """One severe reading decides; then the larger of high and moderate, high only if it leads."""
    n = {x: F.col(pattern.format(x)) for x in classify.LEVELS}
    return (
        F.when(n["severe"] > 0, "severe")
        .when(n["high"] > n["moderate"], "high")
        .when(n["moderate"] > 0, "moderate")
        .otherwise("low")
    )


def hourly_by_intersection(silver: DataFrame) -> DataFrame:
    """One row per hour and intersection."""
    named = "{}_congestion_count"
    rows = silver.groupBy(
        F.date_trunc("hour", READING).alias("hour_timestamp"), "intersection", "road_type", "city"
    ).agg(
        *averages({
            "avg_vehicle_count": "vehicle_count",
            "avg_speed_mph": "avg_speed_mph",
            "avg_occupancy_percent": "occupancy_percent",
            "avg_queue_length_meters": "queue_length_meters",
            "avg_traffic_flow_score": "traffic_flow_score",
        }),
        F.min("vehicle_count").alias("min_vehicle_count"),
        F.max("vehicle_count").alias("max_vehicle_count"),
        F.stddev_samp("vehicle_count").alias("stddev_vehicle_count"),
        F.sum("vehicle_count").alias("total_vehicles"),
        F.min("avg_speed_mph").alias("min_speed_mph"),
        F.max("avg_speed_mph").alias("max_speed_mph"),
        *level_counts(named),
        F.count_if("incident_detected").alias("incidents_detected"),
        F.sum("pedestrian_count").alias("total_pedestrians"),
        F.sum("bike_count").alias("total_bikes"),
        F.count(F.lit(1)).alias("reading_count"),
        F.count_distinct("sensor_id").alias("active_sensors"),
    )
    return _with_level(rows, named)


def _with_level(rows: DataFrame, named: str) -> DataFrame:
    weighted = sum(F.col(named.format(x)) * w for x, w in classify.LEVEL_WEIGHTS.items())
    return rows.withColumns({
        **calendar("hour_timestamp", hour=True),
        "dominant_congestion_level": dominant_level(named),
        "congestion_score": rounded(weighted / F.col("reading_count"), 2),
    })


# --- quarter-hour rollup --------------------------------------------------------------------

_QUARTER_MEANS = ("vehicle_count", "avg_speed_mph", "occupancy_percent", "queue_length_meters", "traffic_flow_score")
_PLACE = ("intersection", "road_type", "city")


def sensor_quarters(silver: DataFrame) -> DataFrame:
    """Mergeable parts per quarter of an hour and sensor: sums, counts, squares and extremes."""
    return _sensor_quarters(silver)


def stored_sensor_quarters(silver: DataFrame) -> DataFrame:
    """``sensor_quarters`` for a table by day: readings travel once, before they are parts, which are wider."""
    return _sensor_quarters(dealt_by_day(silver, READING, "sensor_id", F.date_trunc("hour", READING)))


def _sensor_quarters(silver: DataFrame) -> DataFrame:
    micros = F.unix_micros(READING)
    parts = silver.select(
        *day_keys(silver),
        F.timestamp_micros(micros - F.pmod(micros, F.lit(WINDOW_MINUTES * 60_000_000))).alias("time_window_start"),
        *_PLACE, "sensor_id",
        *mean_parts(_QUARTER_MEANS),
        *(F.col(c).alias(name) for name, c in {**_LOWEST, **_HIGHEST}.items()),
        *_TOTALS, "congestion_level", "incident_detected",
    )
    rows = parts.groupBy("time_window_start", *_PLACE, "sensor_id", *day_keys(parts)).agg(
        *merged_parts(_QUARTER_MEANS),
        squares("low_vehicles").alias("vehicle_count__m2"),
        *(F.min(c).alias(c) for c in _LOWEST),
        *(F.max(c).alias(c) for c in _HIGHEST),
        *(F.sum(c).alias(c) for c in _TOTALS),
        *level_counts("{}_count"),
        F.count_if("incident_detected").alias("incidents"),
        F.count(F.lit(1)).alias("readings"),
    )
    return rows.withColumns({
        "congested": F.col("severe_count") + F.col("high_count"),
        **calendar("time_window_start"),
    }).drop("_lane")


def merged_quarters(parts: DataFrame) -> DataFrame:
    """Several rollups, of whichever readings, as one: rows of the same quarter and sensor become one row."""
    keys = ("time_window_start", *_PLACE, "sensor_id")
    about, _ = merged_deviation(parts, keys, "vehicle_count")
    rows = about.groupBy(*keys).agg(
        *merged_parts(_QUARTER_MEANS),
        F.sum("_about").alias("vehicle_count__m2"),
        *(F.min(c).alias(c) for c in _LOWEST),
        *(F.max(c).alias(c) for c in _HIGHEST),
        *(F.sum(c).alias(c) for c in (*_TOTALS, *(f"{x}_count" for x in classify.LEVELS), "incidents", "readings", "congested")),
    )
    return rows.withColumns(calendar("time_window_start")).select(*parts.columns)


def _by_hour(quarters: DataFrame) -> DataFrame:
    return quarters.withColumn("hour_timestamp", F.date_trunc("hour", "time_window_start"))


def _summed_levels(pattern: str) -> list[Column]:
    return [F.sum(f"{x}_count").alias(pattern.format(x)) for x in classify.LEVELS]


_PLACE_HOUR = ("hour_timestamp", *_PLACE)


def intersection_hours(quarters: DataFrame) -> DataFrame:
    """``hourly_by_intersection`` from the rollup, in one shuffle and a sort."""
    return _intersection_hours(*merged_deviation(_by_hour(quarters), _PLACE_HOUR, "vehicle_count"))


def stored_intersection_hours(quarters: DataFrame) -> DataFrame:
    """``intersection_hours`` from a stored rollup, of which two columns are read once more instead of sorting all of it."""
    parts = _by_hour(quarters)
    rows = _intersection_hours(parts, F.lit(None).cast("double"))
    return with_deviation(rows, parts, _PLACE_HOUR, "vehicle_count", "stddev_vehicle_count")


def _intersection_hours(parts: DataFrame, deviation: Column) -> DataFrame:
    named = "{}_congestion_count"
    rows = parts.groupBy(*_PLACE_HOUR).agg(
        *finished_means({
            "avg_vehicle_count": "vehicle_count",
            "avg_speed_mph": "avg_speed_mph",
            "avg_occupancy_percent": "occupancy_percent",
            "avg_queue_length_meters": "queue_length_meters",
            "avg_traffic_flow_score": "traffic_flow_score",
        }),
        F.min("low_vehicles").alias("min_vehicle_count"),
        F.max("peak_vehicles").alias("max_vehicle_count"),
        deviation.alias("stddev_vehicle_count"),
        F.sum("vehicle_count__sum").alias("total_vehicles"),
        F.min("low_speed").alias("min_speed_mph"),
        F.max("peak_speed").alias("max_speed_mph"),
        *_summed_levels(named),
        F.sum("incidents").alias("incidents_detected"),
        F.sum("pedestrian_count").alias("total_pedestrians"),
        F.sum("bike_count").alias("total_bikes"),
        F.sum("readings").alias("reading_count"),
        F.count_distinct("sensor_id").alias("active_sensors"),
    )
    return _with_level(rows, named)


def road_days(quarters: DataFrame) -> DataFrame:
    """``daily_by_road_type`` from the rollup."""
    return daily_by_road_type(_by_hour(quarters))


def trend_quarters(quarters: DataFrame) -> DataFrame:
    """``congestion_trends`` from the rollup."""
    timed = quarters.where("time_window_start is not null")
    rows = timed.groupBy("time_window_start", "city", "road_type").agg(
        *finished_means({
            "avg_vehicles": "vehicle_count",
            "avg_speed": "avg_speed_mph",
            "avg_occupancy": "occupancy_percent",
            "avg_flow_score": "traffic_flow_score",
        }),
        *_summed_levels("{}_count"),
        F.sum("readings").alias("reading_count"),
    )
    start = F.col("time_window_start")
    return _with_trend(rows, start, start + F.expr(f"INTERVAL {WINDOW_MINUTES} MINUTES"))


def intersection_quarters(quarters: DataFrame) -> DataFrame:
    """``quarter_hours_by_intersection`` from the rollup."""
    timed = quarters.where("time_window_start is not null")
    rows = timed.groupBy("time_window_start", *_PLACE).agg(
        *finished_means({"avg_speed_mph": "avg_speed_mph"}),
        F.sum("vehicle_count__sum").alias("vehicle_count"),
        *_summed_levels("{}_count"),
        F.sum("readings").alias("reading_count"),
    )
    return rows.withColumns({**calendar("time_window_start"), "congestion_level": dominant_level("{}_count")})


def congestion_hours(quarters: DataFrame) -> DataFrame:
    """Mean and highest congestion per hour and intersection on the 0-1 scale, from the rollup."""
    shares = {x: weight / 100 for x, weight in classify.LEVEL_WEIGHTS.items()}
    total = sum(F.sum(f"{x}_count") * share for x, share in shares.items())
    levelled = sum(F.sum(f"{x}_count") for x in shares)
    rows = _by_hour(quarters).groupBy("hour_timestamp", "intersection", "city", "road_type").agg(
        F.try_divide(total, levelled).alias("hourly_avg_congestion"),
        F.max(F.greatest(*(F.when(F.col(f"{x}_count") > 0, share) for x, share in shares.items()))).alias(
            "hourly_max_congestion"),
        F.sum("incidents").alias("hourly_incidents"),
    )
    return rows.withColumns(calendar("hour_timestamp"))


# --- sensor-hour rollup ---------------------------------------------------------------------

_MEANS = ("vehicle_count", "avg_speed_mph", "traffic_flow_score")
_LOWEST = {"low_vehicles": "vehicle_count", "low_speed": "avg_speed_mph"}
_HIGHEST = {"peak_vehicles": "vehicle_count", "peak_speed": "avg_speed_mph"}
_TOTALS = ("pedestrian_count", "bike_count")


def sensor_hours(silver: DataFrame) -> DataFrame:
    """Mergeable parts per hour and sensor: sums, counts and extremes."""
    parts = silver.select(
        F.date_trunc("hour", READING).alias("hour_timestamp"), "intersection", "road_type", "city", "sensor_id",
        *mean_parts(_MEANS),
        *(F.col(c).alias(name) for name, c in {**_LOWEST, **_HIGHEST}.items()),
        *_TOTALS,
        F.col("congestion_level").isin("high", "severe").alias("congested"),
        "incident_detected",
    )
    rows = parts.groupBy("hour_timestamp", "intersection", "road_type", "city", "sensor_id").agg(
        *merged_parts(_MEANS),
        *(F.min(c).alias(c) for c in _LOWEST),
        *(F.max(c).alias(c) for c in _HIGHEST),
        *(F.sum(c).alias(c) for c in _TOTALS),
        F.count_if("congested").alias("congested"),
        F.count_if("incident_detected").alias("incidents"),
        F.count(F.lit(1)).alias("readings"),
    )
    return rows.withColumns(calendar("hour_timestamp"))


def daily_by_road_type(hours: DataFrame) -> DataFrame:
    """One row per day, road type and city, from the sensor-hour rollup.

    Three distinct counts in one aggregate copy every row; here they copy the few rows of the
    rollup instead of the readings, and the hours are counted from a bit set.
    """
    rows = hours.groupBy(F.to_date("hour_timestamp").alias("date"), "road_type", "city").agg(
        *finished_means({
            "daily_avg_vehicles": "vehicle_count",
            "daily_avg_speed": "avg_speed_mph",
            "daily_avg_flow_score": "traffic_flow_score",
        }),
        F.sum("vehicle_count__sum").alias("total_vehicles"),
        F.max("peak_vehicles").alias("daily_peak_vehicles"),
        F.min("low_vehicles").alias("daily_min_vehicles"),
        F.min("low_speed").alias("daily_min_speed"),
        F.max("peak_speed").alias("daily_max_speed"),
        F.sum("congested").alias("congested_readings"),
        F.sum("incidents").alias("total_incidents"),
        F.sum("pedestrian_count").alias("daily_pedestrians"),
        F.sum("bike_count").alias("daily_bikes"),
        F.sum("readings").alias("total_readings"),
        F.count_distinct("sensor_id").alias("unique_sensors"),
        F.count_distinct("intersection").alias("unique_intersections"),
        distinct_hours(F.hour("hour_timestamp")).alias("active_hours"),
    )
    return rows.withColumns({
        **calendar("date"),
        "congestion_percentage": rounded(percent(F.col("congested_readings"), F.col("total_readings")), 2),
        "traffic_quality_rating": grade(F.col("daily_avg_flow_score"), DAILY_RATING, "Poor"),
        "coverage_score": rounded(F.col("active_hours") / F.lit(24.0) * 100, 2),
    })


def incidents(silver: DataFrame) -> DataFrame:
    """Readings with an incident and its severity. A filter and a projection: no shuffle."""
    kept = (
        "sensor_id", "intersection", "road_type", "city", "vehicle_count", "avg_speed_mph",
        "congestion_level", "queue_length_meters", "traffic_flow_score",
    )
    return silver.filter("incident_detected").select(
        F.col(READING).alias("incident_datetime"),
        *(part.alias(name) for name, part in calendar(READING, hour=True).items()),
        *kept,
        classify.incident_severity(F.col("vehicle_count"), F.col("avg_speed_mph")).alias("incident_severity"),
    )


def congestion_trends(silver: DataFrame) -> DataFrame:
    """15-minute windows per city and road type; the same function serves batch and stream."""
    rows = silver.groupBy(
        F.window(READING, f"{WINDOW_MINUTES} minutes").alias("span"), "city", "road_type"
    ).agg(
        *averages({
            "avg_vehicles": "vehicle_count",
            "avg_speed": "avg_speed_mph",
            "avg_occupancy": "occupancy_percent",
            "avg_flow_score": "traffic_flow_score",
        }),
        *level_counts("{}_count"),
        F.count(F.lit(1)).alias("reading_count"),
    )
    return _with_trend(rows, F.col("span.start"), F.col("span.end")).drop("span")


def _with_trend(rows: DataFrame, start: Column, end: Column) -> DataFrame:
    score = F.col("avg_flow_score")
    return rows.withColumns({
        "time_window_start": start,
        "time_window_end": end,
        **calendar(start, hour=True),
        "congestion_trend": F.when(score < TREND_WORSENING_BELOW, "Worsening")
        .when(score > TREND_IMPROVING_ABOVE, "Improving")
        .otherwise("Stable"),
    })


def quarter_hours_by_intersection(silver: DataFrame) -> DataFrame:
    """Support rollup: 15-minute windows per intersection with their dominant level."""
    rows = silver.groupBy(
        F.window(READING, f"{WINDOW_MINUTES} minutes").alias("span"), "intersection", "road_type", "city"
    ).agg(
        F.avg("avg_speed_mph").alias("avg_speed_mph"),
        F.sum("vehicle_count").alias("vehicle_count"),
        *level_counts("{}_count"),
        F.count(F.lit(1)).alias("reading_count"),
    )
    return rows.withColumns({
        "time_window_start": F.col("span.start"),
        **calendar(F.col("span.start")),
        "congestion_level": dominant_level("{}_count"),
    }).drop("span")


# --- sketches of distinct sensors -----------------------------------------------------------

#: A sketch has 2^12 registers (2.5 kB at most).
SKETCH_BITS = 12
#: Three standard errors of its estimate: 1.04 / sqrt(2^12) each.
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def sensor_sketches(silver: DataFrame) -> DataFrame:
    """15-minute windows per city and road type with a mergeable sketch of their sensors; serves batch and stream."""
    rows = silver.groupBy(
        F.window(READING, f"{WINDOW_MINUTES} minutes").alias("span"), "city", "road_type"
    ).agg(F.hll_sketch_agg("sensor_id", SKETCH_BITS).alias("sensors"))
    return rows.withColumns({
        "time_window_start": F.col("span.start"), **calendar(F.col("span.start"), hour=True)
    }).drop("span")


def unique_sensors(sketches: DataFrame, *keys: str) -> DataFrame:
    """About how many sensors, per any of the keys of the sketches or coarser ones, from merged sketches alone."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sensors")).alias("unique_sensors"))


def data_range(silver: DataFrame) -> DataFrame:
    """First and last reading, sensors and intersections of a whole table, in one row.

    The distinct pairs are found first, so the two distinct counts copy pairs and not readings.
    """
    pairs = silver.groupBy("sensor_id", "intersection").agg(
        F.min(READING).alias("first_seen"), F.max(READING).alias("last_seen")
    )
    return pairs.agg(
        F.min("first_seen").alias("earliest"),
        F.max("last_seen").alias("latest"),
        F.count_distinct("sensor_id").alias("sensors"),
        F.count_distinct("intersection").alias("intersections"),
    )

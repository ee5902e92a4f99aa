"""Row rules, verdicts, quarantine and rule reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbsight.functions.common import moment

Rules = Mapping[str, Column]


def _within(column: str, low: float, high: float) -> Column:
    return F.col(column).between(F.lit(low), F.lit(high))


def air_rules() -> dict[str, Column]:
    """What a reading must satisfy to enter silver; NULL fails."""
    return {
        "pm25": (F.col("pm25") >= 0.0) & (F.col("pm25") < 500.0),
        "temperature": _within("temperature_celsius", -50.0, 60.0),
        "coordinates": _within("latitude", -90.0, 90.0) & _within("longitude", -180.0, 180.0),
        "sensor_id": F.col("sensor_id").isNotNull(),
    }


# Measurement and its range in the data dictionary.
AIR_RANGES = {
    "pm25": (0.0, 500.0),
    "pm10": (0.0, 500.0),
    "no2": (0.0, 500.0),
    "o3": (0.0, 500.0),
    "co": (0.0, 50.0),
    "temperature_celsius": (-50.0, 60.0),
    "humidity_percent": (0.0, 100.0),
}


def documented_air_rules(columns: list[str]) -> dict[str, Column]:
    """Ranges of the data dictionary for the measurements that there are; a missing value is allowed."""
    return {c: F.col(c).isNull() | _within(c, lo, hi) for c, (lo, hi) in AIR_RANGES.items() if c in columns}


def unchecked_air_ranges(columns: list[str]) -> list[str]:
    """Measurements of the data dictionary that the rows do not have."""
    return [c for c in AIR_RANGES if c not in columns]


def documented_traffic_rules() -> dict[str, Column]:
    """Ranges of the data dictionary, with shares in percent as the feed sends them."""
    return {
        "vehicle_count": F.col("vehicle_count").isNull() | (F.col("vehicle_count") >= 0),
        "avg_speed_mph": F.col("avg_speed_mph").isNull() | _within("avg_speed_mph", 0.0, 120.0),
        "occupancy_percent": F.col("occupancy_percent").isNull() | _within("occupancy_percent", 0.0, 100.0),
        "congestion_level": F.col("congestion_level").isNull()
        | F.col("congestion_level").isin("low", "moderate", "high", "severe"),
    }


def gold_rules(stamp: str, count: str, as_of: dt.datetime, minutes: int) -> dict[str, Column]:
    """Constraints on a gold table: counts, age and alignment of its time buckets."""
    stamped, now = F.col(stamp), moment(as_of)
    return {
        "reading_count_positive": F.col(count) > 0,
        "within_ten_years": (stamped >= now - F.expr("INTERVAL 10 YEARS")) & (stamped <= now),
        "bucket_aligned": F.unix_micros(stamp) % (minutes * 60_000_000) == 0,
    }


def holds(rule: Column) -> Column:
    """The rule as a plain true or false: a NULL verdict counts as a failure."""
    return F.coalesce(rule, F.lit(False))


def all_hold(rules: Rules) -> Column:
    return reduce(lambda a, b: a & b, rules.values())


def judged(frame: DataFrame, rules: Rules) -> DataFrame:
    """Add the names of the failed rules and the verdict; keeps every row."""
    failures = F.array_compact(F.array(*(F.when(~holds(r), F.lit(name)) for name, r in rules.items())))
    return frame.withColumns({"failed_rules": failures, "is_valid": holds(all_hold(rules))})


def accepted(frame: DataFrame, rules: Rules) -> DataFrame:
    return frame.filter(all_hold(rules))


def quarantine(frame: DataFrame, rules: Rules) -> DataFrame:
    """Exactly the rows ``accepted`` leaves out, with the reasons."""
    return judged(frame, rules).filter(~F.col("is_valid")).drop("is_valid")


def summary(rules: Rules) -> list[Column]:
    """One-pass batch metrics, fit for ``agg`` and for ``observe``."""
    ok = holds(all_hold(rules))
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(ok).alias("rows_valid"),
        F.count_if(~ok).alias("rows_rejected"),
        *(F.count_if(~holds(r)).alias(f"failed_{name}") for name, r in rules.items()),
    ]


def rule_report(frame: DataFrame, rules: Rules, unchecked: Iterable[str] = ()) -> DataFrame:
    """One row per rule: rows checked and rows that break it, from a single pass.

    Rules that could not be checked are listed with no row checked and no verdict.
    """
    counts = frame.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *(F.count_if(~holds(r)).alias(name) for name, r in rules.items()),
    )
    checked = counts.unpivot(["rows_checked"], list(rules), "rule", "violations").select(
        "rule", "rows_checked", "violations"
    )
    names = [(name,) for name in unchecked]
    if not names:
        return checked
    left_out = frame.sparkSession.createDataFrame(names, "rule string").selectExpr(
        "rule", "0L as rows_checked", "cast(null as bigint) as violations")
    return checked.unionByName(left_out)

"""The saved reports by name, over gold tables in the catalog."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curbsight.plans import air_reports, documented, traffic_reports

Tables = Callable[[str], DataFrame]


def _daily_index(table: Tables) -> DataFrame:
    return table("air_quality_daily_summary").withColumnRenamed("daily_avg_aqi", "avg_aqi")


def _sensor_days(table: Tables) -> DataFrame:
    return table("air_quality_daily_by_sensor")


def _sensor_hours(table: Tables) -> DataFrame:
    return table("air_quality_hourly_by_sensor")


def _intersections(table: Tables) -> DataFrame:
    return table("traffic_hourly_by_intersection")


def _quarter_hours(table: Tables) -> DataFrame:
    return table("traffic_congestion_by_intersection")


def _road_days(table: Tables) -> DataFrame:
    return table("traffic_daily_summary")


def _devices(table: Tables) -> DataFrame:
    """Sensor days with the quality score, which comes from readings before the rules and is a table of its own."""
    scores = table("sensor_quality_daily").select("date", "sensor_id", "data_quality_score", "last_calibration_date")
    return table("sensor_health_metrics").join(scores, ["date", "sensor_id"], "left")


REPORTS: dict[str, Callable[[Tables, dt.datetime], DataFrame]] = {
    "weekly_trend": lambda t, at: air_reports.weekly_trend(_sensor_days(t), at.date()),
    "today_by_sensor": lambda t, at: air_reports.today_by_sensor(_sensor_hours(t), at.date()),
    "most_polluted_zones": lambda t, at: air_reports.most_polluted_zones(_sensor_hours(t), at),
    "devices_needing_attention": lambda t, at: air_reports.devices_needing_attention(_devices(t), at.date()),
    "congested_hours": lambda t, at: documented.congested_hours(t("traffic_hourly_congestion"), at),
    "air_with_traffic": lambda t, at: documented.air_with_traffic(
        t("air_quality_hourly_avg"), t("traffic_hourly_congestion"), at
    ),
    "week_over_week": lambda t, at: air_reports.week_over_week(_sensor_days(t), at.date()),
    "monthly_summary": lambda t, at: air_reports.monthly_summary(_daily_index(t), at.date()),
    "weather_and_aqi": lambda t, at: air_reports.weather_and_aqi(_sensor_days(t), at.date()),
    "missing_sensor_days": lambda t, at: air_reports.missing_sensor_days(
        _sensor_days(t), t("sensor_health_metrics"), at.date()
    ),
    "worst_hours": lambda t, at: air_reports.worst_hours(t("air_quality_hourly_avg"), at),
    "congestion_hotspots": lambda t, at: traffic_reports.congestion_hotspots(_quarter_hours(t), at),
    "today_by_intersection": lambda t, at: traffic_reports.today_by_intersection(_intersections(t), at),
    "daily_by_city": lambda t, at: traffic_reports.daily_by_city(_road_days(t), at.date()),
    "rush_hours": lambda t, at: traffic_reports.rush_hours(_intersections(t), at),
    "incident_profile": lambda t, at: traffic_reports.incident_profile(t("traffic_incidents"), at.date()),
    "congested_quarter_hours": lambda t, at: traffic_reports.congested_quarter_hours(_quarter_hours(t), at),
    "weekday_against_weekend": lambda t, at: traffic_reports.weekday_against_weekend(_road_days(t), at.date()),
    "dangerous_intersections": lambda t, at: traffic_reports.dangerous_intersections(
        t("traffic_incidents"), _intersections(t), at.date()
    ),
    "flow_efficiency": lambda t, at: traffic_reports.flow_efficiency(_intersections(t), at),
    "monthly_growth": lambda t, at: traffic_reports.monthly_growth(_road_days(t), at.date()),
}


def run_report(spark: SparkSession, database: str, name: str, as_of: dt.datetime) -> DataFrame:
    """A saved report as of a time, from the tables of ``database``."""
    return REPORTS[name](lambda table: spark.table(f"{database}.{table}"), as_of)

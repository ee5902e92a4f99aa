"""Hand-made readings for rules a large table hides."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from curbsight import schemas

AT = dt.datetime(2024, 1, 10, 8, 0, 0, tzinfo=dt.timezone.utc)

_AIR = {
    "sensor_id": "AQ_1", "reading_timestamp": "2024-01-10T08:00:00+00:00", "reading_datetime": AT,
    "zone": "downtown", "city": "New_York", "country": "USA", "latitude": 40.7, "longitude": -74.0,
    "pm25": 10.0, "pm10": 14.0, "co2": 400.0, "no2": 10.0, "o3": 20.0, "temperature_celsius": 15.0,
    "humidity_percent": 50.0, "pressure_hpa": 1013.0, "aqi_value": 41, "aqi_category": "Good",
    "device_status": "active", "battery_level": 80, "signal_strength_dbm": -50, "firmware_version": "2.1.4",
    "year": 2024, "month": 1, "day": 10,
}

_TRAFFIC = {
    "sensor_id": "TR_1", "reading_datetime": AT, "event_id": "e", "intersection": "Main_St_5th_Ave",
    "road_type": "major", "city": "New_York", "country": "USA", "vehicle_count": 20, "avg_speed_mph": 30.0,
    "congestion_level": "low", "pedestrian_count": 1, "bike_count": 2, "occupancy_percent": 20.0,
    "queue_length_meters": 5.0, "traffic_flow_score": 80, "incident_detected": False,
    "year": 2024, "month": 1, "day": 10, "hour": 8,
}


def _frame(spark: SparkSession, schema: T.StructType, base: dict, changes: list[dict]) -> DataFrame:
    rows = []
    for change in changes:
        row = {**base, **change}
        when = row["reading_datetime"]
        if when is not None:
            row.update({k: getattr(when, k) for k in ("year", "month", "day", "hour") if k in base})
        rows.append(tuple(row.get(name) for name in schema.names))
    return spark.createDataFrame(rows, schema)


def air(spark: SparkSession, *changes: dict) -> DataFrame:
    return _frame(spark, schemas.SILVER_AIR, _AIR, list(changes) or [{}])


def traffic(spark: SparkSession, *changes: dict) -> DataFrame:
    return _frame(spark, schemas.SILVER_TRAFFIC, _TRAFFIC, list(changes) or [{}])


def minutes(n: float) -> dt.datetime:
    return AT + dt.timedelta(minutes=n)


def change_line(kind: str, seq: str, pm25: object = 10.0, **over: object) -> dict:
    """One bronze envelope as the feed writes it."""
    sensor, stamp = over.get("sensor", "AQ_1"), over.get("stamp", "2024-01-10T08:00:00+00:00")
    image = {
        "sensor_id": sensor, "timestamp": stamp, "sensor_type": "air_quality",
        "location": {"lat": 40.7, "lon": "-74.0", "zone": "downtown", "city": "New_York", "country": "USA"},
        "measurements": {"pm25": pm25, "temperature": 15.5},
        "aqi": {"value": 41.0, "category": "Good"},
        "metadata": {"device_status": "active", "battery_level": "87", "signal_strength": -50},
        "data_source": "test",
    }
    line = {
        "cdc_event_id": f"c{seq}", "cdc_event_type": kind, "cdc_timestamp": "2024-01-10T08:00:05+00:00",
        "cdc_sequence_number": seq, "cdc_size_bytes": 10, "keys": {"sensor_id": sensor, "timestamp": stamp},
    }
    if kind == "REMOVE":
        return {**line, "old_image": image}
    return {
        **line, "new_image": image, "sensor_id": sensor, "sensor_type": "air_quality", "sensor_timestamp": stamp,
        "zone": "downtown", "pm25": pm25,
    }

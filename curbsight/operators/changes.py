"""Change feed: flattening of change records, latest-wins and the silver projection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbsight import schemas
from curbsight.functions.common import calendar, processing_time
from curbsight.functions.documents import decode_open_documents

# Event kinds and the feed they come from.
UPSERTS = ("INSERT", "MODIFY")
FEED_SOURCE = "aws:dynamodb"
FEED_LABEL = "dynamodb-streams"


# --- change record -> bronze envelope -------------------------------------------------------


def flatten_changes(records: DataFrame, run_at: dt.datetime) -> DataFrame:
    """Change records of the feed as bronze envelopes, images decoded and key readings lifted.

    The event id of the record is kept as the envelope's id: a random id would change whenever a
    lost task is run again. Records of other sources are none of this feed; lines that are no record are found
    with ``broken_lines``. Attributes that the images' schema doesn't declare are in the ``_rest`` columns.
    """
    feed = records.filter(F.col("eventSource") == FEED_SOURCE).select(
        "eventID", "eventName", "awsRegion", "eventSourceARN",
        F.col("dynamodb.SequenceNumber").alias("sequence"),
        F.col("dynamodb.SizeBytes").try_cast("bigint").alias("size"),
        F.col("dynamodb.Keys").alias("keys"),
        F.col("dynamodb.OldImage").alias("old_image"),
        F.col("dynamodb.NewImage").alias("new_image"),
    )
    images = decode_open_documents(
        feed, {"keys": schemas.KEYS, "old_image": schemas.AIR_DOCUMENT, "new_image": schemas.AIR_DOCUMENT}
    )
    upsert = F.col("eventName").isin(*UPSERTS)
    lifted = {
        "sensor_id": "sensor_id",
        "sensor_type": "sensor_type",
        "sensor_timestamp": "timestamp",
        "zone": "location.zone",
        "pm25": "measurements.pm25",
        "temperature": "measurements.temperature",
        "aqi_value": "aqi.value",
    }
    stamp = {"year": "%Y", "month": "%m", "day": "%d", "hour": "%H"}
    return images.select(
        F.col("eventID").alias("cdc_event_id"),
        F.col("eventName").alias("cdc_event_type"),
        F.lit(run_at.isoformat()).alias("cdc_timestamp"),
        F.lit(FEED_LABEL).alias("cdc_source"),
        F.col("sequence").alias("cdc_sequence_number"),
        F.col("size").alias("cdc_size_bytes"),
        F.col("awsRegion").alias("aws_region"),
        F.col("eventSourceARN").alias("table_arn"),
        *(F.lit(run_at.strftime(code)).alias(f"partition_{part}") for part, code in stamp.items()),
        "keys", "old_image", "new_image", "keys_rest", "old_image_rest", "new_image_rest",
        *(F.when(upsert, F.col(f"new_image.{path}")).alias(name) for name, path in lifted.items()),
    )


# --- bronze envelope -> silver --------------------------------------------------------------

# Silver column, path below the image, type.
_AIR_PATHS = (
    ("latitude", "location.lat", "double"),
    ("longitude", "location.lon", "double"),
    ("zone", "location.zone", "string"),
    ("city", "location.city", "string"),
    ("country", "location.country", "string"),
    ("pm25", "measurements.pm25", "double"),
    ("pm10", "measurements.pm10", "double"),
    ("co2", "measurements.co2", "double"),
    ("no2", "measurements.no2", "double"),
    ("o3", "measurements.o3", "double"),
    ("temperature_celsius", "measurements.temperature", "double"),
    ("humidity_percent", "measurements.humidity", "double"),
    ("pressure_hpa", "measurements.pressure", "double"),
    ("aqi_value", "aqi.value", "int"),
    ("aqi_category", "aqi.category", "string"),
    ("device_status", "metadata.device_status", "string"),
    ("battery_level", "metadata.battery_level", "int"),
    ("signal_strength_dbm", "metadata.signal_strength", "int"),
    ("firmware_version", "metadata.firmware_version", "string"),
)


def lenient(value: Column, kind: str) -> Column:
    """Cast that yields NULL instead of failing; whole numbers may be written with a fraction."""
    if kind == "string":
        return value
    number = value.try_cast("double")
    return number if kind == "double" else number.try_cast(kind)


def upserts(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("cdc_event_type").isin(*UPSERTS))


def project_air(bronze: DataFrame, run_at: dt.datetime | None) -> DataFrame:
    """Flatten envelopes to silver columns, partitioned by the time of the reading.

    The order of the change, its kind and the calibration date ride along for the steps that
    follow; ``silver_columns`` removes them.
    """
    flat = bronze.select(
        "sensor_id",
        F.col("sensor_timestamp").alias("reading_timestamp"),
        F.try_to_timestamp("sensor_timestamp").cast("timestamp").alias("reading_datetime"),
        "sensor_type",
        *(lenient(F.col(f"new_image.{path}"), kind).alias(name) for name, path, kind in _AIR_PATHS),
        F.col("cdc_event_id").alias("source_cdc_event_id"),
        F.col("cdc_timestamp").alias("cdc_processed_at"),
        processing_time(run_at).alias("silver_processed_at"),
        F.col("new_image.data_source").alias("data_source"),
        "cdc_event_type",
        "cdc_sequence_number",
        F.to_date(F.try_to_timestamp("new_image.metadata.last_calibration")).alias("calibration_date"),
    )
    return flat.withColumns(calendar("reading_datetime"))


def silver_columns(frame: DataFrame) -> DataFrame:
    return frame.select(*schemas.SILVER_AIR.names)


READING_KEY = ("sensor_id", "reading_timestamp")


def newest_first(sequence: str, stamp: str, event: str) -> list[Column]:
    """Total order of changes. Sequence numbers are digits in text, so the longer is the larger."""
    return [F.length(sequence).desc(), F.col(sequence).desc(), F.col(stamp).desc(), F.col(event).desc()]


def latest_per_key(frame: DataFrame, key: tuple[str, ...], order: list[Column]) -> DataFrame:
    """Keep the first row of each key.

    ``row_number() = 1`` lets Spark cut every key to one row per input partition before the
    shuffle, so a key with very many copies does not travel whole to one task.
    """
    ranked = Window.partitionBy(*key).orderBy(*order)
    return frame.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def latest_readings(projected: DataFrame) -> DataFrame:
    """Latest version of each reading."""
    order = newest_first("cdc_sequence_number", "cdc_processed_at", "source_cdc_event_id")
    return latest_per_key(projected, READING_KEY, order)


def with_entity_key(bronze: DataFrame) -> DataFrame:
    """Give deletions, which lift no reading, the sensor and time out of their key document."""
    return bronze.withColumns({
        "sensor_id": F.coalesce("sensor_id", "keys.sensor_id"),
        "sensor_timestamp": F.coalesce("sensor_timestamp", "keys.timestamp"),
    })


def current_readings(bronze: DataFrame, run_at: dt.datetime, *, apply_deletes: bool = False) -> DataFrame:
    """Latest readings of a whole bronze table, before quality rules.

    By default deletions are ignored, as the feed's consumers expect; with ``apply_deletes`` a
    reading whose newest change is a deletion disappears.
    """
    if not apply_deletes:
        return latest_readings(project_air(upserts(bronze), run_at))
    latest = latest_readings(project_air(with_entity_key(bronze), run_at))
    return latest.filter(F.col("cdc_event_type") != "REMOVE")

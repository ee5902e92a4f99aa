"""Declared schemas: bronze documents, silver tables and the small dimensions."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

TEXT, REAL, WHOLE, BIG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
FLAG, STAMP, DATE, OPEN = T.BooleanType(), T.TimestampType(), T.DateType(), T.VariantType()


def struct(*groups: tuple[str, T.DataType]) -> T.StructType:
    """Fields from (names separated by blanks, type) pairs. Needs no running session."""
    return T.StructType([T.StructField(name, kind) for names, kind in groups for name in names.split()])


def extended(base: T.StructType, *groups: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(base.fields + struct(*groups).fields)


# Bronze leaves that hold numbers are read as text. A number and a quoted number then both
# survive the scan, and one bad value costs that value only, not the record it sits in.
AIR_DOCUMENT = struct(
    ("sensor_id timestamp event_id sensor_type", TEXT),
    ("location", struct(("lat lon zone city country", TEXT))),
    ("measurements", struct(("pm25 pm10 co2 no2 o3 temperature humidity pressure", TEXT))),
    ("aqi", struct(("value category", TEXT))),
    ("metadata", struct(("device_status battery_level signal_strength firmware_version last_calibration", TEXT))),
    ("created_at updated_at", TEXT),
    ("is_active", FLAG),
    ("data_source", TEXT),
)

KEYS = struct(("sensor_id timestamp", TEXT))

BRONZE_AIR = struct(
    ("cdc_event_id cdc_event_type cdc_timestamp cdc_source cdc_sequence_number", TEXT),
    ("cdc_size_bytes", BIG),
    ("aws_region table_arn partition_year partition_month partition_day partition_hour", TEXT),
    ("keys", KEYS),
    ("old_image new_image", AIR_DOCUMENT),
    # Attributes of these documents that are not declared above.
    ("keys_rest old_image_rest new_image_rest", OPEN),
    ("sensor_id sensor_type sensor_timestamp zone pm25 temperature aqi_value", TEXT),
    (CORRUPT, TEXT),
)

BRONZE_TRAFFIC = struct(
    ("sensor_id timestamp event_id sensor_type", TEXT),
    ("location", struct(("lat lon intersection road_type city country", TEXT))),
    (
        "measurements",
        struct((
            "vehicle_count avg_speed_mph congestion_level pedestrian_count bike_count occupancy_percent "
            "queue_length_meters",
            TEXT,
        )),
    ),
    ("traffic_flow_score", TEXT),
    ("incident_detected", FLAG),
    ("metadata", struct(("device_status signal_strength firmware_version last_calibration", TEXT))),
    ("created_at data_source ingestion_type", TEXT),
    (CORRUPT, TEXT),
)

_SILVER_AIR_BODY = struct(
    ("sensor_id reading_timestamp", TEXT),
    ("reading_datetime", STAMP),
    ("sensor_type", TEXT),
    ("latitude longitude", REAL),
    ("zone city country", TEXT),
    ("pm25 pm10 co2 no2 o3 temperature_celsius humidity_percent pressure_hpa", REAL),
    ("aqi_value", WHOLE),
    ("aqi_category device_status", TEXT),
    ("battery_level signal_strength_dbm", WHOLE),
    ("firmware_version source_cdc_event_id cdc_processed_at", TEXT),
    ("silver_processed_at", STAMP),
    ("data_source", TEXT),
)

SILVER_AIR = extended(_SILVER_AIR_BODY, ("year month day", WHOLE))

# What the incremental job keeps: the newest change per reading with its order and its verdict.
SILVER_AIR_STATE = extended(
    _SILVER_AIR_BODY,
    ("cdc_event_type cdc_sequence_number", TEXT),
    ("calibration_date", DATE),
    ("failed_rules", T.ArrayType(TEXT)),
    ("is_valid", FLAG),
    ("year month day", WHOLE),
)

SILVER_TRAFFIC = struct(
    ("sensor_id", TEXT),
    ("reading_datetime", STAMP),
    ("event_id", TEXT),
    ("latitude longitude", REAL),
    ("intersection road_type city country", TEXT),
    ("vehicle_count", WHOLE),
    ("avg_speed_mph", REAL),
    ("congestion_level", TEXT),
    ("pedestrian_count bike_count", WHOLE),
    ("occupancy_percent queue_length_meters", REAL),
    ("traffic_flow_score", WHOLE),
    ("incident_detected", FLAG),
    ("device_status", TEXT),
    ("signal_strength_dbm", WHOLE),
    ("firmware_version", TEXT),
    ("silver_processed_at", STAMP),
    ("data_source ingestion_type", TEXT),
    ("year month day hour", WHOLE),
)

# The envelope one change record arrives in; its typed documents stay text until they are decoded. The size is
# text as well: a bad one must not make the whole record unreadable.
CHANGE_RECORD = struct(
    ("eventID eventName eventSource awsRegion eventSourceARN", TEXT),
    (
        "dynamodb",
        struct(("Keys OldImage NewImage SequenceNumber SizeBytes", TEXT)),
    ),
    (CORRUPT, TEXT),
)

# Change records as a capture stages them: with the time of the batch, which a retry must not change.
CAPTURED = T.StructType([f for f in CHANGE_RECORD.fields] + [T.StructField("captured_at", STAMP)])

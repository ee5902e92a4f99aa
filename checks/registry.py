"""Registered queries: every operator and report over the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import frames
from checks.frames import AS_OF, LONG_AS_OF, RUN_AT
from curbsight import schemas
from curbsight.functions import air as air_index
from curbsight.functions import traffic as classify
from curbsight.functions.common import moment, months_back, rounded, week_start
from curbsight.functions.documents import attribute_report, decode_open_documents
from curbsight.operators import air_gold, changes, quality, traffic_gold
from curbsight.plans import air_reports, documented, jobs, saved, traffic_reports
from curbsight.session import scratch_dir
from curbsight.sources import tables
from curbsight.streaming import air_changes, capture, ledger, metrics, windows
from curbsight.streaming import traffic as stream

Query = Callable[[SparkSession, str], DataFrame]
BUILDS: dict[str, Query] = {}
QUERIES: dict[str, Query] = {}

DAY = dt.timedelta(days=1)
TODAY = AS_OF.date()
LAST_24H = AS_OF - DAY


def comparable(frame: DataFrame) -> DataFrame:
    """The result in types two engines compare alike: rounded doubles, zone-free times, text lists."""
    def plain(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return rounded(c, 6).alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return c.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(c, "|").alias(field.name)
        return c

    return frame.select(*(plain(f) for f in frame.schema.fields))


def query(name: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(build(spark, sf_dir))

        BUILDS[name] = build
        QUERIES[name] = run
        return build

    return add


def run_at_free(frame: DataFrame) -> DataFrame:
    return frame.drop("silver_processed_at", "cdc_processed_at")


# --- sources --------------------------------------------------------------------------------


#: Records in a landed file. Compressed files can't be split, so this keeps them small enough to be read side by side.
LANDED_RECORDS = 100_000


def land(rows: DataFrame, path: str) -> None:
    """Add records to a landing folder, compressed: in plain text they take twenty times their table's size."""
    options = {"compression": "gzip", "maxRecordsPerFile": LANDED_RECORDS}
    rows.write.mode("append").options(**options).json(path)


def land_changes(spark: SparkSession, sf_dir: str, path: str, *, spoiled: bool = True) -> str:
    land(frames.changes(spark, sf_dir, spoiled=spoiled), path)
    return path


@query("src_jsonl")
def src_jsonl(spark, sf_dir):
    path = land_changes(spark, sf_dir, scratch_dir(spark, "bronze"))
    spark.createDataFrame([('{"cdc_event_id": "cut off', )], "value string").write.mode("append").text(path)
    return tables.read_air_bronze(spark, path).select(
        "cdc_event_id", "cdc_event_type", "cdc_sequence_number", "sensor_id", "zone",
        F.col("keys.timestamp").alias("key_timestamp"),
        F.col("new_image.measurements.pm25").try_cast("double").alias("pm25"),
        F.col("old_image.location.city").alias("old_city"),
        F.col(schemas.CORRUPT).isNotNull().alias("broken"),
    )


@query("src_parquet_table")
def src_parquet_table(spark, sf_dir):
    path = scratch_dir(spark, "silver")
    audit = {c: F.lit(None).cast(t) for c, t in (("silver_processed_at", "timestamp"), ("cdc_processed_at", "string"))}
    silver = frames.air(spark, sf_dir).withColumns({**audit, "source_cdc_event_id": F.col("event_id").cast("string")})
    tables.write_parquet(silver.select(*schemas.SILVER_AIR.names), path)
    rows = tables.read_parquet(spark, path, schemas.SILVER_AIR)
    return rows.groupBy("year", "month", "day", "zone").agg(
        F.count(F.lit(1)).alias("readings"), F.sum("aqi_value").alias("aqi_total")
    )


@query("src_empty_guard")
def src_empty_guard(spark, sf_dir):
    silver = frames.traffic(spark, sf_dir)
    inputs = {"all": silver, "none": silver.filter("vehicle_count < 0")}
    ran = {name: tables.transform_unless_empty(rows, traffic_gold.data_range) for name, rows in inputs.items()}
    parts = [out.withColumn("input", F.lit(name)) for name, out in ran.items() if out is not None]
    (only,) = parts
    return only


# --- sinks ----------------------------------------------------------------------------------


@query("rt_jsonl_hour")
def rt_jsonl_hour(spark, sf_dir):
    path = scratch_dir(spark, "bronze")
    feed = frames.changes(spark, sf_dir)
    # Two batches processed in different hours land in different folders.
    tables.append_jsonl(changes.upserts(feed), path, RUN_AT)
    tables.append_jsonl(feed.filter("cdc_event_type = 'REMOVE'"), path, RUN_AT + dt.timedelta(hours=1))
    rows = spark.read.schema(
        T.StructType(schemas.BRONZE_AIR.fields + [T.StructField(p, T.IntegerType()) for p in tables.HOURLY])
    ).json(path)
    return rows.groupBy("year", "month", "day", "hour", "cdc_event_type").agg(F.count(F.lit(1)).alias("records"))


@query("rt_parquet_append")
def rt_parquet_append(spark, sf_dir):
    path = scratch_dir(spark, "silver")
    silver = run_at_free(changes.current_readings(frames.changes(spark, sf_dir), RUN_AT))
    for zones in (("downtown", "midtown"), ("uptown", "industrial", "residential")):
        tables.write_parquet(silver.filter(F.col("zone").isin(*zones)), path, mode="append")
    return tables.read_parquet(spark, path).groupBy("year", "month", "day", "zone").agg(
        F.count(F.lit(1)).alias("readings"), F.sum("pm25").alias("pm25_total")
    )


@query("rt_parquet_overwrite")
def rt_parquet_overwrite(spark, sf_dir):
    path = scratch_dir(spark, "gold")
    gold = air_gold.hourly_by_zone(frames.air(spark, sf_dir))
    for _ in range(2):
        tables.write_parquet(gold, path)
    return tables.read_parquet(spark, path)


@query("rt_parquet_overwrite_ym")
def rt_parquet_overwrite_ym(spark, sf_dir):
    path = scratch_dir(spark, "gold")
    gold = air_gold.daily_by_zone(air_hours(spark, sf_dir))
    for _ in range(2):
        tables.write_parquet(gold, path, by=tables.MONTHLY)
    return tables.read_parquet(spark, path)


@query("rt_skip_empty")
def rt_skip_empty(spark, sf_dir):
    path = scratch_dir(spark, "gold")
    found = traffic_gold.incidents(frames.traffic(spark, sf_dir))
    tables.write_unless_empty(found, path)
    tables.write_unless_empty(found.filter("vehicle_count < 0"), path)
    return tables.read_parquet(spark, path)


@query("rt_catalog_table")
def rt_catalog_table(spark, sf_dir):
    path = scratch_dir(spark, "gold")
    gold = traffic_gold.congestion_trends(frames.traffic(spark, sf_dir))
    tables.write_parquet(gold, path)
    name = "trends_" + path.rsplit("-", 1)[-1]
    tables.register_table(spark, name, path, gold.schema)
    return spark.table(name)


# --- change feed and silver -----------------------------------------------------------------


@query("cdc_filter_active")
def cdc_filter_active(spark, sf_dir):
    return changes.upserts(frames.changes(spark, sf_dir)).select(
        "cdc_event_id", "cdc_event_type", "sensor_id", "sensor_timestamp"
    )


@query("cdc_dedup_latest")
def cdc_dedup_latest(spark, sf_dir):
    order = changes.newest_first("cdc_sequence_number", "cdc_timestamp", "cdc_event_id")
    rows = changes.upserts(frames.changes(spark, sf_dir)).select(
        "sensor_id", "sensor_timestamp", "cdc_sequence_number", "cdc_timestamp", "cdc_event_id",
        "cdc_event_type", F.col("pm25").cast("double").alias("pm25"),
    )
    return changes.latest_per_key(rows, ("sensor_id", "sensor_timestamp"), order)


@query("cdc_apply_deletes")
def cdc_apply_deletes(spark, sf_dir):
    rows = changes.current_readings(frames.changes(spark, sf_dir), RUN_AT, apply_deletes=True)
    return rows.select("sensor_id", "reading_timestamp", "cdc_event_type", "cdc_sequence_number", "pm25")


def typed_text(spark, sf_dir) -> DataFrame:
    """Change records in their raw, typed JSON form, one per event."""
    def tagged(tag: str, value):
        return F.struct(value.cast("string").alias(tag))

    k = F.col("k")
    image = F.struct(
        tagged("S", F.col("sensor_id")).alias("sensor_id"),
        tagged("S", F.col("reading_timestamp")).alias("timestamp"),
        tagged("S", F.lit("air_quality")).alias("sensor_type"),
        F.struct(F.struct(
            tagged("N", F.col("latitude")).alias("lat"),
            tagged("S", F.col("zone")).alias("zone"),
        ).alias("M")).alias("location"),
        F.struct(F.struct(
            tagged("N", F.col("pm25")).alias("pm25"),
            F.when(k % 10 != 0, tagged("N", F.col("temperature_celsius"))).alias("temperature"),
        ).alias("M")).alias("measurements"),
        F.struct(F.struct(tagged("N", F.col("aqi_value")).alias("value")).alias("M")).alias("aqi"),
        F.struct((k % 2 == 0).alias("BOOL")).alias("is_active"),
        F.struct(F.lit(True).alias("NULL")).alias("created_at"),
    )
    record = F.struct(
        F.concat(F.lit("rec_"), F.col("event_id").cast("string")).alias("eventID"),
        F.when(k % 7 == 0, "REMOVE").when(k % 2 == 0, "MODIFY").otherwise("INSERT").alias("eventName"),
        F.when(k % 13 == 0, "other:queue").otherwise("aws:dynamodb").alias("eventSource"),
        F.lit("us-east-1").alias("awsRegion"),
        F.lit("table/air_quality").alias("eventSourceARN"),
        F.struct(
            F.struct(image["sensor_id"].alias("sensor_id"), image["timestamp"].alias("timestamp")).alias("Keys"),
            F.when(k % 2 == 0, image).alias("OldImage"),
            F.when(k % 7 != 0, image).alias("NewImage"),
            (F.col("event_id") + 1).cast("string").alias("SequenceNumber"),
            F.lit(256).alias("SizeBytes"),
        ).alias("dynamodb"),
    )
    rows = frames.air(spark, sf_dir).withColumn("k", F.col("battery_level"))
    return rows.select(F.to_json(record).alias("value"))


@query("cdc_decode")
def cdc_decode(spark, sf_dir):
    """Every tag of a typed document: S, N, BOOL, NULL, M, L, SS, NS; and what no schema declares, as one variant."""
    k = F.col("battery_level")
    number = lambda c: F.struct(c.cast("string").alias("N"))
    text = F.to_json(F.struct(
        number(F.col("event_id")).alias("event_id"),
        F.struct(F.col("sensor_id").alias("S")).alias("id"),
        number(F.col("pm25")).alias("pm25"),
        F.struct(F.concat(k.cast("string"), F.lit(".0")).alias("N")).alias("battery"),
        F.struct((k % 2 == 0).alias("BOOL")).alias("even"),
        F.struct(F.lit(True).alias("NULL")).alias("gone"),
        F.struct(F.struct(F.struct(F.col("zone").alias("S")).alias("zone"), number(k).alias("n"),
                          F.struct(F.col("city").alias("S")).alias("city")).alias("M")).alias("place"),
        F.struct(F.array(number(k), number(k + 1)).alias("L")).alias("pair"),
        F.struct(F.array(F.col("zone"), F.col("city")).alias("SS")).alias("tags"),
        F.struct(F.array(k.cast("string"), F.lit("2.5")).alias("NS")).alias("levels"),
        F.when(k % 2 == 0, F.struct(F.concat(F.lit("seen "), F.col("zone")).alias("S"))).alias("note"),
        F.struct(F.struct(number(k).alias("x"), F.struct(F.array(
            F.struct(F.col("zone").alias("S")), F.struct(F.col("city").alias("S"))).alias("L")).alias("y")).alias("M")).alias("extra"),
        F.struct(F.array(F.lit("AQI="), F.lit("Aw==")).alias("BS")).alias("raw"),
        F.when(k % 3 == 0, F.struct(k.alias("QQ"))).alias("odd"),
    ))
    target = schemas.struct(
        ("event_id", schemas.BIG), ("id", schemas.TEXT), ("pm25", schemas.REAL), ("battery", schemas.WHOLE), ("even", schemas.FLAG),
        ("gone", schemas.TEXT),
        ("place", schemas.struct(("zone", schemas.TEXT), ("n", schemas.WHOLE))),
        ("pair", T.ArrayType(schemas.WHOLE)), ("tags", T.ArrayType(schemas.TEXT)),
        ("levels", T.ArrayType(schemas.REAL)),
    )
    path = scratch_dir(spark, "documents")
    frames.air(spark, sf_dir).select(text.alias("d")).write.text(path)
    documents = spark.read.text(path).withColumnRenamed("value", "d")
    return decode_open_documents(documents, {"d": target}).select(
        "d.event_id", "d.id", "d.pm25", "d.battery", "d.even", "d.gone",
        F.col("d.place.zone").alias("zone"), F.col("d.place.n").alias("n"),
        F.aggregate("d.pair", F.lit(0), lambda a, x: a + x).alias("pair_sum"),
        "d.tags",
        F.aggregate("d.levels", F.lit(0.0), lambda a, x: a + x).alias("level_sum"),
        F.col("d_rest").cast("string").alias("rest"),
    )


@query("cdc_open_attributes")
def cdc_open_attributes(spark, sf_dir):
    """What the feed carries beyond its schema, found in bronze: how often, and the type that holds all its values."""
    base = scratch_dir(spark, "open")
    value, k = F.col("value"), F.get_json_object("value", "$.dynamodb.NewImage.aqi.M.value.N").cast("int")
    site = F.concat(F.lit('"site_code":{"N":"'), k.cast("string"), F.when(k % 2 == 0, ".5").otherwise(""), F.lit('"},'))
    seen = F.when(k.isNotNull(), F.concat(F.lit('"NewImage":{'), site, F.lit('"owner":{"M":{"team":{"S":"air"}}},')))
    more = F.replace(value, F.lit('"NewImage":{'), F.coalesce(seen, F.lit('"NewImage":{')))
    typed_text(spark, sf_dir).select(more).write.text(f"{base}/landing")
    capture.run_capture(spark, f"{base}/landing", f"{base}/bronze", f"{base}/failed", f"{base}/progress",
                        RUN_AT).awaitTermination()
    return attribute_report(tables.read_air_bronze(spark, f"{base}/bronze"), ["keys", "old_image", "new_image"])


@query("cdc_flatten")
def cdc_flatten(spark, sf_dir):
    path = scratch_dir(spark, "feed")
    typed_text(spark, sf_dir).write.text(path)
    flat = changes.flatten_changes(tables.read_change_records(spark, path), RUN_AT)
    return flat.select(
        "cdc_event_id", "cdc_event_type", "cdc_source", "cdc_sequence_number", "cdc_size_bytes",
        "partition_year", "partition_hour",
        F.col("keys.sensor_id").alias("key_sensor"),
        F.col("old_image.location.zone").alias("old_zone"),
        F.col("new_image.is_active").alias("new_active"),
        "sensor_id", "sensor_timestamp", "zone",
        F.col("pm25").try_cast("double").alias("pm25"),
        F.col("temperature").try_cast("double").alias("temperature"),
        F.col("aqi_value").try_cast("int").alias("aqi_value"),
    )


@query("job_capture")
def job_capture(spark, sf_dir):
    """Change records with broken lines among them, captured as they arrive: what reaches bronze, each once, and what
    is kept aside with its reason.
    """
    base = scratch_dir(spark, "capture")
    broken = spark.createDataFrame([("{\"eventID\": \"rec_x\", ",), ("no json",)], "value string")
    odd = spark.createDataFrame([(
        '{"eventID": "rec_odd", "eventName": "INSERT", "eventSource": "aws:dynamodb", '
        '"dynamodb": {"SequenceNumber": "1", "SizeBytes": "many"}}',)], "value string")
    arrivals = (typed_text(spark, sf_dir), broken.unionByName(odd), None)
    for hours, part in enumerate(arrivals):  # the third run finds nothing new
        if part is not None:
            part.write.mode("append").text(f"{base}/landing")
        capture.run_capture(spark, f"{base}/landing", f"{base}/bronze", f"{base}/failed", f"{base}/progress",
                            RUN_AT + dt.timedelta(hours=hours)).awaitTermination()
    kept = tables.read_air_bronze(spark, f"{base}/bronze").select(
        F.col("cdc_event_id").alias("record_id"), F.col("cdc_event_type").alias("outcome"))
    failed = spark.read.schema("record_id string, record string, reason string").option(
        "recursiveFileLookup", "true").json(f"{base}/failed")
    return kept.unionByName(failed.select("record_id", F.col("reason").alias("outcome")))


@query("silver_air_project")
def silver_air_project(spark, sf_dir):
    rows = changes.project_air(changes.upserts(frames.changes(spark, sf_dir, spoiled=True)), RUN_AT)
    return run_at_free(changes.silver_columns(rows))


@query("silver_air_valid")
def silver_air_valid(spark, sf_dir):
    current = changes.current_readings(frames.changes(spark, sf_dir, spoiled=True), RUN_AT)
    return run_at_free(changes.silver_columns(quality.accepted(current, quality.air_rules())))


@query("silver_air_quarantine")
def silver_air_quarantine(spark, sf_dir):
    current = changes.current_readings(frames.changes(spark, sf_dir, spoiled=True), RUN_AT)
    return quality.quarantine(current, quality.air_rules()).select(
        "source_cdc_event_id", "sensor_id", "reading_timestamp", "pm25", "temperature_celsius", "latitude",
        "failed_rules",
    )


@query("silver_dq_summary")
def silver_dq_summary(spark, sf_dir):
    current = changes.current_readings(frames.changes(spark, sf_dir, spoiled=True), RUN_AT)
    return current.agg(*quality.summary(quality.air_rules()))


@query("silver_data_range")
def silver_data_range(spark, sf_dir):
    return traffic_gold.data_range(frames.traffic(spark, sf_dir))


# --- gold and support tables ----------------------------------------------------------------

def air_parts(spark, sf_dir, since=None):
    return air_gold.reading_parts(frames.air(spark, sf_dir, since))


def air_hours(spark, sf_dir, since=None):
    return air_gold.sensor_hours(frames.air(spark, sf_dir, since))


def traffic_hours(spark, sf_dir):
    return traffic_gold.sensor_hours(frames.traffic(spark, sf_dir))


GOLD = {
    "gold_air_hourly": (frames.air, air_gold.hourly_by_zone),
    "gold_air_daily": (air_hours, air_gold.daily_by_zone),
    "gold_sensor_health": (air_hours, air_gold.sensor_health),
    "gold_traffic_hourly": (frames.traffic, traffic_gold.hourly_by_intersection),
    "gold_traffic_daily": (traffic_hours, traffic_gold.daily_by_road_type),
    "gold_traffic_incidents": (frames.traffic, traffic_gold.incidents),
    "gold_congestion_trends": (frames.traffic, traffic_gold.congestion_trends),
    "support_air_daily_sensor": (air_parts, air_gold.daily_by_sensor),
    "support_air_hourly_sensor": (air_parts, air_gold.hourly_by_sensor),
    "support_traffic_15m": (frames.traffic, traffic_gold.quarter_hours_by_intersection),
}

for _name, (_frame, _build) in GOLD.items():
    query(_name)(lambda spark, sf_dir, f=_frame, b=_build: b(f(spark, sf_dir)))


@query("gold_sensor_health_ties")
def gold_sensor_health_ties(spark, sf_dir):
    """All readings of a day at the same time: the event decides which one is the latest."""
    tied = frames.air(spark, sf_dir).withColumn("reading_datetime", F.date_trunc("day", "reading_datetime"))
    return air_gold.sensor_health(air_gold.sensor_hours(tied)).select(
        "date", "sensor_id", "zone", "avg_battery_level", "avg_signal_strength", "min_battery_level", "readings_count",
        "latest_status", "firmware_version", "latest_battery_level", "health_status")


@query("gold_aqi_trends")
def gold_aqi_trends(spark, sf_dir):
    rows = air_gold.aqi_trends(frames.air(spark, sf_dir))
    runs = F.transform("aqi_categories", lambda p: F.concat(p["category"], F.lit("="), p["readings"].cast("string")))
    return rows.withColumn("aqi_categories", runs)


@query("gold_aqi_category_list")
def gold_aqi_category_list(spark, sf_dir):
    """The categories of an hour and zone in the plain form, one entry per reading."""
    trends = air_gold.category_hours(air_hours(spark, sf_dir))
    return air_gold.category_list(trends).select("date", "hour", "zone", "aqi_category_list")


# --- saved reports --------------------------------------------------------------------------


def sensor_days(spark, sf_dir, since):
    return air_gold.daily_by_sensor(air_parts(spark, sf_dir, since))


def sensor_hours(spark, sf_dir, since):
    return air_gold.hourly_by_sensor(air_parts(spark, sf_dir, since))


def next_hour(stamp: dt.datetime) -> dt.datetime:
    """First whole hour at or after a bound: earlier readings belong to buckets before it."""
    whole = stamp.replace(minute=0, second=0, microsecond=0)
    return whole if whole == stamp else whole + dt.timedelta(hours=1)


def next_quarter(stamp: dt.datetime) -> dt.datetime:
    whole = stamp.replace(minute=stamp.minute - stamp.minute % 15, second=0, microsecond=0)
    return whole if whole == stamp else whole + dt.timedelta(minutes=15)


@query("aq_q1")
def aq_q1(spark, sf_dir):
    return air_reports.weekly_trend(sensor_days(spark, sf_dir, TODAY - 7 * DAY), TODAY)


@query("aq_q2")
def aq_q2(spark, sf_dir):
    return air_reports.today_by_sensor(sensor_hours(spark, sf_dir, TODAY), TODAY)


@query("aq_q3")
def aq_q3(spark, sf_dir):
    return air_reports.most_polluted_zones(sensor_hours(spark, sf_dir, next_hour(LAST_24H)), AS_OF)


@query("aq_q4")
def aq_q4(spark, sf_dir):
    candidates = frames.air_candidates(spark, sf_dir)
    health = air_gold.sensor_health(air_gold.sensor_hours(quality.accepted(candidates, quality.air_rules())))
    return air_reports.devices_needing_attention(documented.with_quality(health, candidates), TODAY)


@query("aq_q5")
def aq_q5(spark, sf_dir):
    return air_reports.week_over_week(sensor_days(spark, sf_dir, week_start(TODAY) - 7 * DAY), TODAY)


@query("aq_q6")
def aq_q6(spark, sf_dir):
    return air_reports.monthly_summary(frames.air_day_long(spark, sf_dir, months_back(LONG_AS_OF, 3)), LONG_AS_OF)


@query("aq_q7")
def aq_q7(spark, sf_dir):
    return air_reports.weather_and_aqi(sensor_days(spark, sf_dir, TODAY - 30 * DAY), TODAY)


@query("aq_q8")
def aq_q8(spark, sf_dir):
    health = air_gold.sensor_health(air_hours(spark, sf_dir, TODAY))
    return air_reports.missing_sensor_days(sensor_days(spark, sf_dir, TODAY - 7 * DAY), health, TODAY)


def hourly_traffic(spark, sf_dir, since=None):
    return traffic_gold.hourly_by_intersection(frames.traffic(spark, sf_dir, since))


def quarter_hours(spark, sf_dir, since):
    return traffic_gold.quarter_hours_by_intersection(frames.traffic(spark, sf_dir, since))


@query("tr_q1")
def tr_q1(spark, sf_dir):
    # More than 3 periods: the report's default of 10 leaves no row in the small tables.
    return traffic_reports.congestion_hotspots(
        quarter_hours(spark, sf_dir, next_quarter(LAST_24H)), AS_OF, more_than=3
    )


@query("tr_q2")
def tr_q2(spark, sf_dir):
    return traffic_reports.today_by_intersection(hourly_traffic(spark, sf_dir, TODAY), AS_OF)


@query("tr_q3")
def tr_q3(spark, sf_dir):
    return traffic_reports.daily_by_city(frames.road_day(spark, sf_dir, LONG_AS_OF - 7 * DAY), LONG_AS_OF)


@query("tr_q4")
def tr_q4(spark, sf_dir):
    return traffic_reports.rush_hours(hourly_traffic(spark, sf_dir, next_hour(AS_OF - 30 * DAY)), AS_OF)


@query("tr_q5")
def tr_q5(spark, sf_dir):
    found = traffic_gold.incidents(frames.traffic(spark, sf_dir, TODAY - 30 * DAY))
    return traffic_reports.incident_profile(found, TODAY)


@query("tr_q6")
def tr_q6(spark, sf_dir):
    return traffic_reports.congested_quarter_hours(
        quarter_hours(spark, sf_dir, next_quarter(AS_OF - 7 * DAY)), AS_OF
    )


@query("tr_q7")
def tr_q7(spark, sf_dir):
    return traffic_reports.weekday_against_weekend(frames.road_day(spark, sf_dir, LONG_AS_OF - 30 * DAY), LONG_AS_OF)


@query("tr_q8")
def tr_q8(spark, sf_dir):
    since = TODAY - 90 * DAY
    found = traffic_gold.incidents(frames.traffic(spark, sf_dir, since))
    return traffic_reports.dangerous_intersections(found, hourly_traffic(spark, sf_dir, since), TODAY)


@query("tr_q9")
def tr_q9(spark, sf_dir):
    return traffic_reports.flow_efficiency(hourly_traffic(spark, sf_dir, next_hour(AS_OF - 30 * DAY)), AS_OF)


@query("tr_q10")
def tr_q10(spark, sf_dir):
    return traffic_reports.monthly_growth(frames.road_day(spark, sf_dir, months_back(LONG_AS_OF, 6)), LONG_AS_OF)


# --- documented queries and metrics ---------------------------------------------------------


def zone_hours(spark, sf_dir, since=None):
    return air_gold.hourly_by_zone(frames.air(spark, sf_dir, since))


def zone_days(spark, sf_dir):
    return air_gold.daily_by_zone(air_hours(spark, sf_dir))


@query("doc_q1")
def doc_q1(spark, sf_dir):
    return air_reports.worst_hours(zone_hours(spark, sf_dir, next_hour(LAST_24H)), AS_OF)


@query("doc_q2")
def doc_q2(spark, sf_dir):
    hourly = documented.hourly_congestion(frames.traffic(spark, sf_dir, next_hour(LAST_24H)))
    return documented.congested_hours(hourly, AS_OF)


@query("doc_q3")
def doc_q3(spark, sf_dir):
    since = next_hour(LAST_24H)
    hourly = documented.hourly_congestion(frames.traffic(spark, sf_dir, since))
    return documented.air_with_traffic(zone_hours(spark, sf_dir, since), hourly, AS_OF)


@query("doc_aqi_change")
def doc_aqi_change(spark, sf_dir):
    return documented.aqi_change(zone_days(spark, sf_dir))


@query("doc_aqi_alerts")
def doc_aqi_alerts(spark, sf_dir):
    return documented.aqi_alerts(zone_days(spark, sf_dir))


@query("doc_unhealthy_streak")
def doc_unhealthy_streak(spark, sf_dir):
    # A limit that some days miss, so that runs end.
    return documented.unhealthy_streaks(zone_days(spark, sf_dir), above=190)


@query("doc_sequences_carried")
def doc_sequences_carried(spark, sf_dir):
    """Streaks and changes over years in three stored periods, each built from its own days and one row per zone before it."""
    base = scratch_dir(spark, "sequences")
    days = frames.air_day_long(spark, sf_dir).select(
        "date", F.lit("all").alias("city"), "zone", rounded("avg_aqi", 0).cast("int").alias("daily_max_aqi"))
    days.write.parquet(f"{base}/days")
    days = tables.read_parquet(spark, f"{base}/days", days.schema)
    state = spark.createDataFrame([], documented.SEQUENCE_STATE)
    edges = (dt.date(1900, 1, 1), dt.date(1994, 6, 12), dt.date(1996, 3, 1), dt.date(2100, 1, 1))
    for number, (first, end) in enumerate(zip(edges, edges[1:])):
        period = days.filter((F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(end)))
        documented.zone_sequences(period, state, above=99).write.parquet(f"{base}/sequences/period={number}")
        rows = tables.read_parquet(spark, f"{base}/sequences/period={number}")
        documented.closing_state(rows, state).write.parquet(f"{base}/state/period={number}")
        state = tables.read_parquet(spark, f"{base}/state/period={number}", documented.SEQUENCE_STATE)
    return tables.read_parquet(spark, f"{base}/sequences").drop("period")


@query("doc_good_air_pct")
def doc_good_air_pct(spark, sf_dir):
    return documented.good_air_share(zone_hours(spark, sf_dir))


@query("doc_sensor_health")
def doc_sensor_health(spark, sf_dir):
    candidates = frames.air_candidates(spark, sf_dir)
    health = air_gold.sensor_health(air_gold.sensor_hours(quality.accepted(candidates, quality.air_rules())))
    return documented.documented_sensor_health(health, candidates)


@query("doc_congestion_change")
def doc_congestion_change(spark, sf_dir):
    return documented.congestion_change(frames.traffic(spark, sf_dir))


@query("doc_severity")
def doc_severity(spark, sf_dir):
    return documented.documented_incidents(frames.traffic(spark, sf_dir))


@query("doc_congestion_level")
def doc_congestion_level(spark, sf_dir):
    return documented.daily_congestion(frames.traffic(spark, sf_dir))


@query("doc_dq_air")
def doc_dq_air(spark, sf_dir):
    rows = frames.air_candidates(spark, sf_dir)
    return quality.rule_report(rows, quality.documented_air_rules(rows.columns), quality.unchecked_air_ranges(rows.columns))


@query("doc_dq_traffic")
def doc_dq_traffic(spark, sf_dir):
    return quality.rule_report(frames.traffic(spark, sf_dir), quality.documented_traffic_rules())


@query("doc_gold_constraints")
def doc_gold_constraints(spark, sf_dir):
    checked = {
        "air_quality_hourly_avg": (zone_hours(spark, sf_dir), "hour_timestamp", 60),
        "traffic_congestion_trends": (
            traffic_gold.congestion_trends(frames.traffic(spark, sf_dir)), "time_window_start", 15,
        ),
    }
    reports = [
        quality.rule_report(gold, quality.gold_rules(stamp, "reading_count", AS_OF, minutes)).withColumn(
            "gold_table", F.lit(name)
        )
        for name, (gold, stamp, minutes) in checked.items()
    ]
    return reports[0].unionByName(reports[1])


@query("air_aqi_index")
def air_aqi_index(spark, sf_dir):
    rows = frames.air(spark, sf_dir).select(
        "event_id", "pm25", "pm10",
        air_index.pm25_index(F.col("pm25")).alias("aqi_pm25"),
        air_index.pm10_index(F.col("pm10")).alias("aqi_pm10"),
    )
    overall = air_index.overall_index(F.col("aqi_pm25"), F.col("aqi_pm10"))
    return rows.withColumn("overall_aqi", overall).withColumn(
        "aqi_category", air_index.index_category(F.col("overall_aqi"))
    )


@query("traffic_classify")
def traffic_classify(spark, sf_dir):
    vehicles, speed = F.col("vehicle_count"), F.col("avg_speed_mph")
    return frames.traffic(spark, sf_dir).select(
        "event_id", "vehicle_count", "avg_speed_mph",
        classify.congestion_level(vehicles).alias("congestion_level"),
        classify.flow_band(vehicles, speed).alias("flow_band"),
        classify.incident_candidate(vehicles, speed).alias("incident_candidate"),
    )


# --- streams --------------------------------------------------------------------------------

# Times at which the feed is cut into arrivals.
CUTS = (dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21))


def arrivals(silver: DataFrame, *, held_back: bool = False) -> list[DataFrame]:
    """Three arrivals in time order that together hold every reading, with repeats.

    Each arrival repeats one in ten of its own readings, and one in ten of the arrival before it;
    by then those are late. With ``held_back`` some readings of the day before the first cut arrive
    only at the end, weeks late.
    """
    edges = [None, *CUTS, None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        part = silver
        if low is not None:
            part = part.filter(f"reading_datetime >= timestamp '{low}'")
        if high is not None:
            part = part.filter(f"reading_datetime < timestamp '{high}'")
        parts.append(part)

    def ending(rows: DataFrame, digit: str) -> DataFrame:
        return rows.filter(F.col("event_id").endswith(digit))

    landed = [part.unionByName(ending(part, "0")) for part in parts]
    landed[1:] = [later.unionByName(ending(before, "0")) for later, before in zip(landed[1:], parts)]
    if held_back:
        is_late = F.col("event_id").endswith("5") & F.expr(f"reading_datetime >= timestamp '{CUTS[0] - DAY}'")
        landed[0] = landed[0].filter(~is_late)
        landed[-1] = landed[-1].unionByName(parts[0].filter(is_late))
    return landed


@contextmanager
def state_per_core(spark: SparkSession):
    """One state store per core of the cluster. A stream keeps the number it was started with."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stream_arrivals(spark, sf_dir, run, *, closing: bool = False, held_back: bool = False) -> str:
    """Land the arrivals one after the other and run the stream after each; returns its output path."""
    base = scratch_dir(spark, "stream")
    silver = frames.traffic(spark, sf_dir)
    parts = arrivals(silver, held_back=held_back)
    if closing:
        # One reading after all others closes every window before it. One with a broken clock comes first.
        one = silver.agg(*(F.max(c).alias(c) for c in silver.columns))

        def dated(when: dt.datetime, event: str) -> DataFrame:
            return one.withColumns({"reading_datetime": moment(when), "event_id": F.lit(event)}).select(*silver.columns)

        parts.append(dated(RUN_AT + dt.timedelta(minutes=30), "closing"))
        parts[0] = parts[0].unionByName(dated(dt.datetime(2099, 1, 1), "future"))
    for part in parts:
        land(frames.traffic_records(part), f"{base}/landing")
        with state_per_core(spark):
            run(f"{base}/landing", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return f"{base}/out"


def landed(spark, path):
    return stream.project_traffic(tables.stream_jsonl(spark, path, schemas.BRONZE_TRAFFIC), RUN_AT)


@query("st_traffic_silver")
def st_traffic_silver(spark, sf_dir):
    def run(landing, to, progress):
        return stream.run_silver(spark, landing, to, progress, RUN_AT)

    out = stream_arrivals(spark, sf_dir, run, held_back=True)
    return run_at_free(tables.read_parquet(spark, out, schemas.SILVER_TRAFFIC))


@query("st_broker_records")
def st_broker_records(spark, sf_dir):
    """Silver from a stream of messages instead of a landing folder; each has a record in its value."""
    def run(landing, to, progress):
        messages = spark.readStream.schema("value string").text(landing).withColumn("value", F.col("value").cast("binary"))
        return stream.run_silver(spark, stream.records_of(messages), to, progress, RUN_AT)

    return run_at_free(tables.read_parquet(spark, stream_arrivals(spark, sf_dir, run), schemas.SILVER_TRAFFIC))


@query("st_dedup")
def st_dedup(spark, sf_dir):
    def run(landing, to, checkpoint):
        first = stream.deduplicated(landed(spark, landing)).select("event_id", "sensor_id", "reading_datetime")
        return stream.start_parquet(first, to, checkpoint)

    return tables.read_parquet(spark, stream_arrivals(spark, sf_dir, run))


@query("st_enrich")
def st_enrich(spark, sf_dir):
    def run(landing, to, checkpoint):
        unknown = {"latitude": "double", "longitude": "double", "road_type": "string"}
        bare = landed(spark, landing).withColumns({c: F.lit(None).cast(t) for c, t in unknown.items()})
        found = stream.located(bare).select("event_id", "intersection", *unknown)
        return stream.start_parquet(found, to, checkpoint)

    return tables.read_parquet(spark, stream_arrivals(spark, sf_dir, run))


@query("st_congestion_15m")
def st_congestion_15m(spark, sf_dir):
    def run(landing, to, checkpoint):
        return stream.run_congestion(spark, landing, to, checkpoint, RUN_AT)

    closed = tables.read_parquet(spark, stream_arrivals(spark, sf_dir, run, closing=True))
    return closed.filter(F.col("time_window_start") < moment(RUN_AT))


@query("st_traffic_rejected")
def st_traffic_rejected(spark, sf_dir):
    """Three kinds of bad readings and a line that is no record, as the stream leaves them with their reasons."""
    base = scratch_dir(spark, "rejected")
    kind = F.regexp_extract("event_id", "[0-9]+", 0).cast("long") % 40
    spoiled = frames.traffic(spark, sf_dir).withColumns({
        "avg_speed_mph": F.when(kind == 0, F.lit(500.0)).otherwise(F.col("avg_speed_mph")),
        "reading_datetime": F.when(kind == 1, moment(dt.datetime(2099, 1, 1))).otherwise(F.col("reading_datetime")),
        "congestion_level": F.when(kind == 2, F.lit("jam")).otherwise(F.col("congestion_level")),
    })
    frames.traffic_records(spoiled).write.json(f"{base}/landing")
    spark.createDataFrame([("{broken",)], "line string").write.mode("append").text(f"{base}/landing")
    stream.run_silver(spark, f"{base}/landing", f"{base}/silver", f"{base}/progress", RUN_AT,
                      rejected_path=f"{base}/rejected").awaitTermination()
    return tables.read_parquet(spark, f"{base}/rejected").select("record_id", "reason")


@query("st_incremental_bronze")
def st_incremental_bronze(spark, sf_dir):
    """Arrivals by kind of change, so that later versions meet days already written."""
    base = scratch_dir(spark, "incremental")
    feed = frames.changes(spark, sf_dir, spoiled=True)
    for kinds in (["MODIFY"], ["INSERT", "REMOVE"]):
        land(feed.filter(F.col("cdc_event_type").isin(kinds)), f"{base}/bronze")
        air_changes.run_incremental(spark, f"{base}/bronze", f"{base}/silver", f"{base}/progress", RUN_AT).awaitTermination()
    return run_at_free(air_changes.silver_from_state(spark, f"{base}/silver"))


@query("st_late_windows")
def st_late_windows(spark, sf_dir):
    """15-minute windows over arrivals of which some are weeks late: each window ends up with all its readings."""
    def run(landing, to, progress):
        stream.run_silver(spark, landing, f"{to}-silver", f"{progress}/silver", RUN_AT).awaitTermination()
        return windows.run_quarters(spark, f"{to}-silver", to, f"{progress}/quarters")

    out = stream_arrivals(spark, sf_dir, run, held_back=True)
    return traffic_gold.trend_quarters(tables.read_parquet(spark, out, windows.quarter_schema(spark)))


@query("st_sensor_sketches")
def st_sensor_sketches(spark, sf_dir):
    """Sensors per day and road type from the stream's merged sketches, held against the exact number."""
    def run(landing, to, checkpoint):
        return stream.run_sensor_sketches(spark, landing, to, checkpoint, RUN_AT)

    sketches = tables.read_parquet(spark, stream_arrivals(spark, sf_dir, run, closing=True))
    keys = ("year", "month", "day", "road_type")
    estimated = traffic_gold.unique_sensors(sketches.filter(F.col("time_window_start") < moment(RUN_AT)), *keys)
    exact = frames.traffic(spark, sf_dir).groupBy(*keys).agg(F.count_distinct("sensor_id").alias("exact"))
    off = F.abs(F.col("unique_sensors") - F.col("exact"))
    return exact.join(estimated, list(keys), "left").select(
        *keys, "exact", (off <= F.greatest(F.lit(1.0), F.col("exact") * traffic_gold.SKETCH_ERROR)).alias("within_error"))


@query("st_batch_metrics")
def st_batch_metrics(spark, sf_dir):
    """Lines and verdicts of each batch of both streams, as the batches have noted them."""
    base = scratch_dir(spark, "metrics")
    kind = F.regexp_extract("event_id", "[0-9]+", 0).cast("long")
    spoiled = frames.traffic(spark, sf_dir).withColumns({
        "avg_speed_mph": F.when(kind % 40 == 0, F.lit(500.0)).otherwise(F.col("avg_speed_mph")),
        "congestion_level": F.when(kind % 40 < 2, F.lit("jam")).otherwise(F.col("congestion_level")),
    })
    feed = frames.changes(spark, sf_dir, spoiled=True)
    for number, kinds in enumerate((["MODIFY"], ["INSERT", "REMOVE"])):
        land(frames.traffic_records(spoiled.filter(kind % 2 == number)), f"{base}/landing")
        stream.run_silver(spark, f"{base}/landing", f"{base}/silver", f"{base}/progress", RUN_AT,
                          metrics_path=f"{base}/metrics").awaitTermination()
        land(feed.filter(F.col("cdc_event_type").isin(kinds)), f"{base}/bronze")
        air_changes.run_incremental(spark, f"{base}/bronze", f"{base}/state", f"{base}/air-progress", RUN_AT,
                                    metrics_path=f"{base}/metrics").awaitTermination()
    rows = metrics.read_metrics(spark, f"{base}/metrics")
    return rows.select(
        "stream", "number", "rows_in", "rows_valid", "rows_rejected",
        *(F.coalesce(F.col("failed")[rule], F.lit(0)).cast("bigint").alias(rule) for rule in ("avg_speed_mph", "congestion_level", "pm25")))


# --- jobs from end to end -------------------------------------------------------------------


@query("job_air")
def job_air(spark, sf_dir):
    """Bronze files to silver to gold; the daily summary as the job leaves it on disk."""
    base = scratch_dir(spark, "job")
    land_changes(spark, sf_dir, f"{base}/bronze")
    jobs.bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver", RUN_AT)
    jobs.air_silver_to_gold(spark, f"{base}/silver", f"{base}/gold", RUN_AT)
    return tables.read_parquet(spark, f"{base}/gold/air_quality_daily_summary").drop("processed_at")


@query("job_traffic")
def job_traffic(spark, sf_dir):
    """Silver to gold; the daily summary as the job leaves it on disk, built from the stored rollup."""
    base = scratch_dir(spark, "job")
    silver = frames.traffic(spark, sf_dir).withColumn("silver_processed_at", F.lit(None).cast("timestamp"))
    # The hour stays a column here: folders by hour only add files to small tables.
    tables.write_parquet(silver.select(*schemas.SILVER_TRAFFIC.names), f"{base}/silver")
    jobs.traffic_silver_to_gold(spark, f"{base}/silver", f"{base}/gold", RUN_AT)
    return tables.read_parquet(spark, f"{base}/gold/traffic_daily_summary").drop("processed_at")


@query("job_gold_ledger")
def job_gold_ledger(spark, sf_dir):
    """Gold by the ledger alone. The second arrival is stamped before the first gold run and finished after it."""
    base = scratch_dir(spark, "ledger")
    feed = frames.changes(spark, sf_dir, spoiled=True)
    arrivals_at = ((["MODIFY"], RUN_AT), (["INSERT", "REMOVE"], RUN_AT - DAY))
    for kinds, stamped in arrivals_at:
        land(feed.filter(F.col("cdc_event_type").isin(kinds)), f"{base}/bronze")
        air_changes.run_incremental(spark, f"{base}/bronze", f"{base}/state", f"{base}/progress", stamped,
                                    ledger_path=f"{base}/ledger").awaitTermination()
        ledger.run_gold(spark, jobs.AIR, lambda s: air_changes.silver_from_state(s, f"{base}/state"), f"{base}/gold",
                        f"{base}/ledger", f"{base}/gold-progress", RUN_AT).awaitTermination()
    return tables.read_parquet(spark, f"{base}/gold/air_quality_daily_summary").drop("processed_at")


def row_digest(values: dict[str, tuple[Column, T.DataType]]) -> tuple[Column, Column]:
    """Two numbers of 64 bits that tell rows apart by all their values; other rows share both with a chance of 2^-128.

    A hash passes over NULL, so it also gets which values are. Lists and structs are taken as text, doubles as they are.
    """
    atoms = [value if isinstance(kind, T.AtomicType) else F.to_json(value) for value, kind in values.values()]
    missing = [value.isNull() for value, _ in values.values()]
    return F.xxhash64(*atoms, *missing), F.xxhash64(F.lit("other half"), *atoms, *missing)


def refreshed(spark: SparkSession, domain, silver: DataFrame, changed: DataFrame, changed_days) -> DataFrame:
    """Gold built from ``silver`` and refreshed for some days of ``changed``: rows per table, month and day, and how many
    of them a rebuild from ``changed`` has as well, with all their values.
    """
    base = scratch_dir(spark, "refresh")
    names = jobs.build_gold(silver, f"{base}/kept", domain, RUN_AT)
    assert jobs.build_gold(changed, f"{base}/kept", domain, RUN_AT, days=changed_days) == names
    jobs.build_gold(changed, f"{base}/rebuilt", domain, RUN_AT)
    counts = None
    for table in (domain.rollup, *domain.tables):
        schema = jobs.gold_schema(spark, domain, table)
        values = {f.name: (rounded(F.col(f.name), 6) if isinstance(f.dataType, T.DoubleType) else F.col(f.name), f.dataType)
                  for f in schema.fields if f.name != "processed_at"}
        row, again = row_digest(values)
        day = F.col("day") if "day" in schema.names else F.lit(None).cast("int").alias("day")
        both = None
        for place, kept in (("kept", 1), ("rebuilt", 0)):
            rows = tables.read_parquet(spark, f"{base}/{place}/{table.name}", schema).select(
                "year", "month", day, row.alias("row"), again.alias("again"), F.lit(kept).alias("kept"))
            both = rows if both is None else both.unionByName(rows)
        each = both.groupBy("year", "month", "day", "row", "again").agg(
            F.sum("kept").alias("here"), F.count_if(F.col("kept") == 0).alias("there"))
        count = each.groupBy("year", "month", "day").agg(
            F.sum("here").alias("n_rows"), F.sum(F.least("here", "there")).alias("n_as_rebuilt"),
            F.sum("there").alias("n_rebuilt")).withColumn("table_name", F.lit(table.name))
        counts = count if counts is None else counts.unionByName(count)
    return counts


REFRESHED = (dt.date(2024, 1, 10), dt.date(2024, 1, 11), dt.date(2024, 1, 12))


def after_corrections(rows: DataFrame) -> DataFrame:
    """The first refreshed day loses all readings, the second its incidents, the third half of its readings."""
    day = F.to_date("reading_datetime")
    kept = rows.filter((day != F.lit(REFRESHED[0])) & ~((day == F.lit(REFRESHED[2])) & (F.hour("reading_datetime") < 12)))
    if "incident_detected" in rows.columns:
        calm = day == F.lit(REFRESHED[1])
        kept = kept.withColumn("incident_detected", F.col("incident_detected") & ~calm)
    return kept


@query("job_air_refresh")
def job_air_refresh(spark, sf_dir):
    silver = frames.air(spark, sf_dir)
    return refreshed(spark, jobs.AIR, silver, after_corrections(silver), REFRESHED)


@query("job_traffic_refresh")
def job_traffic_refresh(spark, sf_dir):
    silver = frames.traffic(spark, sf_dir)
    return refreshed(spark, jobs.TRAFFIC, silver, after_corrections(silver), REFRESHED)


# --- saved reports by name ------------------------------------------------------------------

_DATABASES: dict[tuple[str, str], str] = {}


def gold_database(spark: SparkSession, sf_dir: str) -> str:
    """Gold tables of both domains in the catalog, built once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DATABASES:
        base = scratch_dir(spark, "saved")
        name = f"saved_gold_{len(_DATABASES)}"
        candidates = frames.air_candidates(spark, sf_dir)
        for silver, domain in ((quality.accepted(candidates, quality.air_rules()), jobs.AIR),
                               (frames.traffic(spark, sf_dir), jobs.TRAFFIC)):
            jobs.build_gold(silver, f"{base}/bad", domain, RUN_AT)
            jobs.register_gold(spark, f"{name}_bad", f"{base}/bad", domain)
        jobs.build_gold(frames.air(spark, sf_dir), f"{base}/all", jobs.AIR, RUN_AT)
        jobs.register_gold(spark, name, f"{base}/all", jobs.AIR)
        jobs.register_gold(spark, name, f"{base}/bad", jobs.TRAFFIC)
        jobs.store_quality(candidates, f"{base}/bad", RUN_AT, f"{name}_bad")
        _DATABASES[key] = name
    return _DATABASES[key]


SAVED = (
    "weekly_trend", "today_by_sensor", "most_polluted_zones", "devices_needing_attention", "week_over_week",
    "monthly_summary", "weather_and_aqi", "missing_sensor_days", "worst_hours", "congested_hours", "air_with_traffic",
    "congestion_hotspots", "today_by_intersection", "daily_by_city", "rush_hours", "incident_profile", "congested_quarter_hours", "weekday_against_weekend",
    "dangerous_intersections", "flow_efficiency", "monthly_growth",
)
assert set(SAVED) == set(saved.REPORTS)


def saved_report(name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        database = gold_database(spark, sf_dir)
        # Only the report on devices is about readings of which some break the rules.
        return saved.run_report(spark, f"{database}_bad" if name == "devices_needing_attention" else database, name, AS_OF)

    return build


for _name in SAVED:
    query(f"saved_{_name}")(saved_report(_name))

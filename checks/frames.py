"""Driver tables as domain frames: the inputs of the registered queries.

Every frame is a projection of a whole table. ``since`` is the lower time bound a report asks for;
it is applied to the raw column, so that it reaches the Parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbsight import schemas
from curbsight.functions.air import index_category, pm25_index
from curbsight.functions.places import CITY, COUNTRY, INTERSECTIONS, ZONES
from curbsight.functions.traffic import congestion_level

AS_OF = dt.datetime(2024, 1, 30, 23, 59, 59)
LONG_AS_OF = dt.date(2001, 8, 1)
RUN_AT = dt.datetime(2024, 1, 31, 0, 30, 0)

# Order in which users map to zones.
ZONE_ORDER = ("downtown", "midtown", "uptown", "industrial", "residential")
ZONE_PLACE = {name: (lat, lon) for name, lat, lon in ZONES}


# Declared, so that no query spends a job on reading footers first.
_SCHEMAS = {
    "events": T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
    ]),
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]),
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_nationkey", T.IntegerType()),
    ]),
    "nation": T.StructType([
        T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_regionkey", T.IntegerType()),
    ]),
    "region": T.StructType([
        T.StructField("r_regionkey", T.IntegerType()), T.StructField("r_name", T.StringType()),
    ]),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def pick(index: str, values: list) -> str:
    """SQL text that looks up a 0-based index in a constant list."""
    shown = ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}D" for v in values)
    return f"element_at(array({shown}), cast({index} + 1 as int))"


def events(spark: SparkSession, sf_dir: str, since: dt.datetime | dt.date | None = None) -> DataFrame:
    raw = table(spark, sf_dir, "events")
    if since is not None:
        raw = raw.filter(f"ts >= timestamp_ntz '{since}'")
    return raw.selectExpr(
        "event_id", "user_id", "event_type", "value", "cast(ts as timestamp) as ts",
        "cast(get_json_object(props, '$.k') as int) as k",
    )


def iso(stamp: str) -> str:
    return f"concat(date_format({stamp}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00')"


_DATE_PARTS = ("year(ts) as year", "month(ts) as month", "day(ts) as day")


def air(spark: SparkSession, sf_dir: str, since: dt.datetime | dt.date | None = None) -> DataFrame:
    """Silver air quality: one reading per event."""
    zone = "user_id % 5"
    rows = events(spark, sf_dir, since).selectExpr(
        "event_id",
        "concat('AQ_', lpad(cast(user_id as string), 8, '0')) as sensor_id",
        f"{iso('ts')} as reading_timestamp",
        "ts as reading_datetime",
        "'air_quality' as sensor_type",
        f"{pick(zone, [ZONE_PLACE[z][0] for z in ZONE_ORDER])} as latitude",
        f"{pick(zone, [ZONE_PLACE[z][1] for z in ZONE_ORDER])} as longitude",
        f"{pick(zone, list(ZONE_ORDER))} as zone",
        f"'{CITY}' as city",
        f"'{COUNTRY}' as country",
        "value as pm25",
        "value * 1.4D as pm10",
        "400D + k as co2",
        "10D + 0.3D * k as no2",
        "20D + 0.4D * k as o3",
        "0.5D * k - 5D as temperature_celsius",
        "30D + 0.5D * k as humidity_percent",
        "1003D + 0.2D * k as pressure_hpa",
        "if(event_id % 20 = 7, 'maintenance', 'active') as device_status",
        "k as battery_level",
        "-30 - k % 50 as signal_strength_dbm",
        "concat('2.1.', cast(k % 5 as string)) as firmware_version",
        "date '2024-01-10' as calibration_date",
        "'synthetic_iot' as data_source",
        "cast(event_id as string) as source_cdc_event_id",
        *_DATE_PARTS,
    )
    return rows.withColumn("aqi_value", pm25_index(F.col("pm25"))).withColumn(
        "aqi_category", index_category(F.col("aqi_value"))
    )


def with_defects(rows: DataFrame) -> DataFrame:
    """One reading in fifty of each kind of defect; the others are left as they are."""
    kind = F.col("event_id") % 50
    nothing = F.lit(None)

    def spoil(n: int, column: str, bad: Column) -> Column:
        return F.when(kind == n, bad).otherwise(F.col(column))

    pm25 = (
        F.when(kind == 0, nothing.cast("double"))
        .when(kind == 1, F.lit(-1.0))
        .when(kind == 2, F.lit(999.0))
        .otherwise(F.col("pm25"))
    )
    return rows.withColumns({
        "pm25": pm25,
        "temperature_celsius": spoil(3, "temperature_celsius", F.lit(75.0)),
        "latitude": spoil(4, "latitude", F.lit(95.0)),
        "sensor_id": spoil(5, "sensor_id", nothing.cast("string")),
    })


def air_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings before the quality rules, some of them spoiled."""
    return with_defects(air(spark, sf_dir))


def changes(spark: SparkSession, sf_dir: str, *, spoiled: bool = False) -> DataFrame:
    """Bronze change feed: a first change for every event, later versions for some.

    Every event is inserted, or removed if its number ends in 09, 29, ...; numbers ending in 0 are
    modified later (value + 1), and 10, 30, ... removed after that. With ``spoiled`` the first
    versions carry the defects above and the modification of every 50th event from 20 on is invalid.
    """
    base = air(spark, sf_dir).withColumn("clean_pm25", F.col("pm25"))
    n = F.col("event_id")
    first = with_defects(base) if spoiled else base
    # Versions are made per event by a generator, so the table is read once.
    modified_pm25 = F.when((n % 50 == 20) & F.lit(spoiled), F.lit(-5.0)).otherwise(F.col("clean_pm25") + 1)
    versions = F.array_compact(
        F.array(
            F.struct(
                F.when(n % 20 == 9, "REMOVE").otherwise("INSERT").alias("kind"),
                (n + 1).alias("seq"),
                F.col("pm25").alias("pm25"),
                F.lit(True).alias("is_first"),
            ),
            F.when(
                n % 10 == 0,
                F.struct(
                    F.lit("MODIFY").alias("kind"),
                    (n + 100000001).alias("seq"),
                    modified_pm25.alias("pm25"),
                    F.lit(False).alias("is_first"),
                ),
            ),
            F.when(
                n % 20 == 10,
                F.struct(
                    F.lit("REMOVE").alias("kind"),
                    (n + 200000001).alias("seq"),
                    F.col("clean_pm25").alias("pm25"),
                    F.lit(False).alias("is_first"),
                ),
            ),
        )
    )
    rows = first.withColumn("v", F.explode(versions))
    return _envelopes(rows)


def _envelopes(rows: DataFrame) -> DataFrame:
    text = lambda c: F.col(c).cast("string")  # noqa: E731 - a short alias reads best here
    stamp = "reading_timestamp"
    image = F.struct(
        F.col("sensor_id").alias("sensor_id"),
        F.col(stamp).alias("timestamp"),
        F.concat(F.lit("evt_"), text("event_id")).alias("event_id"),
        F.col("sensor_type").alias("sensor_type"),
        F.struct(
            text("latitude").alias("lat"), text("longitude").alias("lon"), F.col("zone").alias("zone"),
            F.col("city").alias("city"), F.col("country").alias("country"),
        ).alias("location"),
        F.struct(
            F.col("v.pm25").cast("string").alias("pm25"), text("pm10").alias("pm10"), text("co2").alias("co2"),
            text("no2").alias("no2"), text("o3").alias("o3"),
            text("temperature_celsius").alias("temperature"),
            text("humidity_percent").alias("humidity"), text("pressure_hpa").alias("pressure"),
        ).alias("measurements"),
        F.struct(text("aqi_value").alias("value"), F.col("aqi_category").alias("category")).alias("aqi"),
        F.struct(
            F.col("device_status").alias("device_status"), text("battery_level").alias("battery_level"),
            text("signal_strength_dbm").alias("signal_strength"),
            F.col("firmware_version").alias("firmware_version"),
            F.lit("2024-01-10T00:00:00Z").alias("last_calibration"),
        ).alias("metadata"),
        F.col(stamp).alias("created_at"),
        F.col(stamp).alias("updated_at"),
        F.lit(True).alias("is_active"),
        F.col("data_source").alias("data_source"),
    ).cast(schemas.AIR_DOCUMENT)
    kind = F.col("v.kind")
    live = kind != "REMOVE"

    def lift(value: Column) -> Column:
        return F.when(live, value)

    return rows.select(
        F.concat(F.lit("chg_"), F.col("v.seq").cast("string")).alias("cdc_event_id"),
        kind.alias("cdc_event_type"),
        F.expr(iso("reading_datetime + INTERVAL 5 SECONDS")).alias("cdc_timestamp"),
        F.lit("dynamodb-streams").alias("cdc_source"),
        F.col("v.seq").cast("string").alias("cdc_sequence_number"),
        F.lit(512).cast("bigint").alias("cdc_size_bytes"),
        F.lit("us-east-1").alias("aws_region"),
        F.lit("table/air_quality").alias("table_arn"),
        *(
            F.date_format("reading_datetime", code).alias(f"partition_{part}")
            for part, code in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))
        ),
        F.struct(F.col("sensor_id").alias("sensor_id"), F.col(stamp).alias("timestamp")).alias("keys"),
        F.when(~F.col("v.is_first") | ~live, image).alias("old_image"),
        lift(image).alias("new_image"),
        lift(F.col("sensor_id")).alias("sensor_id"),
        lift(F.col("sensor_type")).alias("sensor_type"),
        lift(F.col(stamp)).alias("sensor_timestamp"),
        lift(F.col("zone")).alias("zone"),
        lift(F.col("v.pm25").cast("string")).alias("pm25"),
        lift(text("temperature_celsius")).alias("temperature"),
        lift(text("aqi_value")).alias("aqi_value"),
    )


def traffic(spark: SparkSession, sf_dir: str, since: dt.datetime | dt.date | None = None) -> DataFrame:
    """Silver traffic: one reading per event."""
    site = "user_id % 8"
    rows = events(spark, sf_dir, since).selectExpr(
        "concat('TR_', lpad(cast(user_id as string), 8, '0')) as sensor_id",
        "ts as reading_datetime",
        "concat('TRF_', cast(event_id as string)) as event_id",
        f"{pick(site, [s[1] for s in INTERSECTIONS])} as latitude",
        f"{pick(site, [s[2] for s in INTERSECTIONS])} as longitude",
        f"{pick(site, [s[0] for s in INTERSECTIONS])} as intersection",
        f"{pick(site, [s[3] for s in INTERSECTIONS])} as road_type",
        f"'{CITY}' as city",
        f"'{COUNTRY}' as country",
        "k as vehicle_count",
        "least(value, 65D) as avg_speed_mph",
        "cast(event_id % 31 as int) as pedestrian_count",
        "cast(event_id % 11 as int) as bike_count",
        "cast(k as double) as occupancy_percent",
        "greatest(0D, (70D - least(value, 65D)) * 2) as queue_length_meters",
        "100 - k as traffic_flow_score",
        "event_type = 'error' as incident_detected",
        "'active' as device_status",
        "-30 - k % 50 as signal_strength_dbm",
        "'3.2.1' as firmware_version",
        "'synthetic_streaming' as data_source",
        "'kinesis_stream' as ingestion_type",
        *_DATE_PARTS,
        "hour(ts) as hour",
    )
    return rows.withColumn("congestion_level", congestion_level(F.col("vehicle_count")))


def traffic_records(silver: DataFrame) -> DataFrame:
    """Silver traffic back in the nested form in which records land."""
    text = lambda c: F.col(c).cast("string")

    def group(*names: tuple[str, str]) -> Column:
        return F.struct(*(text(c).alias(n) for n, c in names))

    return silver.select(
        "sensor_id",
        F.expr(iso("reading_datetime")).alias("timestamp"),
        "event_id",
        F.lit("traffic").alias("sensor_type"),
        group(
            ("lat", "latitude"), ("lon", "longitude"), ("intersection", "intersection"),
            ("road_type", "road_type"), ("city", "city"), ("country", "country"),
        ).alias("location"),
        group(*((c, c) for c in (
            "vehicle_count", "avg_speed_mph", "congestion_level", "pedestrian_count", "bike_count",
            "occupancy_percent", "queue_length_meters",
        ))).alias("measurements"),
        text("traffic_flow_score").alias("traffic_flow_score"),
        "incident_detected",
        group(
            ("device_status", "device_status"), ("signal_strength", "signal_strength_dbm"),
            ("firmware_version", "firmware_version"),
        ).alias("metadata"),
        F.expr(iso("reading_datetime")).alias("created_at"),
        "data_source",
        "ingestion_type",
    )


_ROAD = """case substr(o_orderpriority, 1, 1) when '1' then 'highway' when '2' then 'major'
           when '3' then 'arterial' else 'local' end as road_type"""


def _customer_days(spark: SparkSession, sf_dir: str, since: dt.date | None, keys: list[str], sums: list[Column]) -> DataFrame:
    """Orders summed per day and customer, with the customer's region.

    Summing first keeps a customer with very many orders from travelling whole to one join task.
    """
    orders = table(spark, sf_dir, "orders")
    if since is not None:
        orders = orders.filter(f"o_orderdate >= timestamp_ntz '{since}'")
    per_customer = (
        orders.selectExpr("cast(o_orderdate as date) as date", "o_custkey", "o_orderkey", "o_orderstatus", _ROAD)
        .groupBy("date", "o_custkey", *keys)
        .agg(F.count(F.lit(1)).alias("n"), *sums)
    )
    # Nations and regions are 25 and 5 rows at every scale; customers grow, so Spark decides there.
    places = F.broadcast(
        table(spark, sf_dir, "nation")
        .join(F.broadcast(table(spark, sf_dir, "region")), F.expr("n_regionkey = r_regionkey"))
        .select("n_nationkey", "r_name")
    )
    customers = (
        table(spark, sf_dir, "customer").join(places, F.expr("c_nationkey = n_nationkey")).select("c_custkey", "r_name")
    )
    return per_customer.join(customers, F.expr("o_custkey = c_custkey"))


def road_day(spark: SparkSession, sf_dir: str, since: dt.date | None = None) -> DataFrame:
    """Daily traffic over years, from orders."""
    sums = [F.expr("sum(10 + o_orderkey % 50) as speed"), F.expr("count_if(o_orderstatus = 'F') as incidents")]
    rows = _customer_days(spark, sf_dir, since, ["road_type"], sums)
    return rows.groupBy("date", F.col("r_name").alias("city"), "road_type").agg(
        F.expr("sum(n * (o_custkey % 100)) as total_vehicles"),
        F.expr("sum(speed) / sum(n) as daily_avg_speed"),
        F.expr("sum(incidents) as total_incidents"),
        F.count_distinct("o_custkey").alias("unique_intersections"),
    )


def air_day_long(spark: SparkSession, sf_dir: str, since: dt.date | None = None) -> DataFrame:
    """Daily air quality over years, from orders."""
    rows = _customer_days(spark, sf_dir, since, [], [])
    return rows.groupBy("date", F.col("r_name").alias("zone")).agg(
        F.expr("sum(n * (o_custkey % 200)) / sum(n) as avg_aqi")
    )

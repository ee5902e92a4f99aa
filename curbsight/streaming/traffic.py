"""Traffic stream: parse, validate, enrich, deduplicate, write; and windowed congestion."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbsight import schemas
from curbsight.functions.common import calendar, processing_time
from curbsight.functions.places import intersection_dimension
from curbsight.operators.changes import latest_per_key, lenient
from curbsight.operators.quality import accepted, documented_traffic_rules, quarantine
from curbsight.operators.traffic_gold import congestion_trends, sensor_sketches
from curbsight.sources.tables import (
    DAILY,
    HOURLY,
    broken_lines,
    only_hours,
    read_parquet,
    stream_jsonl,
    write_parquet,
)
from curbsight.streaming.ledger import batch_name, note_days
from curbsight.streaming.metrics import note_metrics
from curbsight.streaming.staging import discard, exists, stage, staged_hours, started

READING = "reading_datetime"

# Twice the time the landing zone buffers a record (300 s).
LATENESS = "10 minutes"

# How far a reading's time may lie ahead of its arrival. A clock beyond that is wrong, and one such time would move
# the watermark past all other readings.
AHEAD = "1 hour"
EARLIEST = "2000-01-01"


def broker_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The landed records from a broker, keyed by sensor. Needs the Kafka connector on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )
    return records_of(raw)


def records_of(messages: DataFrame) -> DataFrame:
    """The records in the ``value`` of messages; a value that is no record is kept with its text, like a broken line."""
    record = F.from_json(
        F.col("value").cast("string"),
        schemas.BRONZE_TRAFFIC,
        {"columnNameOfCorruptRecord": schemas.CORRUPT},
    )
    return messages.select(record.alias("r")).select("r.*")


def landed_records(spark: SparkSession, source: str | DataFrame, max_files: int | None) -> DataFrame:
    """The stream of a landing folder, or one that the caller has made of any other source."""
    return source if isinstance(source, DataFrame) else stream_jsonl(spark, source, schemas.BRONZE_TRAFFIC, max_files)


# Silver column, path in the record, type.
_PATHS = (
    ("latitude", "location.lat", "double"),
    ("longitude", "location.lon", "double"),
    ("intersection", "location.intersection", "string"),
    ("road_type", "location.road_type", "string"),
    ("city", "location.city", "string"),
    ("country", "location.country", "string"),
    ("vehicle_count", "measurements.vehicle_count", "int"),
    ("avg_speed_mph", "measurements.avg_speed_mph", "double"),
    ("congestion_level", "measurements.congestion_level", "string"),
    ("pedestrian_count", "measurements.pedestrian_count", "int"),
    ("bike_count", "measurements.bike_count", "int"),
    ("occupancy_percent", "measurements.occupancy_percent", "double"),
    ("queue_length_meters", "measurements.queue_length_meters", "double"),
    ("traffic_flow_score", "traffic_flow_score", "int"),
    ("device_status", "metadata.device_status", "string"),
    ("signal_strength_dbm", "metadata.signal_strength", "int"),
    ("firmware_version", "metadata.firmware_version", "string"),
)


def project_traffic(bronze: DataFrame, run_at: dt.datetime | None) -> DataFrame:
    """Flatten landed records to silver columns, partitioned by the hour of the reading."""
    flat = bronze.select(
        "sensor_id",
        F.try_to_timestamp("timestamp").cast("timestamp").alias(READING),
        "event_id",
        *(lenient(F.col(path), kind).alias(name) for name, path, kind in _PATHS),
        F.coalesce("incident_detected", F.lit(False)).alias("incident_detected"),
        processing_time(run_at).alias("silver_processed_at"),
        "data_source",
        "ingestion_type",
    )
    return flat.withColumns(calendar(READING, hour=True)).select(*schemas.SILVER_TRAFFIC.names)


def traffic_rules(ahead: str = AHEAD) -> dict[str, Column]:
    """An identity, a time that a working clock can have, and measurements in their ranges."""
    arrived = F.col("silver_processed_at")
    return {
        "identity": F.col("sensor_id").isNotNull() & F.col("event_id").isNotNull(),
        "time": (F.col(READING) >= F.lit(EARLIEST).cast("timestamp"))
        & (F.col(READING) <= arrived + F.expr(f"INTERVAL {ahead}")),
        **documented_traffic_rules(),
    }


def cleansed(silver: DataFrame, ahead: str = AHEAD) -> DataFrame:
    return accepted(silver, traffic_rules(ahead))


def rejected(landed: DataFrame, run_at: dt.datetime | None, ahead: str = AHEAD) -> DataFrame:
    """What ``cleansed`` leaves out, and lines that are no record: id, the record as text, the reasons."""
    readable = landed.filter(F.col(schemas.CORRUPT).isNull())
    rows = quarantine(project_traffic(readable, run_at), traffic_rules(ahead))
    columns = [c for c in rows.columns if c != "failed_rules"]
    return rows.select(
        F.col("event_id").alias("record_id"),
        F.to_json(F.struct(*columns)).alias("record"),
        F.array_join("failed_rules", ", ").alias("reason"),
    ).unionByName(broken_lines(landed))


def deduplicated(silver: DataFrame, lateness: str = LATENESS, lanes: int = 32) -> DataFrame:
    """First arrival of each event; the state is bounded by the watermark.

    One event may have very many copies. They are reduced to one per lane first, where the lane is
    the input task modulo ``lanes``, so no single task receives all of them. The second step then
    sees at most ``lanes`` copies of an event.
    """
    by_lane = silver.withWatermark(READING, lateness).withColumn("_lane", F.spark_partition_id() % lanes)
    return by_lane.dropDuplicatesWithinWatermark(["event_id", "_lane"]).dropDuplicatesWithinWatermark(
        ["event_id"]
    ).drop("_lane")


def located(silver: DataFrame) -> DataFrame:
    """Fill position and road type from the intersection dimension.

    The dimension is a constant of eight rows, so its broadcast does not grow with the data.
    """
    sites = F.broadcast(intersection_dimension(silver.sparkSession))
    filled = {
        "latitude": F.coalesce("latitude", "site_latitude"),
        "longitude": F.coalesce("longitude", "site_longitude"),
        "road_type": F.coalesce("road_type", "site_road_type"),
    }
    return silver.join(sites, "intersection", "left").withColumns(filled).select(*silver.columns)


def append_new(batch: DataFrame, silver_path: str, staged_path: str) -> list[dt.date | None]:
    """Append the events of a batch that silver does not hold yet, however late they are.

    Copies within the batch are cut to one per input task before they are shuffled. Events written
    before are found in the folders of the hours the batch touches, so nothing has to be remembered
    between batches and no late event is given up. Of these hours only the ids that the batch has as well
    meet it, so a batch costs what it holds, not what its day holds. A batch that is run again after a crash finds
    what it has already written and adds only the rest. Returns the days the batch touches.
    """
    spark = batch.sparkSession
    once = latest_per_key(batch, ("event_id",), [F.col(READING), F.col("sensor_id")])
    # Staged as they come, without folders: only the write by hour has to bring rows together.
    fresh = stage(once, staged_path, schemas.SILVER_TRAFFIC, by=())
    hours = staged_hours(fresh)
    if not hours:
        return []
    if exists(spark, silver_path):
        known = only_hours(read_parquet(spark, silver_path, schemas.SILVER_TRAFFIC), hours).select("event_id")
        repeated = known.join(fresh.select("event_id"), "event_id", "left_semi")
        fresh = fresh.join(repeated, "event_id", "left_anti")
    write_parquet(fresh, silver_path, by=HOURLY, mode="append")
    return [None if year is None else dt.date(year, month, day) for year, month, day, _ in hours]


def run_silver(
    spark: SparkSession,
    landing: str | DataFrame,
    silver_path: str,
    progress_path: str,
    run_at: dt.datetime | None,
    *,
    rejected_path: str | None = None,
    ledger_path: str | None = None,
    metrics_path: str | None = None,
    every: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Landing zone, or a stream of its records, to silver traffic: cleanse, enrich, deduplicate, append by hour.

    With ``rejected_path`` what is left out is written there, one folder per batch; a batch that is run again
    replaces its folder. With ``ledger_path`` each batch notes the days it has changed, for gold, and with ``metrics_path``
    its lines and how many of them were kept; lines that are no record break the rule of identity.
    """
    landed = landed_records(spark, landing, max_files)

    def append(batch: DataFrame, number: int) -> None:
        rows = located(cleansed(project_traffic(batch, run_at)))
        days = append_new(rows, silver_path, f"{progress_path}/staged/batch-{number}")
        if ledger_path:
            note_days(batch.sparkSession, ledger_path, batch_name(batch.sparkSession, number), days)
        if metrics_path:
            note_metrics(project_traffic(batch, run_at), traffic_rules(), metrics_path, "traffic",
                         batch_name(batch.sparkSession, number))
        if rejected_path:
            rejected(batch, run_at).write.mode("overwrite").parquet(f"{rejected_path}/batch={number}")
        # The batch before this one is committed, so its staged rows are of no more use.
        discard(spark, f"{progress_path}/staged/batch-{number - 1}")

    return started(landed.writeStream.foreachBatch(append), f"{progress_path}/checkpoint", every)


def start_parquet(
    frame: DataFrame, path: str, checkpoint: str, every: str | None = None, by: Sequence[str] = ()
) -> StreamingQuery:
    """Append a stream to a Parquet table, exactly once."""
    writer = frame.writeStream.format("parquet").option("path", path)
    return started(writer.partitionBy(*by) if by else writer, checkpoint, every)


def run_congestion(
    spark: SparkSession,
    landing: str | DataFrame,
    path: str,
    checkpoint: str,
    run_at: dt.datetime | None,
    *,
    lateness: str = LATENESS,
    ahead: str = AHEAD,
    every: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Landing zone to closed 15-minute windows, in folders by day like the table of the gold job.

    A window is written once the watermark has passed its end. Readings that come later than that
    are in silver all the same, and in the table the gold job builds from it. Readings from the future
    are left out before the watermark sees them.
    """
    landed = landed_records(spark, landing, max_files)
    rows = deduplicated(cleansed(project_traffic(landed, run_at), ahead), lateness)
    return start_parquet(congestion_trends(rows), path, checkpoint, every, by=DAILY)


def run_sensor_sketches(
    spark: SparkSession,
    landing: str | DataFrame,
    path: str,
    checkpoint: str,
    run_at: dt.datetime | None,
    *,
    lateness: str = LATENESS,
    ahead: str = AHEAD,
    every: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Landing zone to sketches of the sensors seen per 15-minute window.

    Exact distinct counts are not possible in a stream, and would not merge to hours or days. A sketch has a bounded size
    whatever the number of sensors, so the state does not grow with it. Repeats need no deduplication: they change nothing.
    """
    landed = landed_records(spark, landing, max_files)
    rows = cleansed(project_traffic(landed, run_at), ahead).withWatermark(READING, lateness)
    return start_parquet(sensor_sketches(rows), path, checkpoint, every, by=DAILY)

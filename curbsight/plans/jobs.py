"""The scheduled jobs: bronze to silver, silver to gold."""

from __future__ import annotations

import datetime as dt
from calendar import monthrange
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from curbsight import schemas
from curbsight.functions.common import moment, processing_time
from curbsight.operators import air_gold, traffic_gold
from curbsight.operators.changes import current_readings, silver_columns
from curbsight.operators.quality import accepted, air_rules, quarantine, summary
from curbsight.plans import documented
from curbsight.sources.tables import (
    DAILY,
    MONTHLY,
    broken_lines,
    has_rows,
    laid_out,
    only_days,
    read_air_bronze,
    read_parquet,
    register_table,
    replace_folders,
    write_arranged,
    write_parquet,
)

Builder = Callable[[DataFrame], DataFrame]


#: Gold tables that are written at the same time.
TABLES_AT_ONCE = 4


class GoldTable(NamedTuple):
    name: str
    build: Builder
    layout: tuple[str, ...] = DAILY
    from_rollup: bool = False
    #: Its rows come by day already, so the write needs no exchange.
    arranged: bool = False


class Domain(NamedTuple):
    """The rollup of a domain, the tables built from it or from silver, and the silver schema."""

    rollup: GoldTable
    tables: tuple[GoldTable, ...]
    silver: T.StructType


AIR = Domain(
    GoldTable("air_quality_sensor_hours", air_gold.stored_sensor_hours, arranged=True),
    (
        GoldTable("air_quality_hourly_avg", air_gold.stored_zone_hours, from_rollup=True),
        GoldTable("aqi_trends", air_gold.category_hours, from_rollup=True),
        GoldTable("air_quality_daily_summary", air_gold.daily_by_zone, MONTHLY, from_rollup=True),
        GoldTable("sensor_health_metrics", air_gold.by_sensor(air_gold.sensor_health), from_rollup=True, arranged=True),
        GoldTable("air_quality_daily_by_sensor", air_gold.by_sensor(air_gold.daily_by_sensor), from_rollup=True, arranged=True),
        GoldTable("air_quality_hourly_by_sensor", air_gold.by_sensor(air_gold.hourly_by_sensor), from_rollup=True, arranged=True),
    ),
    schemas.SILVER_AIR,
)

TRAFFIC = Domain(
    GoldTable("traffic_sensor_quarters", traffic_gold.stored_sensor_quarters, arranged=True),
    (
        GoldTable("traffic_hourly_by_intersection", traffic_gold.stored_intersection_hours, from_rollup=True),
        GoldTable("traffic_daily_summary", traffic_gold.road_days, MONTHLY, from_rollup=True),
        GoldTable("traffic_incidents", traffic_gold.incidents),
        GoldTable("traffic_congestion_trends", traffic_gold.trend_quarters, from_rollup=True),
        GoldTable("traffic_congestion_by_intersection", traffic_gold.intersection_quarters, from_rollup=True),
        GoldTable("traffic_hourly_congestion", traffic_gold.congestion_hours, from_rollup=True),
    ),
    schemas.SILVER_TRAFFIC,
)


# Built from readings before the rules, so not from silver.
SENSOR_QUALITY = GoldTable("sensor_quality_daily", documented.quality_days)


def bronze_to_silver(
    spark: SparkSession, bronze_path: str, silver_path: str, run_at: dt.datetime, *, apply_deletes: bool = False
) -> dict[str, int] | None:
    """Rebuild silver from all of bronze and return the batch metrics; None for empty input.

    A rebuild replaces the table, so running it twice gives the same silver. The metrics are
    counted while the table is written, not by further passes, and behind the last shuffle: a
    task of the last stage counts once, while earlier ones may run again if an executor is lost.
    """
    bronze = read_air_bronze(spark, bronze_path)
    if not has_rows(bronze):
        return None
    metrics = Observation()
    rules = air_rules()
    candidates = current_readings(bronze, run_at, apply_deletes=apply_deletes)
    counted = laid_out(silver_columns(candidates), DAILY).observe(metrics, *summary(rules))
    write_arranged(accepted(counted, rules), silver_path)
    return metrics.get


def bronze_quarantine(spark: SparkSession, bronze_path: str, quarantine_path: str, run_at: dt.datetime) -> None:
    """Write what a rebuild leaves out: lines that are no record, and readings that break a rule.

    Kept apart from the rebuild, which would otherwise have to do its work twice or store all rows
    twice. The incremental job needs no such pass; its state holds the rejected readings.
    """
    bronze = read_air_bronze(spark, bronze_path)
    rejected = quarantine(current_readings(bronze, run_at), air_rules())
    rows = rejected.select(
        F.col("source_cdc_event_id").alias("record_id"),
        F.to_json(F.struct(*silver_columns(rejected).columns)).alias("record"),
        F.array_join("failed_rules", ", ").alias("reason"),
    )
    rows.unionByName(broken_lines(bronze)).write.mode("overwrite").parquet(quarantine_path)


def build_gold(
    silver: DataFrame,
    gold_path: str,
    domain: Domain,
    run_at: dt.datetime | None,
    days: Iterable[dt.date | None] | None = None,
) -> list[str]:
    """Build the gold tables of a domain from silver; returns their names, none for empty input.

    Without ``days`` every table is rebuilt and replaced as a whole, empty ones included, so no
    stale rows survive. With ``days`` only those days of silver are read and only their folders
    replaced, also where nothing is left of a day, so a refresh leaves what a rebuild would. Tables
    laid out by month need their whole months, which they take from the stored rollup instead of silver.

    Silver is read once for the rollup, and by a filter where a table lists single readings. The tables do not depend on
    each other, so they are built side by side.
    """
    if days is None and not has_rows(silver):
        return []
    spark = silver.sparkSession
    wanted = None if days is None else list(days)

    def restricted(frame: DataFrame, layout: tuple[str, ...]) -> DataFrame:
        if wanted is None:
            return frame
        return only_days(frame, whole_months(wanted) if layout == MONTHLY else wanted)

    def store(table: GoldTable, source: DataFrame) -> str:
        rows = table.build(restricted(source, table.layout)).withColumn("processed_at", processing_time(run_at))
        path = f"{gold_path}/{table.name}"
        if wanted is None:
            write_arranged(rows if table.arranged else laid_out(rows, table.layout), path, by=table.layout)
        else:
            folders = {(None,) * len(table.layout) if d is None else (d.year, d.month, d.day)[: len(table.layout)]
                       for d in wanted}
            replace_folders(rows, path, table.layout, folders, arranged=table.arranged)
        return path

    rollup = read_parquet(spark, store(domain.rollup, silver), gold_schema(spark, domain, domain.rollup))
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        stores = [pool.submit(inheritable_thread_target(spark)(store), table, rollup if table.from_rollup else silver)
                  for table in domain.tables]
    for done in stores:
        done.result()
    return [domain.rollup.name, *(table.name for table in domain.tables)]


def bronze_to_quality(
    spark: SparkSession, bronze_path: str, gold_path: str, run_at: dt.datetime, database: str | None = None
) -> None:
    """The share of valid readings per sensor and day, from all current readings."""
    store_quality(current_readings(read_air_bronze(spark, bronze_path), run_at), gold_path, run_at, database)


def store_quality(candidates: DataFrame, gold_path: str, run_at: dt.datetime, database: str | None = None) -> None:
    rows = SENSOR_QUALITY.build(candidates).withColumn("processed_at", moment(run_at))
    path = f"{gold_path}/{SENSOR_QUALITY.name}"
    write_parquet(rows, path, by=SENSOR_QUALITY.layout)
    if database:
        spark = candidates.sparkSession
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        register_table(spark, f"{database}.{SENSOR_QUALITY.name}", path, rows.schema, by=SENSOR_QUALITY.layout)


def gold_schema(spark: SparkSession, domain: Domain, table: GoldTable) -> T.StructType:
    """The columns of a gold table, whether or not it has rows."""
    silver = spark.createDataFrame([], domain.silver)
    source = domain.rollup.build(silver) if table.from_rollup else silver
    return table.build(source).withColumn("processed_at", F.lit(None).cast("timestamp")).schema


def register_gold(spark: SparkSession, database: str, gold_path: str, domain: Domain) -> list[str]:
    """Declare all tables of a domain in the catalog, so that they can be queried by name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for table in (domain.rollup, *domain.tables):
        name, path = f"{database}.{table.name}", f"{gold_path}/{table.name}"
        register_table(spark, name, path, gold_schema(spark, domain, table), by=table.layout)
        names.append(name)
    return names


def whole_months(days: Iterable[dt.date | None]) -> list[dt.date | None]:
    """All days of the months that ``days`` lie in."""
    months = {None if d is None else (d.year, d.month) for d in days}
    out: list[dt.date | None] = []
    for month in months:
        if month is None:
            out.append(None)
        else:
            out += [dt.date(*month, day) for day in range(1, monthrange(*month)[1] + 1)]
    return out


def silver_to_gold(
    spark: SparkSession,
    domain: Domain,
    silver_path: str,
    gold_path: str,
    run_at: dt.datetime,
    days: Iterable[dt.date | None] | None = None,
    database: str | None = None,
) -> list[str]:
    """Build the gold tables of a domain and, with a database, bring its catalog up to date."""
    built = build_gold(read_parquet(spark, silver_path, domain.silver), gold_path, domain, run_at, days)
    if built and database:
        register_gold(spark, database, gold_path, domain)
    return built


def air_silver_to_gold(spark: SparkSession, *args, **options) -> list[str]:
    return silver_to_gold(spark, AIR, *args, **options)


def traffic_silver_to_gold(spark: SparkSession, *args, **options) -> list[str]:
    return silver_to_gold(spark, TRAFFIC, *args, **options)

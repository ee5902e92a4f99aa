"""Reading and writing of bronze, silver and gold tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbsight import schemas
from curbsight.functions.common import days_predicate

DAILY = ("year", "month", "day")
MONTHLY = ("year", "month")
HOURLY = ("year", "month", "day", "hour")


# --- sources --------------------------------------------------------------------------------


_JSONL = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": schemas.CORRUPT,
    "recursiveFileLookup": "true",
}


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON Lines below ``path`` with a declared schema; gzip is recognised by extension.

    The folder names (``year=...``) are arrival parts, not reading times, so the declared schema
    leaves them out. Broken lines are kept with their text in ``_corrupt_record``.
    """
    return spark.read.schema(schema).options(**_JSONL).json(path)


def stream_jsonl(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """The same files as a stream of what has not been read yet; ``max_files`` bounds a batch."""
    reader = spark.readStream.schema(schema).options(**_JSONL)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def read_air_bronze(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, schemas.BRONZE_AIR)


def read_traffic_bronze(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, schemas.BRONZE_TRAFFIC)


def read_change_records(spark: SparkSession, path: str) -> DataFrame:
    """Raw change records. Their typed documents stay text here, so a filter on the head costs no decode."""
    return read_jsonl(spark, path, schemas.CHANGE_RECORD)


def broken_lines(bronze: DataFrame) -> DataFrame:
    """Lines that are no JSON record, with what could be read of their id and the reason."""
    return bronze.filter(F.col(schemas.CORRUPT).isNotNull()).select(
        F.col(bronze.columns[0]).alias("record_id"),
        F.col(schemas.CORRUPT).alias("record"),
        F.lit("not a JSON record").alias("reason"),
    )


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; with a schema also one that was written empty."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def only_days(table: DataFrame, days: Iterable[dt.date | None]) -> DataFrame:
    """Restrict a table laid out by day to some days; only their folders are read."""
    return table.filter(days_predicate(days))


def only_hours(table: DataFrame, hours: Iterable[tuple[int | None, ...]]) -> DataFrame:
    """Restrict a table laid out by hour to some hours (year, month, day, hour); only their folders are read."""
    by_day: dict[tuple, list[int]] = {}
    for *day, hour in hours:
        by_day.setdefault(tuple(day), []).append(hour)
    wanted = F.lit(False)
    for (year, month, day), own in sorted(by_day.items(), key=str):
        if year is None:
            wanted = wanted | F.col("year").isNull()
        else:
            wanted = wanted | ((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)
                               & F.col("hour").isin(sorted(own)))
    return table.filter(wanted)


def has_rows(frame: DataFrame) -> bool:
    """Whether there is any input; stops at the first row instead of counting all."""
    return not frame.isEmpty()


def transform_unless_empty(
    frame: DataFrame, transform: Callable[[DataFrame], DataFrame]
) -> DataFrame | None:
    """Guard of a job: nothing is planned or written for empty input."""
    return transform(frame) if has_rows(frame) else None


# --- sinks ----------------------------------------------------------------------------------


def laid_out(frame: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring the rows of one folder together before the write, so it does not end in tiny files.

    A rebalance, unlike a plain repartition by the folder, lets adaptive execution split a folder
    that holds far more rows than the others.
    """
    return frame.hint("rebalance", *by)


def append_jsonl(frame: DataFrame, path: str, run_at: dt.datetime) -> None:
    """Append JSON Lines below the folder of the hour in which the batch was processed."""
    parts = {name: F.lit(run_at.strftime(code)) for name, code in zip(HOURLY, ("%Y", "%m", "%d", "%H"))}
    frame.withColumns(parts).write.mode("append").partitionBy(*HOURLY).json(path)


def replace_jsonl(frame: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write JSON Lines below folders ``by``, of which only those that occur in ``frame`` are replaced."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path)


def write_arranged(
    rows: DataFrame, path: str, by: Sequence[str] = DAILY, mode: str = "overwrite", overwrite: str = "static"
) -> None:
    """Write rows that are already ``laid_out`` as a Snappy Parquet table with folders ``by``.

    ``overwrite='static'`` replaces the whole table, ``'dynamic'`` only the folders that occur in
    ``rows``; the latter is for a refresh of some days and never for a partial rebuild.
    """
    (
        rows.write.mode(mode)
        .option("partitionOverwriteMode", overwrite)
        .option("compression", "snappy")
        .partitionBy(*by)
        .parquet(path)
    )


def write_parquet(
    frame: DataFrame, path: str, by: Sequence[str] = DAILY, mode: str = "overwrite", overwrite: str = "static"
) -> None:
    """Lay rows out by folder and write them; options as in ``write_arranged``."""
    write_arranged(laid_out(frame, by), path, by, mode, overwrite)


def replace_folders(
    frame: DataFrame, path: str, by: Sequence[str], wanted: Iterable[tuple[int | None, ...]], *, arranged: bool = False
) -> None:
    """Replace the ``wanted`` folders of a table by ``frame``, also those that get no rows.

    A dynamic overwrite leaves a folder alone if no row falls into it. Such a folder is overwritten with a file
    without rows. The written folders are noted during the write; like the wanted ones they are
    bounded by the calendar.
    """
    spark, written = frame.sparkSession, Observation()
    parts = F.collect_set(F.struct(*(F.coalesce(F.col(c).cast("int"), F.lit(-1)).alias(c) for c in by)))
    rows = frame if arranged else laid_out(frame, by)
    write_arranged(rows.observe(written, parts.alias("parts")), path, by, overwrite="dynamic")
    filled = {tuple(p) for p in written.get["parts"]}
    empty = spark.createDataFrame([], frame.drop(*by).schema)
    for values in sorted({tuple(-1 if v is None else v for v in w) for w in wanted} - filled):
        names = (f"{c}={'__HIVE_DEFAULT_PARTITION__' if v < 0 else v}" for c, v in zip(by, values))
        folder = "/".join([path, *names])
        if folder_exists(spark, folder):
            empty.write.mode("overwrite").parquet(folder)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def write_unless_empty(frame: DataFrame, path: str, by: Sequence[str] = DAILY) -> bool:
    """Conditional write: an empty result leaves the table as it is."""
    if not has_rows(frame):
        return False
    write_parquet(frame, path, by)
    return True


# --- catalog --------------------------------------------------------------------------------


def register_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, by: Sequence[str] = DAILY
) -> None:
    """Declare a Parquet folder as a table with a known schema, with exactly the partitions that it has now.

    A table that was declared with other columns is declared anew; its files stay.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    declared = {f.name: f.dataType.simpleString() for f in schema.fields}
    if spark.catalog.tableExists(name):
        if {f.name: f.dataType.simpleString() for f in spark.table(name).schema.fields} != declared:
            spark.sql(f"DROP TABLE {name}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(by)}) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def refresh_days(spark: SparkSession, name: str, frame: DataFrame, days: Iterable[dt.date]) -> None:
    """Replace some days of a managed table by ``frame``, also the days that are now empty.

    A dynamic overwrite leaves a folder alone if no row falls into it, so days without rows are
    dropped by name. The written days are noted during the write itself; like ``days`` they are
    bounded by the calendar.
    """
    written = Observation()
    day = F.make_date("year", "month", "day")
    (
        laid_out(frame.select(*spark.table(name).columns), DAILY)
        .observe(written, F.collect_set(day).alias("days"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .insertInto(name)
    )
    for d in sorted(set(days) - set(written.get["days"])):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (year={d.year}, month={d.month}, day={d.day})")

"""Staged batches: written once, then read as often as needed.

A stream hands each batch over as a plan. Reading it twice would parse the input twice, and a lost
executor would parse it again. A staged batch is a finished table in shared storage instead.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from curbsight.sources.tables import DAILY, laid_out, read_parquet


def _folder(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    store, folder = _folder(spark, path)
    return store.exists(folder)


def made(spark: SparkSession, path: str) -> None:
    """Create a folder that a stream is to watch before anything is in it."""
    store, folder = _folder(spark, path)
    store.mkdirs(folder)


def discard(spark: SparkSession, path: str) -> None:
    store, folder = _folder(spark, path)
    store.delete(folder, True)


def stage(
    frame: DataFrame, path: str, schema: T.StructType, by: Sequence[str] = DAILY, *, arranged: bool = False
) -> DataFrame:
    """Write a batch unless an earlier attempt finished doing so, and go on from the files.

    With ``arranged`` its rows come by folder already, so they are not exchanged again.
    """
    spark = frame.sparkSession
    if not exists(spark, f"{path}/_SUCCESS"):
        if by:
            (frame if arranged else laid_out(frame, by)).write.mode("overwrite").partitionBy(*by).parquet(path)
        else:
            frame.write.mode("overwrite").parquet(path)
    return read_parquet(spark, path, schema)


def staged_days(staged: DataFrame) -> list[dt.date | None]:
    """Days a staged batch touches, from its folder names; bounded by the calendar."""
    rows = staged.select(*DAILY).distinct().collect()
    return [None if r.year is None else dt.date(r.year, r.month, r.day) for r in rows]


def staged_hours(staged: DataFrame) -> list[tuple[int | None, ...]]:
    """Hour folders a staged batch touches (year, month, day, hour); bounded by the calendar."""
    return [tuple(r) for r in staged.select("year", "month", "day", "hour").distinct().collect()]


def started(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    """Start a stream: a batch per interval without end, or all that is there and then stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()

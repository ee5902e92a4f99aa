"""Batch metrics of streams: what came in, what was kept and why the rest was not.

A row per batch, in a folder named after the batch, so a batch that is run again replaces its row. The counts are taken by an
aggregate over what the batch has stored or read, not by counters that a repeated task would raise twice, and they are
written by the batch itself: a listener's events are lost with the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbsight.operators.quality import Rules, summary

METRICS = T.StructType([
    T.StructField("stream", T.StringType()),
    T.StructField("rows_in", T.LongType()),
    T.StructField("rows_valid", T.LongType()),
    T.StructField("rows_rejected", T.LongType()),
    T.StructField("failed", T.MapType(T.StringType(), T.LongType())),
])


def note_metrics(rows: DataFrame, rules: Rules, path: str, stream: str, batch: str) -> None:
    """Write the metrics of a batch: its rows, those that hold all rules, and per rule those that break it."""
    counts = rows.agg(*summary(rules))
    failed = F.map_from_arrays(F.array(*(F.lit(r) for r in rules)), F.array(*(F.col(f"failed_{r}") for r in rules)))
    counts.select(
        F.lit(stream).alias("stream"), "rows_in", "rows_valid", "rows_rejected", failed.alias("failed")
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """All batches with the number of each."""
    rows = spark.read.schema(T.StructType([*METRICS.fields, T.StructField("batch", T.StringType())])).parquet(path)
    return rows.withColumn("number", F.regexp_extract("batch", "-([0-9]+)$", 1).cast("int"))

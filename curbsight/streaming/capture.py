"""Capture of the change feed: landed change records to bronze, each once.

A batch has a folder of its own below the hour of its capture. Its records are staged with the time of the batch first, so
a batch that is run again after a crash replaces what it has written with the same rows in the same folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbsight import schemas
from curbsight.functions.common import processing_time
from curbsight.operators.changes import flatten_changes
from curbsight.sources.tables import HOURLY, broken_lines, replace_jsonl, stream_jsonl
from curbsight.streaming.ledger import batch_name
from curbsight.streaming.staging import discard, stage, started


def capture_batch(records: DataFrame, bronze_path: str, failed_path: str, staged_path: str, batch: str,
                  run_at: dt.datetime | None) -> None:
    """Change records of a batch as bronze envelopes; lines that can't be read are kept apart with their reason."""
    stamped = records.withColumn("captured_at", processing_time(run_at))
    staged = stage(stamped, staged_path, schemas.CAPTURED, by=())
    first = staged.select(F.date_format("captured_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).first()
    if first is None:
        return
    at = dt.datetime.fromisoformat(first[0])
    folder = {**{name: F.lit(at.strftime(code)) for name, code in zip(HOURLY, ("%Y", "%m", "%d", "%H"))},
              "batch": F.lit(batch)}
    for rows, path in ((flatten_changes(staged, at), bronze_path), (broken_lines(staged), failed_path)):
        replace_jsonl(rows.withColumns(folder), path, tuple(folder))


def run_capture(
    spark: SparkSession,
    landing: str,
    bronze_path: str,
    failed_path: str,
    progress_path: str,
    run_at: dt.datetime | None,
    *,
    every: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Capture what has landed since the last run. A stream that runs without end passes no ``run_at``."""
    records = stream_jsonl(spark, landing, schemas.CHANGE_RECORD, max_files)

    def capture(batch: DataFrame, number: int) -> None:
        capture_batch(batch, bronze_path, failed_path, f"{progress_path}/staged/batch-{number}",
                      batch_name(batch.sparkSession, number), run_at)
        # The batch before this one is committed, so its staged records are of no more use.
        discard(batch.sparkSession, f"{progress_path}/staged/batch-{number - 1}")

    return started(records.writeStream.foreachBatch(capture), f"{progress_path}/checkpoint", every)

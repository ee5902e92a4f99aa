"""Incremental change feed to silver, exact under retries and late changes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbsight import schemas
from curbsight.operators.changes import latest_readings, project_air, silver_columns, upserts, with_entity_key
from curbsight.operators.quality import air_rules, judged
from curbsight.sources.tables import only_days, read_parquet, stream_jsonl, write_arranged
from curbsight.streaming.ledger import batch_name, note_days
from curbsight.streaming.metrics import note_metrics
from curbsight.streaming.staging import discard, exists, stage, staged_days, started


def newest_state(changes: DataFrame) -> DataFrame:
    """The newest change per reading with its verdict.

    Rejected readings and deletions stay in the state, because they must keep beating older changes
    that arrive later. The result depends on the set of changes only, not on their batches, so
    merging a batch a second time changes nothing.
    """
    return judged(latest_readings(changes), air_rules()).select(*schemas.SILVER_AIR_STATE.names)


def merge_batch(changes: DataFrame, state_path: str, redo_path: str) -> list[dt.date | None]:
    """Fold a batch of projected changes into the state table; returns the days it touched.

    The new content of the touched days is staged below ``redo_path`` first and only then copied
    over the old. A run that dies in between finds the finished copy and goes on from it, so a half
    replaced day is never read back as the old state.
    """
    spark = changes.sparkSession
    staged = stage(newest_state(changes), f"{redo_path}/incoming", schemas.SILVER_AIR_STATE)
    days = staged_days(staged)
    if not days:
        return days
    merged = staged
    if exists(spark, state_path):
        known = only_days(read_parquet(spark, state_path, schemas.SILVER_AIR_STATE), days)
        merged = newest_state(staged.unionByName(known).drop("failed_rules", "is_valid"))
    # The staged files hold one day each already, so the copy needs no shuffle.
    redo = stage(merged, f"{redo_path}/merged", schemas.SILVER_AIR_STATE)
    write_arranged(redo, state_path, overwrite="dynamic")
    return days


def run_incremental(
    spark: SparkSession,
    bronze_path: str,
    state_path: str,
    progress_path: str,
    run_at: dt.datetime | None,
    *,
    apply_deletes: bool = False,
    ledger_path: str | None = None,
    metrics_path: str | None = None,
    every: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Fold the bronze files that arrived since the last run into the state.

    A stream that runs without end passes no ``run_at``, so each batch is stamped with its own time. With
    ``ledger_path`` each batch notes the days it has changed, for gold, and with ``metrics_path`` its readings and verdicts.

    Redo tables lie beside the checkpoint: whoever resets one resets both, so a batch number never
    meets the redo table of another history.
    """
    bronze = stream_jsonl(spark, bronze_path, schemas.BRONZE_AIR, max_files)
    feed = with_entity_key(bronze) if apply_deletes else upserts(bronze)

    def fold(batch: DataFrame, number: int) -> None:
        days = merge_batch(batch, state_path, f"{progress_path}/redo/batch-{number}")
        if ledger_path:
            note_days(batch.sparkSession, ledger_path, batch_name(batch.sparkSession, number), days)
        if metrics_path:
            incoming = read_parquet(batch.sparkSession, f"{progress_path}/redo/batch-{number}/incoming", schemas.SILVER_AIR_STATE)
            note_metrics(incoming.filter(F.col("cdc_event_type") != "REMOVE"), air_rules(), metrics_path, "air_quality",
                         batch_name(batch.sparkSession, number))
        # The batch before this one is committed, so its redo tables are of no more use.
        discard(spark, f"{progress_path}/redo/batch-{number - 1}")

    return started(project_air(feed, run_at).writeStream.foreachBatch(fold), f"{progress_path}/checkpoint", every)


def silver_from_state(spark: SparkSession, state_path: str) -> DataFrame:
    """Valid readings that are not deleted."""
    state = read_parquet(spark, state_path, schemas.SILVER_AIR_STATE)
    return silver_columns(state.filter(F.col("is_valid") & (F.col("cdc_event_type") != "REMOVE")))


def rejected_from_state(spark: SparkSession, state_path: str) -> DataFrame:
    """Current readings that break a rule, with the rules they break."""
    state = read_parquet(spark, state_path, schemas.SILVER_AIR_STATE)
    return state.filter(~F.col("is_valid") & (F.col("cdc_event_type") != "REMOVE"))

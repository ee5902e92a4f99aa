"""The ledger between silver and gold: which days each batch has changed.

A batch that has written its rows adds an entry with the days it touched. Gold reads the ledger as a stream of entries it
has not seen and rebuilds exactly these days, without a look at silver to find them. No time is compared: an entry appears
when its rows can be read, so a batch that was stamped before a gold run and finished after it is in the next run.

Both ends may crash anywhere. A batch that is run again adds nothing to an entry that is finished; an entry whose gold
run died is handed out again, and rebuilding a day twice changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from curbsight import schemas
from curbsight.plans.jobs import Domain, build_gold, register_gold
from curbsight.sources.tables import DAILY
from curbsight.streaming.staging import exists, made, started

#: One row per touched day, or one for the whole table. A day without parts holds rows without a readable time.
ENTRY = schemas.struct(("scope", schemas.TEXT), ("year month day", schemas.WHOLE))
DAY, ALL = "day", "all"

#: Entries are handed out however long gold has not been run; a file source forgets older files by default.
KEPT = "36500d"


def batch_name(spark: SparkSession, number: int) -> str:
    """A name for a batch of the running stream; the stream's id lives as long as its checkpoint."""
    return f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"


def note_days(spark: SparkSession, ledger_path: str, batch: str, days: Iterable[dt.date | None]) -> None:
    """Add the entry of a batch, after its rows are written. The list of days is bounded by the calendar."""
    _note(spark, ledger_path, batch, [(DAY, None, None, None) if d is None else (DAY, d.year, d.month, d.day)
                                      for d in sorted(set(days), key=str)])


def note_rebuild(spark: SparkSession, ledger_path: str, batch: str) -> None:
    """Add an entry for a batch that replaced the whole table."""
    _note(spark, ledger_path, batch, [(ALL, None, None, None)])


def _note(spark: SparkSession, ledger_path: str, batch: str, rows: list[tuple]) -> None:
    path = f"{ledger_path}/batch={batch}"
    if rows and not exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("overwrite").json(path)


def noted(entries: DataFrame) -> list[dt.date | None] | None:
    """The days of some entries; None if one of them is for the whole table."""
    rows = entries.select("scope", *DAILY).distinct().collect()
    if any(r.scope == ALL for r in rows):
        return None
    return [None if r.year is None else dt.date(r.year, r.month, r.day) for r in rows]


def run_gold(
    spark: SparkSession,
    domain: Domain,
    silver: Callable[[SparkSession], DataFrame],
    gold_path: str,
    ledger_path: str,
    progress_path: str,
    run_at: dt.datetime | None,
    *,
    database: str | None = None,
    every: str | None = None,
    max_entries: int | None = None,
) -> StreamingQuery:
    """Bring gold up to date with the entries that were added since the last run.

    ``silver`` gives the readings of the domain, laid out by day; only folders of noted days are read. Entries are
    deleted once they are done with, so whoever resets the progress has to note a rebuild.
    """
    made(spark, ledger_path)
    reader = spark.readStream.schema(ENTRY).options(
        maxFileAge=KEPT, recursiveFileLookup="true", cleanSource="delete")
    if max_entries:
        reader = reader.option("maxFilesPerTrigger", max_entries)

    def refresh(entries: DataFrame, number: int) -> None:
        days = noted(entries)
        if days == []:
            return
        built = build_gold(silver(entries.sparkSession), gold_path, domain, run_at, days)
        if built and database:
            # By the caller's session, whose own lists of a table's files are then renewed.
            register_gold(spark, database, gold_path, domain)

    return started(reader.json(ledger_path).writeStream.foreachBatch(refresh), f"{progress_path}/checkpoint", every)

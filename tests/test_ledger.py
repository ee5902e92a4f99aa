"""The hand-over from silver to gold: which days are rebuilt, after late commits, crashes and resets."""

from __future__ import annotations

import datetime as dt
import glob
import json

import pytest
from pyspark.sql import functions as F

from curbsight import schemas
from curbsight.plans import jobs
from curbsight.sources import tables
from curbsight.streaming import air_changes, ledger
from curbsight.streaming import traffic as stream
from tests.rows import change_line
from tests.test_streaming import land, reading

EARLY, LATE = dt.datetime(2024, 1, 11, 8), dt.datetime(2024, 1, 11, 9)


def air_gold(spark, base, run_at=LATE):
    def silver(session):
        return air_changes.silver_from_state(session, str(base / "state"))

    ledger.run_gold(spark, jobs.AIR, silver, str(base / "gold"), str(base / "ledger"), str(base / "gold-progress"),
                    run_at).awaitTermination()
    return tables.read_parquet(spark, str(base / "gold" / "air_quality_daily_summary"),
                               jobs.gold_schema(spark, jobs.AIR, jobs.AIR.tables[2]))


def air_batch(spark, base, run_at, noting=True):
    air_changes.run_incremental(
        spark, str(base / "bronze"), str(base / "state"), str(base / "progress"), run_at,
        ledger_path=str(base / "ledger") if noting else None).awaitTermination()


def days(rows):
    return {str(r.date): (r.total_readings, r.daily_avg_pm25) for r in rows.collect()}


def test_a_batch_stamped_before_and_finished_after_a_gold_run_reaches_gold(spark, tmp_path):
    land(tmp_path / "bronze", change_line("INSERT", "1", 10.0))
    air_batch(spark, tmp_path, LATE)
    assert days(air_gold(spark, tmp_path)) == {"2024-01-10": (1, 10.0)}
    # This batch began before that gold run: its stamp is older, and it may touch another day.
    land(tmp_path / "bronze", change_line("INSERT", "2", 30.0, sensor="AQ_2"),
         change_line("INSERT", "3", 5.0, stamp="2024-01-09T08:00:00+00:00"))
    air_batch(spark, tmp_path, EARLY)
    assert days(air_gold(spark, tmp_path)) == {"2024-01-10": (2, 20.0), "2024-01-09": (1, 5.0)}


def test_only_noted_days_are_read(spark, tmp_path):
    """A day that no batch touched may even be unreadable: neither finding the days nor rebuilding them opens it."""
    land(tmp_path / "bronze", change_line("INSERT", "1", 10.0),
         change_line("INSERT", "2", 5.0, stamp="2024-02-09T08:00:00+00:00"))
    air_batch(spark, tmp_path, EARLY)
    air_gold(spark, tmp_path)
    for path in glob.glob(str(tmp_path / "state" / "year=2024" / "month=2" / "day=9" / "*.parquet")):
        with open(path, "wb") as file:
            file.write(b"no parquet")
    land(tmp_path / "bronze", change_line("MODIFY", "3", 40.0))
    air_batch(spark, tmp_path, EARLY)
    assert days(air_gold(spark, tmp_path)) == {"2024-01-10": (1, 40.0), "2024-02-09": (1, 5.0)}


def test_without_new_entries_nothing_is_rebuilt(spark, tmp_path):
    land(tmp_path / "bronze", change_line("INSERT", "1", 10.0))
    air_batch(spark, tmp_path, EARLY)
    first = air_gold(spark, tmp_path, EARLY).select("processed_at").collect()
    air_batch(spark, tmp_path, LATE)
    assert air_gold(spark, tmp_path, LATE).select("processed_at").collect() == first


def test_a_day_that_loses_its_readings_leaves_gold(spark, tmp_path):
    land(tmp_path / "bronze", change_line("INSERT", "1", 10.0), change_line(
        "INSERT", "2", 5.0, stamp="2024-01-12T08:00:00+00:00"))
    air_batch(spark, tmp_path, EARLY)
    assert len(days(air_gold(spark, tmp_path))) == 2
    land(tmp_path / "bronze", change_line("MODIFY", "3", 999.0, stamp="2024-01-12T08:00:00+00:00"))
    air_batch(spark, tmp_path, EARLY)
    assert days(air_gold(spark, tmp_path)) == {"2024-01-10": (1, 10.0)}


def test_a_gold_run_that_dies_gets_its_entries_again(spark, tmp_path):
    land(tmp_path / "bronze", change_line("INSERT", "1", 10.0))
    air_batch(spark, tmp_path, EARLY)

    def broken(session):
        raise OSError("lost")

    query = ledger.run_gold(spark, jobs.AIR, broken, str(tmp_path / "gold"), str(tmp_path / "ledger"),
                            str(tmp_path / "gold-progress"), LATE)
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination()
    assert days(air_gold(spark, tmp_path)) == {"2024-01-10": (1, 10.0)}


def test_an_entry_is_finished_once(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.note_days(spark, path, "q-1", [dt.date(2024, 1, 2), None, dt.date(2024, 1, 2)])
    ledger.note_days(spark, path, "q-1", [dt.date(2024, 5, 5)])
    ledger.note_days(spark, path, "q-2", [])
    entries = spark.read.schema(ledger.ENTRY).json(path)
    assert sorted(ledger.noted(entries), key=str) == [dt.date(2024, 1, 2), None]
    # Half an entry, as a crash leaves it, is written anew.
    (tmp_path / "ledger" / "batch=q-3").mkdir()
    (tmp_path / "ledger" / "batch=q-3" / "part-0.json").write_text(json.dumps({"scope": "day", "year": 1}))
    ledger.note_days(spark, path, "q-3", [dt.date(2024, 1, 3)])
    assert len(ledger.noted(spark.read.schema(ledger.ENTRY).json(path))) == 3


def test_a_rebuild_is_noted_for_the_whole_table(spark, tmp_path):
    land(tmp_path / "bronze", change_line("INSERT", "1", 10.0))
    air_batch(spark, tmp_path, EARLY, noting=False)
    tables_at = tmp_path / "ledger"
    ledger.note_rebuild(spark, str(tables_at), "rebuild-1")
    assert days(air_gold(spark, tmp_path)) == {"2024-01-10": (1, 10.0)}


def test_traffic_hands_its_days_over(spark, tmp_path):
    def batch():
        stream.run_silver(spark, str(tmp_path / "landing"), str(tmp_path / "silver"), str(tmp_path / "progress"), EARLY,
                          ledger_path=str(tmp_path / "ledger")).awaitTermination()
        ledger.run_gold(
            spark, jobs.TRAFFIC, lambda s: tables.read_parquet(s, str(tmp_path / "silver"), schemas.SILVER_TRAFFIC),
            str(tmp_path / "gold"), str(tmp_path / "ledger"), str(tmp_path / "gold-progress"), LATE,
            database="ledger_gold").awaitTermination()
        return {str(r.date): r.total_readings for r in spark.table("ledger_gold.traffic_daily_summary").collect()}

    land(tmp_path / "landing", reading("a", 0), reading("b", 60 * 24))
    assert batch() == {"2024-01-10": 1, "2024-01-11": 1}
    land(tmp_path / "landing", reading("c", 1), reading("a", 0), reading("fast", 60 * 48, avg_speed_mph=200))
    assert batch() == {"2024-01-10": 2, "2024-01-11": 1}
    for table in (jobs.TRAFFIC.rollup, *jobs.TRAFFIC.tables):
        spark.sql(f"DROP TABLE ledger_gold.{table.name}")


def test_gold_over_the_ledger_equals_a_rebuild(spark, tmp_path):
    lines = [change_line("INSERT", str(i), float(i), sensor=f"AQ_{i % 3}", stamp=f"2024-01-{10 + i % 4}T0{i % 7}:00:00+00:00")
             for i in range(1, 20)]
    for at in range(0, 19, 5):
        land(tmp_path / "bronze", *lines[at:at + 5])
        air_batch(spark, tmp_path, EARLY)
        air_gold(spark, tmp_path)
    silver = air_changes.silver_from_state(spark, str(tmp_path / "state"))
    jobs.build_gold(silver, str(tmp_path / "whole"), jobs.AIR, LATE)
    for table in (jobs.AIR.rollup, *jobs.AIR.tables):
        a, b = (tables.read_parquet(spark, str(tmp_path / p / table.name), jobs.gold_schema(spark, jobs.AIR, table))
                for p in ("whole", "gold"))
        keep = [c for c in a.columns if c != "processed_at"]
        show = [F.col(c).cast("string").alias(c) for c in keep]
        assert sorted(a.select(*show).collect()) == sorted(b.select(*show).collect()), table.name

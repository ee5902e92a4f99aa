from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from curbsight.operators import changes
from curbsight.sources.tables import append_jsonl, broken_lines, read_air_bronze
from tests.rows import change_line

RUN = dt.datetime(2024, 1, 10, 9, 0)


def bronze(spark, tmp_path, *lines):
    (tmp_path / "year=2024" / "month=01").mkdir(parents=True, exist_ok=True)
    text = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines)
    (tmp_path / "year=2024" / "month=01" / "feed.jsonl").write_text(text + "\n")
    return read_air_bronze(spark, str(tmp_path))


def test_longer_sequence_numbers_are_larger(spark, tmp_path):
    feed = bronze(spark, tmp_path, change_line("INSERT", "99", 1.0), change_line("MODIFY", "100", 2.0))
    (row,) = changes.current_readings(feed, RUN).collect()
    assert (row.pm25, row.cdc_sequence_number) == (2.0, "100")


def test_numbers_may_be_text_and_bad_values_become_null(spark, tmp_path):
    feed = bronze(
        spark, tmp_path,
        change_line("INSERT", "1", "12.5"),
        change_line("INSERT", "2", "broken", sensor="AQ_2"),
        change_line("INSERT", "3", 7, sensor="AQ_3", stamp="not a time"),
    )
    rows = {r.sensor_id: r for r in changes.current_readings(feed, RUN).collect()}
    assert (rows["AQ_1"].pm25, rows["AQ_1"].longitude, rows["AQ_1"].aqi_value, rows["AQ_1"].battery_level) == (
        12.5, -74.0, 41, 87,
    )
    assert rows["AQ_2"].pm25 is None and rows["AQ_2"].zone == "downtown"
    assert rows["AQ_3"].reading_datetime is None and rows["AQ_3"].pm25 == 7.0


def test_broken_lines_are_kept_with_their_text(spark, tmp_path):
    feed = bronze(spark, tmp_path, change_line("INSERT", "1"), '{"cdc_event_id": "x", ')
    rows = broken_lines(feed).collect()
    assert [r.record for r in rows] == ['{"cdc_event_id": "x", ']
    assert changes.current_readings(feed, RUN).count() == 1


def test_deletes_are_ignored_unless_asked_for(spark, tmp_path):
    feed = bronze(
        spark, tmp_path,
        change_line("INSERT", "1"), change_line("REMOVE", "2"),
        change_line("REMOVE", "3", sensor="AQ_2"), change_line("INSERT", "4", sensor="AQ_2"),
    )
    assert {r.sensor_id for r in changes.current_readings(feed, RUN).collect()} == {"AQ_1", "AQ_2"}
    assert {r.sensor_id for r in changes.current_readings(feed, RUN, apply_deletes=True).collect()} == {"AQ_2"}


def test_only_deletes_in_a_batch(spark, tmp_path):
    feed = bronze(spark, tmp_path, change_line("REMOVE", "1"))
    assert changes.current_readings(feed, RUN).count() == 0


def test_one_key_with_very_many_copies(spark):
    n = 20000
    rows = spark.range(n, numPartitions=8).select(
        F.lit("AQ_1").alias("sensor_id"), F.lit("t").alias("stamp"), F.col("id").cast("string").alias("seq"),
        F.lit("c").alias("at"), F.col("id").cast("string").alias("event"),
    ).unionByName(
        spark.range(2 * n).select(
            F.concat(F.lit("x"), F.col("id").cast("string")).alias("sensor_id"), F.lit("t").alias("stamp"),
            F.lit("1").alias("seq"), F.lit("c").alias("at"), F.lit("e").alias("event"),
        )
    )
    kept = changes.latest_per_key(rows, ("sensor_id", "stamp"), changes.newest_first("seq", "at", "event"))
    assert kept.count() == 2 * n + 1
    assert kept.filter("sensor_id = 'AQ_1'").first().seq == str(n - 1)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_jsonl_lands_by_processing_hour(spark, tmp_path):
    frame = spark.createDataFrame([("a",)], "x string")
    path = str(tmp_path / "bronze")
    append_jsonl(frame, path, RUN)
    append_jsonl(frame, path, RUN)
    assert (tmp_path / "bronze" / "year=2024" / "month=01" / "day=10" / "hour=09").is_dir()
    assert spark.read.json(path).count() == 2

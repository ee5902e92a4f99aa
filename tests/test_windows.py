"""Late windows, sketches of sensors and metrics of batches."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from curbsight import schemas
from curbsight.operators import traffic_gold
from curbsight.sources import tables
from curbsight.streaming import air_changes, metrics, windows
from curbsight.streaming import traffic as stream
from tests.rows import change_line, minutes, traffic
from tests.test_gold import mixed_traffic, rounded_rows
from tests.test_streaming import land, reading

RUN = dt.datetime(2024, 3, 1)


def silver_run(spark, base, **kind):
    stream.run_silver(spark, *(str(base / p) for p in ("landing", "silver", "progress")), RUN, **kind).awaitTermination()


def window_run(spark, base):
    windows.run_quarters(spark, str(base / "silver"), str(base / "quarters"), str(base / "window-progress")).awaitTermination()
    rollup = tables.read_parquet(spark, str(base / "quarters"), windows.quarter_schema(spark))
    rows = traffic_gold.trend_quarters(rollup).select(F.col("time_window_start").cast("string").alias("at"), "*").collect()
    return {r["at"]: (r.reading_count, r.avg_vehicles) for r in rows}


def test_a_reading_weeks_late_corrects_its_window(spark, tmp_path):
    land(tmp_path / "landing", reading("a", 0, vehicle_count=10), reading("b", 60 * 24 * 30))
    silver_run(spark, tmp_path)
    assert window_run(spark, tmp_path)["2024-01-10 08:00:00"] == (1, 10.0)
    land(tmp_path / "landing", reading("late", 14, vehicle_count=30), reading("a", 0, vehicle_count=10))
    silver_run(spark, tmp_path)
    found = window_run(spark, tmp_path)
    assert found["2024-01-10 08:00:00"] == (2, 20.0) and found["2024-02-09 08:00:00"][0] == 1
    assert window_run(spark, tmp_path) == found


def test_a_batch_run_again_adds_nothing(spark, tmp_path):
    path, rows = str(tmp_path / "quarters"), mixed_traffic(spark)
    for batch in (0, 0, 1, 1):
        windows.add_quarters(rows.filter(F.col("event_id").cast("int") % 2 == batch), path, str(tmp_path / f"redo-{batch}"))
    rollup = tables.read_parquet(spark, path, windows.quarter_schema(spark))
    whole = traffic_gold.sensor_quarters(rows)
    assert rounded_rows(rollup, whole.columns) == rounded_rows(whole, whole.columns)


def test_only_days_that_the_rollup_holds_are_merged(spark, tmp_path):
    path, redo = str(tmp_path / "quarters"), tmp_path / "redo"
    first = traffic(spark, {"event_id": "a"})
    second = traffic(spark, {"event_id": "b"}, {"event_id": "next", "reading_datetime": minutes(60 * 24)})
    for number, rows in ((0, first), (0, first), (1, second), (1, second)):
        windows.add_quarters(rows, path, str(redo / f"batch-{number}"))
    schema = windows.quarter_schema(spark)
    rollup, whole = tables.read_parquet(spark, path, schema), traffic_gold.sensor_quarters(first.unionByName(second))
    assert rounded_rows(rollup, whole.columns) == rounded_rows(whole, whole.columns)
    merged = [tables.read_parquet(spark, str(redo / f"batch-{n}" / "merged"), schema).collect() for n in (0, 1)]
    assert [[r.readings for r in rows] for rows in merged] == [[], [2]]


@pytest.mark.parametrize("parts", [2, 5])
def test_merged_rollups_are_the_rollup_of_all(spark, parts):
    rows = mixed_traffic(spark)
    pieces = None
    for i in range(parts):
        piece = traffic_gold.sensor_quarters(rows.filter(F.col("event_id").cast("int") % parts == i))
        pieces = piece if pieces is None else pieces.unionByName(piece)
    whole = traffic_gold.sensor_quarters(rows)
    assert rounded_rows(traffic_gold.merged_quarters(pieces), whole.columns) == rounded_rows(whole, whole.columns)


def test_sketches_merge_to_any_coarser_key(spark):
    rows = spark.range(60_000).select(
        (F.lit("2024-01-10").cast("timestamp") + F.make_dt_interval(mins=F.col("id") % 600)).alias("reading_datetime"),
        F.concat(F.lit("s"), (F.col("id") * 7 % 20_000).cast("string")).alias("sensor_id"), F.lit("c").alias("city"),
        F.when(F.col("id") % 3 == 0, "local").otherwise("major").alias("road_type"))
    sketches = traffic_gold.sensor_sketches(rows)
    for keys in (("city",), ("city", "road_type"), ("hour",)):
        exact = {tuple(r[k] for k in keys): r.n for r in rows.withColumn("hour", F.hour("reading_datetime")).groupBy(*keys).agg(
            F.count_distinct("sensor_id").alias("n")).collect()}
        found = {tuple(r[k] for k in keys): r.unique_sensors for r in traffic_gold.unique_sensors(sketches, *keys).collect()}
        assert found.keys() == exact.keys()
        assert all(abs(found[k] - n) <= traffic_gold.SKETCH_ERROR * n for k, n in exact.items())
    assert max(len(r.sensors) for r in sketches.collect()) < 5_000
    few = traffic_gold.sensor_sketches(traffic(spark, {}, {"sensor_id": "TR_2"}, {"sensor_id": None}, {"reading_datetime": minutes(20)}))
    assert sorted(r.unique_sensors for r in traffic_gold.unique_sensors(few, "time_window_start").collect()) == [1, 2]


def counted(spark, path):
    return {(r.stream, r.number): (r.rows_in, r.rows_valid, r.rows_rejected, {k: v for k, v in r.failed.items() if v})
            for r in metrics.read_metrics(spark, path).collect()}


def test_every_batch_says_what_it_kept(spark, tmp_path):
    path = str(tmp_path / "metrics")
    land(tmp_path / "landing", reading("a", 0), reading("a", 0), reading("fast", 5, avg_speed_mph=200))
    (tmp_path / "landing" / "broken.jsonl").write_text("{no\n")
    silver_run(spark, tmp_path, metrics_path=path)
    land(tmp_path / "landing", reading("b", 5))
    silver_run(spark, tmp_path, metrics_path=path)
    land(tmp_path / "bronze", change_line("INSERT", "1"), change_line("MODIFY", "2", 3.0), change_line("INSERT", "3", -5.0, sensor="AQ_2"))
    air_changes.run_incremental(spark, *(str(tmp_path / p) for p in ("bronze", "state", "air")), RUN, metrics_path=path).awaitTermination()
    found = counted(spark, path)
    assert found == {("traffic", 0): (4, 2, 2, {"avg_speed_mph": 1, "identity": 1, "time": 1}), ("traffic", 1): (1, 1, 0, {}),
                     ("air_quality", 0): (2, 1, 1, {"pm25": 1})}
    assert all(rows == valid + rejected for rows, valid, rejected, _ in found.values())


def test_metrics_of_a_repeated_batch_are_replaced(spark, tmp_path):
    rows = stream.project_traffic(spark.createDataFrame([], schemas.BRONZE_TRAFFIC), RUN)
    for _ in range(2):
        metrics.note_metrics(rows, stream.traffic_rules(), str(tmp_path), "traffic", "q-7")
    assert counted(spark, str(tmp_path)) == {("traffic", 7): (0, 0, 0, {})}

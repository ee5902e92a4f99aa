from __future__ import annotations

import datetime as dt
import itertools
import json
import shutil

import pytest
from pyspark.sql import functions as F

from curbsight import schemas
from curbsight.operators import changes, quality
from curbsight.sources import tables
from curbsight.streaming import air_changes
from curbsight.streaming import traffic as stream
from tests.rows import change_line

RUN = dt.datetime(2024, 1, 11, 9, 0)


def land(folder, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"part-{len(list(folder.iterdir())):03d}.jsonl").write_text("\n".join(json.dumps(x) for x in lines) + "\n")


def reading(event, minute, **over):
    stamp = dt.datetime(2024, 1, 10, 8) + dt.timedelta(minutes=minute)
    line = {
        "sensor_id": "TR_1", "timestamp": stamp.isoformat() + "Z", "event_id": event, "sensor_type": "traffic",
        "location": {"intersection": "Brooklyn_Bridge", "city": "New_York", "country": "USA"},
        "measurements": {"vehicle_count": 30, "avg_speed_mph": 20.5, "congestion_level": "moderate"},
        "traffic_flow_score": 70, "incident_detected": False,
    }
    line["measurements"] = {**line["measurements"], **over}
    return line


def run_traffic(spark, base):
    paths = (str(base / name) for name in ("landing", "silver", "progress"))
    stream.run_silver(spark, *paths, RUN).awaitTermination()
    return tables.read_parquet(spark, str(base / "silver"), schemas.SILVER_TRAFFIC)


def test_traffic_stream(spark, tmp_path):
    land(
        tmp_path / "landing",
        reading("a", 0), reading("a", 0), reading("b", 5),
        reading("fast", 5, avg_speed_mph=200), reading("text", 6, vehicle_count="31"), reading("odd", 6, bike_count="x"),
    )
    rows = {r.event_id: r for r in run_traffic(spark, tmp_path).collect()}
    assert set(rows) == {"a", "b", "text", "odd"}
    assert rows["text"].vehicle_count == 31 and rows["odd"].bike_count is None
    assert (rows["a"].latitude, rows["a"].road_type, rows["a"].hour) == (40.7061, "major", 8)

    # Nothing new has landed: a second run adds nothing.
    assert run_traffic(spark, tmp_path).count() == 4
    # A repeat is dropped, new events are kept, however late.
    land(tmp_path / "landing", reading("b", 5), reading("c", 7), reading("late", -60 * 24 * 40))
    assert run_traffic(spark, tmp_path).count() == 6


def test_rejects_are_kept_and_the_future_is_refused(spark, tmp_path):
    land(tmp_path / "landing", reading("a", 0), reading("fast", 5, avg_speed_mph=200), reading("future", 60 * 24 * 9000))
    paths = [str(tmp_path / name) for name in ("landing", "silver", "progress")]
    stream.run_silver(spark, *paths, RUN, rejected_path=str(tmp_path / "rejected")).awaitTermination()
    silver = tables.read_parquet(spark, paths[1], schemas.SILVER_TRAFFIC)
    assert {r.event_id for r in silver.collect()} == {"a"}
    rejected = {r.record_id: r.reason for r in spark.read.parquet(str(tmp_path / "rejected")).collect()}
    assert rejected == {"fast": "avg_speed_mph", "future": "time"}


def test_an_endless_stream_stamps_its_batches(spark, tmp_path):
    land(tmp_path / "landing", reading("a", 0))
    paths = [str(tmp_path / name) for name in ("landing", "silver", "progress")]
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    query = stream.run_silver(spark, *paths, None, every="1 second")
    query.processAllAvailable()
    land(tmp_path / "landing", reading("b", 1))
    query.processAllAvailable()
    query.stop()
    rows = tables.read_parquet(spark, paths[1], schemas.SILVER_TRAFFIC).withColumn(
        "silver_processed_at", F.col("silver_processed_at").cast("timestamp_ntz")
    ).orderBy("event_id").collect()
    assert [r.event_id for r in rows] == ["a", "b"]
    assert before <= rows[0].silver_processed_at < rows[1].silver_processed_at


def test_a_batch_run_again_adds_only_what_is_missing(spark, tmp_path):
    silver = str(tmp_path / "silver")

    def batch(*lines):
        rows = spark.createDataFrame([(json.dumps(x),) for x in lines], "v string")
        bronze = rows.select(F.from_json("v", schemas.BRONZE_TRAFFIC).alias("r")).select("r.*")
        return stream.project_traffic(bronze, RUN)

    stream.append_new(batch(reading("a", 0)), silver, str(tmp_path / "s0"))
    for _ in range(2):
        stream.append_new(batch(reading("a", 0), reading("b", 1), reading("b", 1)), silver, str(tmp_path / "s1"))
    rows = tables.read_parquet(spark, silver, schemas.SILVER_TRAFFIC).collect()
    assert sorted(r.event_id for r in rows) == ["a", "b"]


def test_a_batch_is_dealt_by_folder_only_for_its_write(spark, tmp_path):
    lines = [json.dumps(reading(f"e{i}", 60 * 24 * (i % 3))) for i in range(9)]
    records = spark.read.schema(schemas.BRONZE_TRAFFIC).json(spark.sparkContext.parallelize(lines))
    rows = stream.project_traffic(records, dt.datetime(2024, 3, 1))
    days = stream.append_new(rows, str(tmp_path / "silver"), str(tmp_path / "staged"))
    assert sorted(set(days)) == [dt.date(2024, 1, 10) + dt.timedelta(days=i) for i in range(3)]
    assert list((tmp_path / "staged").glob("*.parquet")) and not list((tmp_path / "staged").glob("year=*"))
    assert len(list((tmp_path / "silver").glob("year=2024/month=1/day=*/hour=*"))) == 3
    assert tables.read_parquet(spark, str(tmp_path / "silver"), schemas.SILVER_TRAFFIC).count() == 9


def test_stateful_dedup_with_very_many_copies(spark, tmp_path):
    for part in range(3):
        land(tmp_path / "landing", *[reading("hot", 1)] * 500, *[reading(f"e{part}-{i}", 1) for i in range(20)])
    landed = tables.stream_jsonl(spark, str(tmp_path / "landing"), schemas.BRONZE_TRAFFIC, max_files=1)
    once = stream.deduplicated(stream.project_traffic(landed, RUN), lanes=4).select("event_id")
    out = str(tmp_path / "out")
    stream.start_parquet(once, out, str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.parquet(out).count() == 61
    assert spark.read.parquet(out).distinct().count() == 61


def run_changes(spark, base, **kind):
    air_changes.run_incremental(
        spark, str(base / "bronze"), str(base / "state"), str(base / "progress"), RUN, **kind
    ).awaitTermination()
    return air_changes.silver_from_state(spark, str(base / "state"))


LINES = [
    change_line("INSERT", "1", 1.0),
    change_line("MODIFY", "12", 2.0),
    change_line("MODIFY", "3", 3.0),
    change_line("INSERT", "4", 4.0, sensor="AQ_2", stamp="2024-01-11T08:00:00+00:00"),
    change_line("MODIFY", "5", 999.0, sensor="AQ_2", stamp="2024-01-11T08:00:00+00:00"),
]


@pytest.mark.parametrize("order", [(0, 1, 2, 3, 4), (4, 1, 0, 3, 2), (2, 4, 3, 0, 1)])
def test_state_does_not_depend_on_arrival(spark, tmp_path, order):
    for i in order:
        land(tmp_path / "bronze", LINES[i])
        silver = run_changes(spark, tmp_path)
    assert [(r.sensor_id, r.pm25) for r in silver.collect()] == [("AQ_1", 2.0)]
    rejected = air_changes.rejected_from_state(spark, str(tmp_path / "state")).collect()
    assert [(r.sensor_id, r.pm25, r.failed_rules) for r in rejected] == [("AQ_2", 999.0, ["pm25"])]


def test_incremental_equals_batch(spark, tmp_path):
    for part in itertools.batched(LINES, 2):
        land(tmp_path / "bronze", *part)
        silver = run_changes(spark, tmp_path)
    bronze = tables.read_air_bronze(spark, str(tmp_path / "bronze"))
    batch = changes.silver_columns(quality.accepted(changes.current_readings(bronze, RUN), quality.air_rules()))
    assert sorted(map(tuple, silver.collect())) == sorted(map(tuple, batch.collect()))


def test_deletions_win_over_older_changes(spark, tmp_path):
    land(tmp_path / "bronze", change_line("REMOVE", "9"))
    assert run_changes(spark, tmp_path, apply_deletes=True).count() == 0
    land(tmp_path / "bronze", change_line("INSERT", "8"), change_line("INSERT", "7", sensor="AQ_2"))
    assert [r.sensor_id for r in run_changes(spark, tmp_path, apply_deletes=True).collect()] == ["AQ_2"]


def test_interrupted_copy_is_finished_from_the_redo_table(spark, tmp_path):
    """The touched day is lost half way through the copy; the retry restores all of it."""
    state, redo = str(tmp_path / "state"), str(tmp_path / "redo")

    def batch(*lines):
        return spark.createDataFrame([(json.dumps(x),) for x in lines], "v string").select(
            F.from_json("v", schemas.BRONZE_AIR).alias("r")
        ).select("r.*")

    air_changes.merge_batch(changes.project_air(batch(LINES[0]), RUN), state, f"{redo}/0")
    second = changes.project_air(batch(change_line("INSERT", "2", 5.0, sensor="AQ_5")), RUN)
    air_changes.merge_batch(second, state, f"{redo}/1")
    whole = sorted(r.sensor_id for r in air_changes.silver_from_state(spark, state).collect())
    shutil.rmtree(tmp_path / "state" / "year=2024" / "month=1" / "day=10")
    air_changes.merge_batch(second, state, f"{redo}/1")
    assert sorted(r.sensor_id for r in air_changes.silver_from_state(spark, state).collect()) == whole == ["AQ_1", "AQ_5"]


def test_unreadable_times_are_kept(spark, tmp_path):
    land(tmp_path / "bronze", change_line("INSERT", "1", stamp="when?"))
    run_changes(spark, tmp_path)
    land(tmp_path / "bronze", change_line("MODIFY", "2", 7.0, stamp="when?"))
    (row,) = run_changes(spark, tmp_path).collect()
    assert row.reading_datetime is None and row.pm25 == 7.0


def test_jobs_take_any_stream_of_records(spark, tmp_path):
    """Messages with a record in their value, one of them broken, through the same jobs as a landing folder."""
    land(tmp_path / "landing", reading("a", 0), reading("b", 5), reading("a", 0), reading("last", 60 * 24))
    (tmp_path / "landing" / "broken.jsonl").write_text("{no\n")

    def messages():
        raw = spark.readStream.text(str(tmp_path / "landing")).withColumn("value", F.col("value").cast("binary"))
        return stream.records_of(raw)

    silver, progress, rejected = (str(tmp_path / p) for p in ("silver", "progress", "rejected"))
    for _ in range(2):
        stream.run_silver(spark, messages(), silver, progress, RUN, rejected_path=rejected).awaitTermination()
    assert sorted(r.event_id for r in tables.read_parquet(spark, silver, schemas.SILVER_TRAFFIC).collect()) == ["a", "b", "last"]
    assert [r.record for r in spark.read.parquet(rejected).filter("reason = 'not a JSON record'").collect()] == ["{no"]
    stream.run_congestion(spark, messages(), str(tmp_path / "windows"), str(tmp_path / "w"), RUN).awaitTermination()
    assert [r.reading_count for r in spark.read.parquet(str(tmp_path / "windows")).collect()] == [2]

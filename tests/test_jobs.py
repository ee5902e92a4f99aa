from __future__ import annotations

import datetime as dt
import json
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks import registry
from curbsight import schemas, session
from curbsight.operators import traffic_gold
from curbsight.plans import jobs
from curbsight.sources import tables
from tests.rows import change_line, minutes, traffic

RUN = dt.datetime(2024, 1, 11, 9, 0)


def write_lines(path, *lines):
    path.mkdir(parents=True, exist_ok=True)
    name = f"part-{len(list(path.iterdir()))}.jsonl"
    (path / name).write_text("\n".join(json.dumps(x) for x in lines) + "\n")


def content(frame):
    return sorted(map(tuple, frame.drop("silver_processed_at", "processed_at").collect()), key=repr)


def test_silver_rebuild_is_idempotent(spark, tmp_path):
    bronze, silver = tmp_path / "bronze", str(tmp_path / "silver")
    write_lines(bronze, change_line("INSERT", "1"), change_line("INSERT", "2", -5.0, sensor="AQ_2"))
    first = jobs.bronze_to_silver(spark, str(bronze), silver, RUN)
    rows = content(spark.read.parquet(silver))
    assert jobs.bronze_to_silver(spark, str(bronze), silver, RUN) == first
    assert content(spark.read.parquet(silver)) == rows and len(rows) == 1
    assert (first["rows_in"], first["rows_valid"], first["rows_rejected"], first["failed_pm25"]) == (2, 1, 1, 1)


def test_quarantine_holds_what_silver_leaves_out(spark, tmp_path):
    bronze, path = tmp_path / "bronze", str(tmp_path / "quarantine")
    write_lines(bronze, change_line("INSERT", "1"), change_line("INSERT", "2", -5.0, sensor="AQ_2"))
    (bronze / "broken.jsonl").write_text('{"cdc_event_id": "x", \n')
    jobs.bronze_quarantine(spark, str(bronze), path, RUN)
    rows = {r.reason: r for r in spark.read.parquet(path).collect()}
    assert set(rows) == {"pm25", "not a JSON record"}
    assert rows["pm25"].record_id == "c2" and json.loads(rows["pm25"].record)["pm25"] == -5.0


def test_empty_input_stops_early(spark, tmp_path):
    bronze = tmp_path / "bronze"
    bronze.mkdir()
    assert jobs.bronze_to_silver(spark, str(bronze), str(tmp_path / "silver"), RUN) is None
    assert not (tmp_path / "silver").exists()
    empty = spark.createDataFrame([], schemas.SILVER_TRAFFIC)
    assert jobs.build_gold(empty, str(tmp_path / "gold"), jobs.TRAFFIC, RUN) == []


def readings(spark, *extra):
    return traffic(
        spark,
        {"event_id": "a"}, {"event_id": "b", "reading_datetime": minutes(60 * 24), "vehicle_count": 90},
        {"event_id": "c", "reading_datetime": minutes(60 * 24 * 30), "incident_detected": True}, *extra,
    )


def test_refresh_of_some_days_equals_a_rebuild(spark, tmp_path):
    grown = readings(spark, {"event_id": "d", "reading_datetime": minutes(60 * 24 + 5), "avg_speed_mph": 3.0,
                             "sensor_id": "TR_9", "incident_detected": True})
    part, full = str(tmp_path / "part"), str(tmp_path / "full")
    jobs.build_gold(readings(spark), part, jobs.TRAFFIC, RUN)
    names = jobs.build_gold(grown, part, jobs.TRAFFIC, RUN, days=[minutes(60 * 24).date()])
    jobs.build_gold(grown, full, jobs.TRAFFIC, RUN)
    for name in names:
        a, b = spark.read.parquet(f"{full}/{name}"), spark.read.parquet(f"{part}/{name}")
        assert content(a) == content(b.select(*a.columns)), name


def test_a_refresh_clears_days_that_lost_their_rows(spark, tmp_path):
    """Incidents corrected away, a day without readings, silver without any row, a first run for some days."""
    day = minutes(60 * 24 * 30).date()
    calm = readings(spark).withColumn("incident_detected", F.lit(False))
    gone = readings(spark).filter(F.to_date("reading_datetime") != F.lit(day))
    for number, (after, left) in enumerate(((calm, 3), (gone, 2), (readings(spark).limit(0), 2))):
        part, full = str(tmp_path / f"part{number}"), str(tmp_path / f"full{number}")
        jobs.build_gold(readings(spark), part, jobs.TRAFFIC, RUN)
        names = jobs.build_gold(after, part, jobs.TRAFFIC, RUN, days=[day])
        assert len(names) == 1 + len(jobs.TRAFFIC.tables)
        jobs.build_gold(gone if number == 2 else after, full, jobs.TRAFFIC, RUN)
        for table in (jobs.TRAFFIC.rollup, *jobs.TRAFFIC.tables):
            schema = jobs.gold_schema(spark, jobs.TRAFFIC, table)
            a, b = (tables.read_parquet(spark, f"{p}/{table.name}", schema) for p in (full, part))
            assert content(a) == content(b), table.name
        assert spark.read.parquet(f"{part}/traffic_daily_summary").count() == left
    first = str(tmp_path / "first")
    assert jobs.build_gold(readings(spark), first, jobs.TRAFFIC, RUN, days=[day])
    assert spark.read.parquet(f"{first}/traffic_daily_summary").count() == 1


def test_catalog_follows_the_folders(spark, tmp_path):
    """A city without incidents, a refreshed day, a rebuild with fewer days and another schema."""
    gold = str(tmp_path / "gold")
    calm = readings(spark).withColumn("incident_detected", F.lit(False))
    jobs.build_gold(calm, gold, jobs.TRAFFIC, RUN)
    names = jobs.register_gold(spark, "kept_gold", gold, jobs.TRAFFIC)
    assert spark.table("kept_gold.traffic_incidents").count() == 0
    jobs.build_gold(readings(spark), gold, jobs.TRAFFIC, RUN, days=[minutes(60 * 24 * 30).date()])
    jobs.register_gold(spark, "kept_gold", gold, jobs.TRAFFIC)
    assert spark.table("kept_gold.traffic_incidents").count() == 1
    jobs.build_gold(calm.limit(1), gold, jobs.TRAFFIC, RUN)
    jobs.register_gold(spark, "kept_gold", gold, jobs.TRAFFIC)
    hours = spark.sql("SHOW PARTITIONS kept_gold.traffic_hourly_by_intersection")
    assert hours.count() == 1 and spark.table("kept_gold.traffic_incidents").count() == 0
    spark.sql("DROP TABLE kept_gold.traffic_incidents")
    spark.sql(f"CREATE TABLE kept_gold.traffic_incidents (old int, year int) USING parquet PARTITIONED BY (year) "
              f"LOCATION '{gold}/traffic_incidents'")
    jobs.register_gold(spark, "kept_gold", gold, jobs.TRAFFIC)
    assert "incident_severity" in spark.table("kept_gold.traffic_incidents").columns
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_gold_tables_can_be_queried_by_name(spark, tmp_path):
    gold = str(tmp_path / "gold")
    jobs.build_gold(readings(spark), gold, jobs.TRAFFIC, RUN)
    names = jobs.register_gold(spark, "city_gold", gold, jobs.TRAFFIC)
    assert set(names) == {f"city_gold.{t.name}" for t in (jobs.TRAFFIC.rollup, *jobs.TRAFFIC.tables)}
    row = spark.sql(
        "SELECT sum(total_readings) AS n, count(DISTINCT date) AS days FROM city_gold.traffic_daily_summary "
        "WHERE year = 2024"
    ).first()
    assert (row.n, row.days) == (3, 3)
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_month_tables_are_refreshed_from_the_rollup(spark, tmp_path):
    """Silver of the other days may be gone: the month's table still holds them."""
    gold = str(tmp_path / "gold")
    jobs.build_gold(readings(spark), gold, jobs.TRAFFIC, RUN)
    day = minutes(60 * 24).date()
    only_that_day = readings(spark).filter(F.to_date("reading_datetime") == F.lit(day))
    jobs.build_gold(only_that_day, gold, jobs.TRAFFIC, RUN, days=[day])
    assert spark.read.parquet(f"{gold}/traffic_daily_summary").count() == 3


def test_rebuild_clears_rows_that_are_gone(spark, tmp_path):
    path = str(tmp_path / "incidents")
    found = traffic_gold.incidents(readings(spark))
    tables.write_parquet(found, path)
    assert tables.read_parquet(spark, path, found.schema).count() == 1
    assert not tables.write_unless_empty(found.limit(0), path)
    assert tables.read_parquet(spark, path, found.schema).count() == 1
    tables.write_parquet(found.limit(0), path)
    assert tables.read_parquet(spark, path, found.schema).count() == 0


def test_refreshed_days_may_become_empty(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS incident_days")
    found = traffic_gold.incidents(
        traffic(spark, {"incident_detected": True}, {"incident_detected": True, "reading_datetime": minutes(60 * 24)})
    )
    found.write.partitionBy(*tables.DAILY).saveAsTable("incident_days")
    days = [minutes(0).date(), minutes(60 * 24).date()]
    tables.refresh_days(spark, "incident_days", found.filter("day = 10"), days)
    assert [r.day for r in spark.table("incident_days").collect()] == [10]
    spark.sql("DROP TABLE incident_days")


def test_only_wanted_folders_are_read(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_parquet(readings(spark).select(*schemas.SILVER_TRAFFIC.names), path, by=tables.HOURLY)
    table = tables.read_parquet(spark, path, schemas.SILVER_TRAFFIC)
    day = tables.only_days(table, [minutes(0).date()])
    assert len(day.inputFiles()) == 3 and day.count() == 1
    scan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "(year" in scan.split("PartitionFilters: [")[1]


def test_scratch_needs_a_named_folder_on_a_cluster(spark):
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")

    class Cluster:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "yarn"
            applicationId = "app"

    with pytest.raises(RuntimeError):
        session.shared_dir(Cluster)
    Cluster.conf.get = staticmethod(lambda key, default=None: "hdfs://shared/dir/")
    assert session.shared_dir(Cluster) == "hdfs://shared/dir"


def test_landed_records_are_compressed_in_files_that_are_read_side_by_side(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "LANDED_RECORDS", 100)
    path = tmp_path / "bronze"
    for first in (0, 1000):
        registry.land(spark.range(first, first + 1000, numPartitions=2).selectExpr("cast(id as string) as cdc_event_id"), str(path))
    files = list(path.glob("part-*"))
    assert len(files) == 20 and all(f.name.endswith(".json.gz") for f in files)
    read = tables.read_air_bronze(spark, str(path)).select("cdc_event_id").collect()
    assert sorted(int(r[0]) for r in read) == list(range(2000))


def test_row_digest_tells_rows_apart(spark):
    """Values that move to a neighbouring column or item, and NULL in every place."""
    kinds = "a string, b string, n int, m int, x double, t timestamp, d decimal(38,0), l array<struct<c:string,k:int>>"
    stamp, high = dt.datetime(2024, 1, 1), Decimal(10**25)
    other = [
        (None,) * 8, ("u", None, None, None, None, None, None, None), (None, "u", None, None, None, None, None, None),
        ("", None, None, None, None, None, None, None), ("uv", "", 1, None, None, None, None, None), ("u", "v", 1, None, None, None, None, None),
        ("u", "v", None, 1, None, None, None, None), ("u", "v", 1, 0, None, None, None, None), ("u", "v", 1, 0, 0.0, stamp, high, []),
        ("u", "v", 1, 0, 0.5, stamp, high, []), ("u", "v", 1, 0, 0.5, stamp, high + 1, []), ("u", "v", 1, 0, 0.5, stamp, high, None),
        ("u", "v", 1, 0, 0.5, stamp, high, [(None, 1)]), ("u", "v", 1, 0, 0.5, stamp, high, [("w", 1)]),
        ("u", "v", 1, 0, 0.5, stamp, high, [("w", None), (None, 1)]),
    ]
    rows = spark.createDataFrame(other * 2, kinds)
    row, again = registry.row_digest({f.name: (F.col(f.name), f.dataType) for f in rows.schema.fields})
    found = rows.select(row, again).collect()
    for part in (0, 1):
        assert len({r[part] for r in found}) == len(other)
    assert found[: len(other)] == found[len(other):] and all(r[0] != r[1] for r in found)


def test_a_refresh_is_compared_by_numbers_and_sees_other_values(spark, tmp_path, monkeypatch):
    """Whole rows as text made up most of what the job sent; two numbers a row are left."""
    monkeypatch.setattr(registry, "scratch_dir", lambda _, label: str(tmp_path / label))
    silver = readings(spark)
    days = sorted({r[0] for r in silver.select(F.to_date("reading_datetime")).collect()})
    slower = silver.withColumn("avg_speed_mph", F.col("avg_speed_mph") + 1)
    for refreshed, alike in ((days, True), ([dt.date(2023, 5, 5)], False)):
        counts = registry.refreshed(spark, jobs.TRAFFIC, silver, slower, refreshed)
        plan = counts._jdf.queryExecution().executedPlan().toString()
        sent = [line for line in plan.splitlines() if "Exchange hashpartitioning(year" in line and "row#" in line]
        assert sent and all(re.search(r"row#\d+L, again#\d+L", line) for line in sent)
        rows = [r for r in counts.collect() if r.table_name in ("traffic_sensor_quarters", "traffic_hourly_by_intersection")]
        assert len(rows) == 2 * len(days) and all(r.n_rows == r.n_rebuilt == 1 for r in rows)
        assert {r.n_as_rebuilt for r in rows} == {int(alike)}

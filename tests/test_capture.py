"""Capture of the change feed: each record once under retries, and nothing of a document lost."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbsight import schemas
from curbsight.functions import documents
from curbsight.functions.documents import attribute_report, decode_open_documents
from curbsight.sources import tables
from curbsight.streaming import air_changes, capture

RUN = dt.datetime(2024, 1, 11, 9, 30)

TARGET = schemas.struct(
    ("a", schemas.TEXT), ("n", schemas.WHOLE), ("p", schemas.struct(("q", schemas.WHOLE), ("deep", schemas.struct(("x", schemas.REAL))))),
    ("l", T.ArrayType(schemas.WHOLE)), ("m", T.MapType(schemas.TEXT, schemas.WHOLE)))


def rest_of(spark, *documents):
    rows = [(i, d if d is None or isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)]
    decoded = decode_open_documents(spark.createDataFrame(rows, "i int, d string"), {"d": TARGET})
    assert decoded.columns == ["i", "d", "d_rest"]
    found = {r.i: r.rest for r in decoded.select("i", F.col("d_rest").cast("string").alias("rest")).collect()}
    return [None if found[i] is None else json.loads(found[i]) for i in range(len(rows))]


def test_what_no_schema_declares_is_kept(spark):
    (rest,) = rest_of(spark, {
        "a": {"S": "declared"}, "note": {"S": "x\"y"}, "whole": {"N": "12"}, "part": {"N": "1.50"},
        "large": {"N": "123456789012345678901"}, "power": {"N": "1e5"}, "no_number": {"N": "x1"}, "flag": {"BOOL": False}, "none": {"NULL": True},
        "map": {"M": {"k": {"N": "1"}, "z": {"L": [{"S": "q"}, {"BOOL": True}, {"M": {}}]}}}, "bytes": {"BS": ["AQI=", "Aw=="]},
        "texts": {"SS": ["u", "v"]}, "numbers": {"NS": ["1", "2.5", "x"]}, "unknown": {"QQ": [5]}, "two": {"S": "a", "N": "1"},
        "plain": 7, "empty": {}, "no_items": {"L": []}})
    assert rest == {
        "note": "x\"y", "whole": 12, "part": 1.5, "large": 123456789012345678901, "power": 100000, "no_number": "x1", "flag": False,
        "none": None, "map": {"k": 1, "z": ["q", True, {}]}, "bytes": ["AQI=", "Aw=="], "texts": ["u", "v"],
        "numbers": [1, 2.5, "x"], "unknown": {"QQ": [5]}, "two": {"S": "a", "N": "1"}, "plain": 7, "empty": {}, "no_items": []}


def test_members_of_declared_structs_and_values_of_another_kind(spark):
    found = rest_of(
        spark,
        {"p": {"M": {"q": {"N": "1"}, "r": {"S": "new"}, "deep": {"M": {"x": {"N": "1.5"}, "y": {"N": "2"}}}}}},
        {"a": {"M": {"v": {"S": "s"}}}, "p": {"S": "no map"}, "n": {"S": "many"}},
        {"l": {"L": [{"N": "1"}, {"S": "two"}]}, "m": {"M": {"k": {"N": "1"}, "j": {"BOOL": True}}}},
        {"a": {"NULL": True}, "p": {"NULL": True}, "l": {"NS": ["1", "2"]}, "m": {"M": {}}, "n": {"N": "3.0"}},
        {"a": {"S": ""}}, {}, None)
    assert found[:3] == [
        {"p": {"r": "new", "deep": {"y": 2}}}, {"a": {"v": "s"}, "p": "no map", "n": "many"},
        {"l": [1, "two"], "m": {"k": 1, "j": True}}]
    assert found[3:] == [None] * 4


def test_text_that_is_no_document_is_kept_as_it_is(spark):
    rows = spark.createDataFrame([("{bad",), ("[1]",)], "d string")
    kept = decode_open_documents(rows, {"d": TARGET}).select(F.col("d_rest").cast("string")).collect()
    assert sorted(r[0] for r in kept) == ["[1]", "{bad"]


@pytest.mark.parametrize("levels", [2, 4, 9])
def test_what_is_too_deep_keeps_its_tags(spark, levels):
    document, plain = {"S": "end"}, "end"
    for i in range(levels):
        document, plain = ({"M": {"k": document}}, {"k": plain}) if i % 2 else ({"L": [document]}, [plain])
    (rest,) = rest_of(spark, {"u": document})

    def untagged(value):
        if isinstance(value, list):
            return [untagged(v) for v in value]
        if isinstance(value, dict):
            if set(value) <= {"S", "M", "L"}:
                return untagged(next(iter(value.values())))
            return {k: untagged(v) for k, v in value.items()}
        return value

    assert untagged(rest["u"]) == plain and (rest["u"] == plain) == (levels <= 3)


def record(number, **new):
    image = {"sensor_id": {"S": f"AQ_{number}"}, "timestamp": {"S": "2024-01-10T08:00:00Z"}, **new}
    return {"eventID": f"e{number}", "eventName": "INSERT", "eventSource": "aws:dynamodb", "awsRegion": "r",
            "dynamodb": {"SequenceNumber": str(number), "SizeBytes": 5, "Keys": {"sensor_id": {"S": f"AQ_{number}"}}, "NewImage": image}}


def land(folder, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n"
    (folder / f"part-{len(list(folder.iterdir())):03d}.jsonl").write_text(text)


def run(spark, base, run_at=RUN, **kind):
    paths = [str(base / p) for p in ("landing", "bronze", "failed", "progress")]
    capture.run_capture(spark, *paths, run_at, **kind).awaitTermination()
    return tables.read_air_bronze(spark, paths[1])


def test_every_record_is_captured_once(spark, tmp_path):
    land(tmp_path / "landing", record(1), record(2), "no json")
    first = sorted(map(str, run(spark, tmp_path).collect()))
    assert len(first) == 2
    assert sorted(map(str, run(spark, tmp_path, RUN + dt.timedelta(hours=1)).collect())) == first
    land(tmp_path / "landing", record(3), {**record(4), "eventSource": "other:queue"})
    rows = run(spark, tmp_path, RUN + dt.timedelta(hours=2)).select("cdc_event_id", "partition_hour").collect()
    assert sorted(map(tuple, rows)) == [("e1", "09"), ("e2", "09"), ("e3", "11")]
    failed = spark.read.option("recursiveFileLookup", "true").json(str(tmp_path / "failed")).collect()
    assert [(r.record, r.reason) for r in failed] == [("no json", "not a JSON record")]


def test_a_batch_run_again_replaces_its_own_rows(spark, tmp_path):
    """The second attempt has another clock; the rows and their folder are those of the first one."""
    land(tmp_path / "landing", record(1), record(2))
    records = tables.read_change_records(spark, str(tmp_path / "landing"))
    paths = [str(tmp_path / p) for p in ("bronze", "failed", "staged")]
    kept = []
    for hours in (0, 5):
        capture.capture_batch(records, *paths, "q-0", RUN + dt.timedelta(hours=hours))
        kept.append(sorted(map(str, tables.read_air_bronze(spark, paths[0]).collect())))
    capture.capture_batch(records, *paths[:2], str(tmp_path / "other"), "q-1", RUN)
    assert kept[0] == kept[1] and len(kept[0]) == 2
    assert tables.read_air_bronze(spark, paths[0]).count() == 4


def test_nothing_landed(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    capture.run_capture(spark, *(str(tmp_path / p) for p in ("landing", "bronze", "failed", "progress")), RUN).awaitTermination()
    assert not (tmp_path / "bronze").exists()


def test_open_attributes_survive_bronze_and_don_t_disturb_silver(spark, tmp_path):
    land(tmp_path / "landing", record(1, site={"N": "7"}, measurements={"M": {"pm25": {"N": "3"}, "co": {"N": "0.4"}}}),
         record(2, site={"S": "x"}))
    bronze = run(spark, tmp_path)
    rows = {r[0]: r[1] for r in bronze.select("cdc_event_id", F.col("new_image_rest").cast("string")).collect()}
    assert {k: json.loads(v) for k, v in rows.items()} == {"e1": {"site": 7, "measurements": {"co": 0.4}}, "e2": {"site": "x"}}
    report = {(r.document, r.attribute): (r.n, r.kind) for r in attribute_report(bronze, ["keys", "old_image", "new_image"]).collect()}
    assert report[("new_image", "site")] == (2, "VARIANT") and report[("new_image", "measurements")][0] == 1
    air_changes.run_incremental(spark, str(tmp_path / "bronze"), str(tmp_path / "state"), str(tmp_path / "p"), RUN).awaitTermination()
    state = tables.read_parquet(spark, str(tmp_path / "state"), schemas.SILVER_AIR_STATE).collect()
    assert sorted((r.sensor_id, r.pm25) for r in state) == [("AQ_1", 3.0), ("AQ_2", None)]


CLOSED = (
    "{}", '{"sensor_id":{"S":"AQ_1"}}', '{"is_active":{"BOOL":true},"sensor_id":{"N":"1"},"timestamp":{"NULL":true}}',
    '{"created_at":{"NULL":true},"measurements":{"M":{"pm25":{"N":"1.5"},"co2":{"S":"\u00fc"}}},"aqi":{"M":{}}}',
    '{"location":{"NULL":true},"timestamp":{"BOOL":false},"is_active":{"NULL":true},"event_id":{"S":""}}',
)
OPEN = (
    '{"sensor_id":{"S":"a"},"sensor_id":{"S":"b"}}', '{"aqi":{"M":{"value":{"N":"1"},"value":{"N":"1"}}}}',
    '{"aqi":{"M":{}},"aqi":{"M":{}}}', '{"created_at":{"NULL":true},"created_at":{"NULL":true}}',
    '{"sensor_id":{"S":"a"},"site":{"S":"b"}}', '{"location":{"M":{"zone":{"S":"z"},"floor":{"N":"2"}}}}', '{"location":{"S":"z"}}',
    '{"sensor_id":{"S":"a","N":"1"}}', '{"sensor_id":{"QQ":"a"}}', '{"sensor_id":{}}', '{"sensor_id":"a"}', '{"sensor_id":null}',
    '{"sensor_id":{"S":null}}', '{"sensor_id":{"N":1}}', '{"sensor_id":{"NULL":false}}', '{"is_active":{"S":"yes"}}', '{"is_active":{"S":"true"}}',
    '{"sensor_id":{"S":"a\\"b"}}', '{"sensor_id":{"S":"a\tb"}}', '{"sensor_id":{"S":"a"},}', '{"sensor_id":{"S":"a"}} x',
    '{ "sensor_id" : {"S": "a"} }', '{"sensor_id":{"S":"a"}}\n', '{"Sensor_Id":{"S":"a"}}', "[1]", "{bad", "", "null",
    '{"sensor_id":{"S":"a\\",\\"site\\":{\\"S\\":\\"b"}}', '{"measurements":{"M":{"pm25":{"M":{"x":{"N":"1"}}}}}}',
)


def test_documents_without_a_rest_are_told_from_their_text(spark):
    """They need no second reading as variants, which took most of a capture's time."""
    rows = spark.createDataFrame(enumerate((*CLOSED, *OPEN, None)), "i int, d string")
    parsed = rows.withColumn("w", F.from_json("d", documents.wire_fields(schemas.AIR_DOCUMENT)))
    told = parsed.select("i", documents._is_closed(F.col("d"), F.col("w"), schemas.AIR_DOCUMENT)).collect()
    assert [is_closed for _, is_closed in sorted(told)] == [True] * len(CLOSED) + [False] * (len(OPEN) + 1)


def test_telling_closed_documents_changes_no_result(spark, monkeypatch):
    rows = spark.createDataFrame(enumerate((*CLOSED, *OPEN, None)), "i int, d string")

    def decoded(target):
        rest = F.col("d_rest").cast("string").alias("rest")
        return sorted(map(str, decode_open_documents(rows, {"d": target}).select("i", "d", rest).collect()))

    with_test = [decoded(target) for target in (schemas.AIR_DOCUMENT, TARGET)]
    monkeypatch.setattr(documents, "_is_closed", lambda text, wire, target: F.lit(False))
    assert with_test == [decoded(target) for target in (schemas.AIR_DOCUMENT, TARGET)]


def test_a_long_document_needs_no_deep_stack(spark):
    names = [f"a{i}" for i in range(300)]
    target = schemas.struct((" ".join(names), schemas.TEXT))
    text = json.dumps({n: {"S": "x" * 3000} for n in names}, separators=(",", ":"))
    parsed = spark.createDataFrame([(text,)], "d string").withColumn("w", F.from_json("d", documents.wire_fields(target)))
    assert parsed.select(documents._is_closed(F.col("d"), F.col("w"), target)).first()[0]

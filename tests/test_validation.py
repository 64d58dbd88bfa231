import json

import pytest
from pyspark.sql import functions as F

from conftest import frame, values
from tidewire.functions.times import iso
from tidewire.operators import ingest, validate

GOOD = {
    "eventId": "018cc252-100b-7a73-918f-ee28f55df31a",
    "deviceId": "dev-1",
    "timestamp": "2024-01-01T10:00:00Z",
    "ingestedAt": "2024-01-01T10:00:01.250Z",
    "schemaVersion": "1.0",
    "metrics": {"temperature": 21.5, "count": 3},
    "tags": {"region": "us-east"},
    "source": "http",
}


def event(**changes):
    body = {k: v for k, v in {**GOOD, **changes}.items() if v is not ...}
    return json.dumps(body, ensure_ascii=False)


CASES = [
    (None, "empty"),
    ("", "empty"),
    ('{"a":', "invalid_json"),
    ("{'a':1}", "invalid_json"),
    ('{"a":NaN}', "invalid_json"),
    ('{"a":01}', "invalid_json"),
    ("   ", "invalid_json"),
    ("1,2", "invalid_json"),
    (event() + " x", "invalid_json"),
    (event() + "]", "invalid_json"),
    (event() + "] x", "invalid_json"),
    (event() + "}", "invalid_json"),
    (event() + "}} x", "invalid_json"),
    (event() + event(), "invalid_json"),
    ("5", "schema_invalid"),
    ("null", "schema_invalid"),
    ("[]", "schema_invalid"),
    ("{}", "schema_invalid"),
    (event(), "ok"),
    ("\n " + event() + " \t", "ok"),
    (event(extra=[1, {"x": "]"}]), "ok"),
    (event(metrics={}), "ok"),
    (event(tags=...), "ok"),
    (event(tags={}), "ok"),
    (event(tags=None), "schema_invalid"),
    (event(tags={"a": 1}), "schema_invalid"),
    (event(tags=["a"]), "schema_invalid"),
    (event(metrics=...), "schema_invalid"),
    (event(metrics=None), "schema_invalid"),
    (event(metrics=[1]), "schema_invalid"),
    (event(metrics={"t": "5"}), "schema_invalid"),
    (event(metrics={"t": None}), "schema_invalid"),
    (event(metrics={"t": True}), "schema_invalid"),
    (event(metrics={"t": {"x": 1}}), "schema_invalid"),
    (event(metrics={"t": 1}).replace('"t": 1', '"t": 1e400'), "schema_invalid"),
    (event(metrics={"t": 1}).replace('"t": 1', '"t": 1e300'), "ok"),
    (event(metrics={"": 1}), "schema_invalid"),
    (event(metrics={"m" * 64: 1}), "ok"),
    (event(metrics={"m" * 65: 1}), "schema_invalid"),
    (event(metrics={"\U0001f321" * 32: 1}), "ok"),
    (event(metrics={"\U0001f321" * 33: 1}), "schema_invalid"),
    (event(deviceId=""), "schema_invalid"),
    (event(deviceId="d" * 128), "ok"),
    (event(deviceId="d" * 129), "schema_invalid"),
    (event(deviceId=5), "schema_invalid"),
    (event(eventId="nope"), "schema_invalid"),
    (event(timestamp="2024-01-01T10:00:00"), "schema_invalid"),
    (event(timestamp="2024-01-01"), "schema_invalid"),
    (event(timestamp=1704103200), "schema_invalid"),
    (event(timestamp="2024-02-30T10:00:00Z"), "schema_invalid"),
    (event(timestamp="2024-01-01T10:00:00+05:30"), "ok"),
    (event(schemaVersion="1"), "schema_invalid"),
    (event(schemaVersion=1.0), "schema_invalid"),
    (event(source="kafka"), "schema_invalid"),
    (event().replace('"source"', '"source": "kafka", "source"'), "ok"),
    (event().replace('"source": "http"', '"source": "http", "source": "kafka"'), "schema_invalid"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, text) for i, (text, _) in enumerate(CASES)]
    return validate.parse_events(frame(spark, rows, "id int, value string")).cache()


def test_status_of_every_case(parsed):
    found = {r["id"]: r["status"] for r in parsed.collect()}
    wrong = [(CASES[i], found[i]) for i in range(len(CASES)) if found[i] != CASES[i][1]]
    assert wrong == []


def test_routes_cover_the_input(parsed):
    counts = {r["status"]: r["count"] for r in parsed.groupBy("status").count().collect()}
    assert sum(counts.values()) == len(CASES)
    letters = validate.dead_letters(parsed, F.lit("2024-01-01").cast("timestamp")).count()
    assert letters == counts["invalid_json"] + counts["schema_invalid"]


def test_offset_becomes_utc(spark):
    text = event(timestamp="2024-01-01T10:00:00+05:30")
    row = validate.parse_events(frame(spark, [(text,)], "value string")).select(iso(F.col("timestamp"))).first()
    assert row[0] == "2024-01-01T04:30:00.000Z"


def test_dead_letter_holds_the_first_thousand_characters(spark):
    parsed = validate.parse_events(frame(spark, [("{" + "x" * 5000,)], "value string"))
    row = validate.dead_letters(parsed, F.lit("2024-01-01").cast("timestamp")).first()
    assert len(row["raw"]) == 1000 and row["reason"] == "invalid_json"


def test_message_round_trip(spark):
    events = validate.valid_events(validate.parse_events(frame(spark, [(event(),)], "value string")))
    again = validate.parse_events(ingest.to_log_record(events))
    assert values(again.select(*validate.EVENT_COLUMNS)) == values(events.select(*validate.EVENT_COLUMNS))


def test_batch_takes_all_or_none(spark):
    one = {"deviceId": "d", "metrics": {"t": 1}}
    bodies = [[one] * 1000, [one] * 1001, [one, {"deviceId": "d"}], [], [one]]
    rows = [(i, "2024-01-01 00:00:00", json.dumps({"events": b})) for i, b in enumerate(bodies)]
    requests = frame(spark, rows, "request_id int, received_at string, body string")
    accepted = ingest.ingest_batch(requests)
    assert values(accepted.groupBy("request_id").count()) == [(0, 1000), (4, 1)]
    assert accepted.select("event_id").distinct().count() == 1001


def test_device_metadata(spark):
    rows = [
        ('{"deviceId":"d","name":"n"}', "ok"),
        ('{"deviceId":"d","name":""}', "schema_invalid"),
        ('{"deviceId":"d","name":"n","model":""}', "ok"),
        ('{"deviceId":"d","name":"n","region":5}', "schema_invalid"),
        ('{"deviceId":"d","name":"n","tags":null}', "schema_invalid"),
        ("x", "invalid_json"),
    ]
    found = validate.device_status(frame(spark, rows, "value string, expected string"))
    assert found.filter("status <> expected").collect() == []

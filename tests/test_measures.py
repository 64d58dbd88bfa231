"""Counters and histograms of running jobs: repeated triggers, failed sends, files of a sink."""

import os

import pytest
from conftest import values
from pyspark.sql import functions as F

from tidewire.operators import quality, validate
from tidewire.schemas import TOPIC_ALERTS
from tidewire.sources import event_log
from tidewire.streaming import jobs, marks, measures


def parsed(spark, n=40, start=0):
    """Messages of which every fifth is no JSON and every seventh has no device."""
    body = (
        '{"eventId":"00000000-0000-7000-8000-%012d","deviceId":"%s","timestamp":"2024-01-01T00:00:00Z","ingestedAt":"2024-01-01T00:00:00Z",'
        '"schemaVersion":"1.0","metrics":{"temperature":%d},"source":"http"}'
    )
    rows = [("{" if i % 5 == 0 else body % (i, "" if i % 7 == 0 else "d", i), i) for i in range(start, start + n)]
    log = spark.createDataFrame(rows, "value string, i int").selectExpr("value", "timestamp_seconds(1704067200 + i) as arrived_at")
    return validate.parse_events(log)


def outputs(tmp_path):
    return jobs.RealtimeOutputs(*[str(tmp_path / n) for n in ("alerts", "live", "state", "log")])


def counted(spark, held):
    return {(r.name, r.labels): r.value for r in held.counters(spark).collect()}


def expected(ids):
    good = [i for i in ids if i % 5 and i % 7]
    return {
        ("processor_events_processed_total", "status=ok"): len(good),
        ("processor_dlq_total", "reason=invalid_json"): sum(i % 5 == 0 for i in ids),
        ("processor_dlq_total", "reason=schema_invalid"): sum(i % 5 > 0 and i % 7 == 0 for i in ids),
        ("processor_alerts_fired_total", "severity=warning"): sum(i > 30 for i in good),
        ("processor_alerts_fired_total", "severity=critical"): sum(i > 40 for i in good),
    }


def batch(job):
    """The function that a job gives to foreachBatch."""
    seen = []

    class Writer:
        def foreachBatch(self, process):
            seen.append(process)

    class Stream:
        writeStream = Writer()

    job(Stream())
    return seen[0]


def test_a_repeated_trigger_counts_once(spark, tmp_path):
    held = measures.Measures(str(tmp_path / "measures"), compact_every=3)
    accepted = marks.Marks(str(tmp_path / "accepted"), jobs.valid_stream(parsed(spark)).schema)
    process = batch(lambda s: jobs.measured_realtime_job(s, outputs(tmp_path), accepted, held, str(tmp_path / "dlq")))
    for n in (0, 0, 1, 1, 2):
        process(parsed(spark, 40, 40 * n), n)
    ids = range(120)
    assert counted(spark, held) == expected(ids)
    # The same messages in a later trigger are duplicates.
    process(parsed(spark, 40), 3)
    again = counted(spark, held)
    assert again["processor_duplicates_total", ""] == expected(range(40))["processor_events_processed_total", "status=ok"]
    assert again["processor_events_processed_total", "status=ok"] == expected(ids)["processor_events_processed_total", "status=ok"]
    found = {r.le: r.value for r in held.histograms(spark).collect()}
    assert found["count"] == found["+Inf"] == again["processor_events_processed_total", "status=ok"] and found["sum"] > 0
    assert set(found) == {*map(str, quality.DURATIONS["processor_event_duration_seconds"]), "+Inf", "count", "sum"}
    assert spark.read.parquet(str(tmp_path / "dlq")).count() == sum(n for (name, _), n in again.items() if name == "processor_dlq_total")


def test_batch_job_counts_what_it_stored(spark, tmp_path):
    held, table = measures.Measures(str(tmp_path / "m")), jobs.telemetry_table(str(tmp_path / "t"))
    process = batch(lambda s: jobs.measured_telemetry_job(s, table, held))
    process(parsed(spark), 0)
    # Stored, but the trigger stopped before it was counted.
    table.append(jobs.flatten.to_telemetry(validate.valid_events(parsed(spark, 40, 40))), "telemetry", 1)
    for _ in range(2):
        process(parsed(spark, 40, 40), 1)
    got, want = counted(spark, held), expected(range(80))
    assert got["batch_events_inserted_total", ""] == want["processor_events_processed_total", "status=ok"] == table.read(spark).count()
    assert got["batch_events_invalid_total", "reason=invalid_json"] == want["processor_dlq_total", "reason=invalid_json"]


def test_failed_sends_are_counted_and_fail(spark, tmp_path, monkeypatch):
    held = measures.Measures(str(tmp_path / "m"))
    monkeypatch.setattr(event_log, "publish", lambda *a: (_ for _ in ()).throw(OSError("no broker")))
    accepted = marks.Marks(str(tmp_path / "accepted"), jobs.valid_stream(parsed(spark)).schema)
    process = batch(lambda s: jobs.measured_realtime_job(s, outputs(tmp_path), accepted, held, str(tmp_path / "dlq")))
    for _ in range(2):
        with pytest.raises(OSError):
            process(parsed(spark, 60), 0)
    assert counted(spark, held) == {("kafka_producer_errors_total", f"topic={TOPIC_ALERTS}"): 2}


def test_files_of_the_archive(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "bronze")
    rows = parsed(spark, 60)
    for n in range(3):
        rows.filter(F.col("arrived_at").cast("long") % 3 == n).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        jobs.start(jobs.archive_job(stream, path), str(tmp_path / "c"), {"availableNow": True}).awaitTermination()
    files = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    got = {(r.name, r.labels): r.value for r in measures.archive_counters(spark, path).collect()}
    assert got == {
        ("archive_files_written_total", "zone=telemetry"): len(files),
        ("archive_bytes_written_total", ""): sum(map(os.path.getsize, files)),
    }
    assert measures.archive_counters(spark, str(tmp_path / "none")).collect() == []


def test_silver_measures_add_up_over_runs(spark):
    runs = spark.createDataFrame(
        [(2, 0, 10, 8, 2, 400.0), (1, 2, 5, 5, 0, 1500.0), (3, 3, 7, 6, 1, 70_000.0)],
        "processed_files bigint, skipped_files bigint, events_in bigint, events_out bigint, duplicates_removed bigint, duration_ms double",
    )
    counters, histogram = measures.silver_measures(runs)
    assert dict(values(counters, "name", "value")) == {
        "silver_files_processed_total": 6, "silver_events_in_total": 22, "silver_events_out_total": 19, "silver_duplicates_removed_total": 3
    }
    assert {r.le: r.value for r in histogram.collect()} == {
        "0.5": 1.0, "1": 1.0, "2": 2.0, "5": 2.0, "10": 2.0, "30": 2.0, "60": 2.0, "+Inf": 3.0, "count": 3.0, "sum": 71.9
    }


def test_nothing_measured(spark, tmp_path):
    held = measures.Measures(str(tmp_path / "m"))
    assert counted(spark, held) == {} and held.histograms(spark).collect() == []
    process = batch(lambda s: jobs.measured_telemetry_job(s, jobs.telemetry_table(str(tmp_path / "t")), held))
    process(parsed(spark, 0), 0)
    assert counted(spark, held) == {}

import json
import random
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import frame, values
from tidewire.operators import alerts, dedup, state, validate
from tidewire.operators.anomaly import anomaly_zscore
from tidewire.schemas import EVENT_LOG
from tidewire.sources import event_log, tables
from tidewire.streaming import jobs
from tidewire.streaming.anomaly import anomaly_stream
from tidewire.streaming.progress import ProgressLog, gauges, offset_frames

T0 = datetime(2024, 1, 1)
ALL = {"availableNow": True}


def message(i, device, t, metrics, **changes):
    body = {
        "eventId": f"00000000-0000-7000-8000-{i:012d}", "deviceId": device,
        "timestamp": f"{t.isoformat()}.000Z", "ingestedAt": f"{t.isoformat()}.000Z", "schemaVersion": "1.0",
        "metrics": metrics, "tags": {"region": "us-east"}, "source": "http", **changes,
    }
    return json.dumps(body)


def log_rows(n, seed=0, start=0):
    """Valid, broken and redelivered messages, one second apart."""
    rng = random.Random(seed)
    rows = []
    for i in range(start, start + n):
        t = T0 + timedelta(seconds=i)
        device = f"dev-{rng.randrange(3)}"
        value = message(i, device, t, {"temperature": round(rng.gauss(28, 6), 2), "humidity": round(rng.gauss(30, 9), 2)})
        if i % 11 == 3:
            value = value[:-3]
        elif i % 11 == 5:
            value = value.replace('"http"', '"kafka"')
        elif i % 11 == 7:
            value = ""
        rows.append({"key": device, "value": value, "topic": "telemetry.raw", "partition": 0, "offset": i,
                     "timestamp": t.isoformat() + "Z"})
        if i % 10 == 0 and i % 11 not in (3, 5, 7):
            rows.append({**rows[-1], "timestamp": (t + timedelta(seconds=30)).isoformat() + "Z"})
    return rows


def land(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in rows))


def read_log(spark, path):
    log = event_log.read_event_log(spark, str(path), "telemetry.raw", fmt="json", maxFilesPerTrigger="1")
    return jobs.parsed_stream(log)


def batch_log(spark, path):
    rows = spark.read.schema(EVENT_LOG).json(str(path))
    return validate.parse_events(rows.withColumnRenamed("timestamp", "arrived_at"))


def finish(writer, checkpoint, idle_batches=True):
    query = jobs.start(writer, str(checkpoint), ALL, idle_batches)
    assert query.awaitTermination(90)
    return query


def test_three_readers_restart_and_agree_with_batch(spark, tmp_path):
    log = tmp_path / "log"
    out = jobs.RealtimeOutputs(*[str(tmp_path / n) for n in ("alerts", "live", "state", "alert-log")])

    def run():
        parsed = read_log(spark, log)
        finish(jobs.realtime_job(jobs.accepted_stream(parsed), out), tmp_path / "c1", False)
        finish(jobs.dead_letter_stream(parsed).writeStream.format("json").option("path", str(tmp_path / "dlq")), tmp_path / "c2")
        finish(jobs.telemetry_job(parsed, str(tmp_path / "telemetry")), tmp_path / "c3")
        finish(jobs.archive_job(parsed, str(tmp_path / "bronze")), tmp_path / "c4")

    land(log, "a.json", log_rows(120))
    land(log, "b.json", log_rows(120, 1, 120))
    run()
    # A file that repeats earlier events arrives after a restart.
    land(log, "c.json", log_rows(80, 2, 240) + log_rows(20, 1, 120))
    run()
    run()

    parsed = batch_log(spark, log)
    valid = validate.valid_events(parsed)
    unique = dedup.realtime_dedup(valid, arrival="arrived_at").select("event_id").distinct()
    assert spark.read.json(str(tmp_path / "dlq")).count() == parsed.filter("status LIKE '%invalid%'").count()
    stored = tables.read_telemetry(spark, str(tmp_path / "telemetry"))
    assert values(stored, "event_id") == values(valid, "event_id")
    assert values(tables.read_bronze(spark, str(tmp_path / "bronze")), "event_id") == values(valid, "event_id")

    fired = jobs.read_alerts(spark, out.alerts)
    assert spark.read.parquet(out.log).count() == fired.count()
    once = valid.dropDuplicates(["event_id"])
    expected = alerts.alerts_rules(once, arrival="arrived_at")
    columns = ("device_id", "rule_id", "value")
    assert values(fired, *columns) == values(expected, *columns)
    assert fired.filter("acknowledged").count() == 0
    live = spark.read.parquet(out.live)
    assert live.filter("type = 'telemetry'").count() == unique.count()
    assert live.filter("type = 'alert'").count() == fired.count()

    kept = jobs.read_state(spark, out.state)
    newest = once.agg(F.max("arrived_at")).first()[0]
    expected = state.latest_state(once, newest, arrival="arrived_at")
    assert values(kept, "device_id", "event_id") == values(expected, "device_id", "event_id")


def test_state_expires_between_triggers(spark, tmp_path):
    log = tmp_path / "log"
    out = jobs.RealtimeOutputs(*[str(tmp_path / n) for n in ("alerts", "live", "state", "alert-log")])

    def record(i, device, t):
        return {"key": device, "value": message(i, device, t, {"t": 1.0}), "topic": "telemetry.raw",
                "partition": 0, "offset": i, "timestamp": t.isoformat() + "Z"}

    for name, row in (("a", record(1, "old", T0)), ("b", record(2, "new", T0 + timedelta(minutes=61)))):
        land(log, f"{name}.json", [row])
        finish(jobs.realtime_job(jobs.accepted_stream(read_log(spark, log)), out), tmp_path / "c", False)
    assert values(jobs.read_state(spark, out.state), "device_id") == [("new",)]
    assert len(tables.numbered(spark, out.state, "version")) == 2


def test_repeated_trigger_replaces_its_output(spark, tmp_path):
    events = validate.valid_events(validate.parse_events(frame(
        spark, [(message(i, "d", T0, {"temperature": 50.0}), T0) for i in range(5)], "value string, arrived_at timestamp"
    ))).select(*validate.EVENT_COLUMNS, "arrived_at")
    out = jobs.RealtimeOutputs(*[str(tmp_path / n) for n in ("alerts", "live", "state", "alert-log")])
    process = jobs.realtime_batch(out)
    for _ in range(2):
        process(events, 0)
    assert jobs.read_alerts(spark, out.alerts).count() == 10
    assert spark.read.parquet(out.log).count() == 10
    assert spark.read.parquet(out.live).count() == 15


def test_anomaly_stream_over_triggers(spark, tmp_path):
    rng = random.Random(4)
    rows = [("d" if i % 3 else "e", "t", f"{i:05d}", T0 + timedelta(seconds=i), rng.gauss(10, 2) + (40 if i % 97 == 0 else 0)) for i in range(400)]
    schema = "device_id string, metric string, event_id string, ts timestamp, value double"
    data = frame(spark, rows, schema)
    source = tmp_path / "samples"
    for a, b in ((0, 150), (150, 151), (151, 400)):
        frame(spark, rows[a:b], schema).coalesce(1).write.mode("append").parquet(str(source))
    # Files are read in the order they were written.
    stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    finish(anomaly_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")), tmp_path / "c")
    rounded = [F.round(F.col(c), 8).alias(c) for c in ("mean", "std_dev", "z_score")]
    keys = ["event_id", "n_samples", "is_anomaly"]
    streamed = spark.read.parquet(str(tmp_path / "out")).select(*keys, *rounded)
    assert values(streamed) == values(anomaly_zscore(data).select(*keys, *rounded))


def test_silver_stream_drops_copies_of_earlier_triggers(spark, tmp_path):
    bronze_path, silver_path, runs = (str(tmp_path / n) for n in ("bronze", "silver", "runs"))
    schema = tables.BRONZE
    rng = random.Random(8)

    def rows(ids, delay):
        return [(f"e{i}", f"d{i % 4}", T0 + timedelta(hours=i), T0 + timedelta(hours=i, seconds=delay), "1.0", "http",
                 rng.uniform(0, 50), None, None, "r", "m", 1.0, 2.0, {}, None) for i in ids]

    def run(ids, delay, flushed):
        tables.write_bronze(frame(spark, rows(ids, delay), schema).coalesce(1), bronze_path, F.lit(flushed).cast("timestamp"))
        stream = jobs.silver_stream(spark, bronze_path)
        finish(jobs.silver_job(stream, silver_path, runs), tmp_path / "c")

    run([*range(0, 50), 3, 4], 1, "2024-03-01 01:00:00")
    run(range(40, 90), 2, "2024-03-01 02:00:00")
    run(range(90, 90), 2, "2024-03-01 03:00:00")
    out = tables.read_silver(spark, silver_path)
    assert out.count() == 90 and out.select("event_id").distinct().count() == 90
    stats = spark.read.parquet(runs)
    assert values(stats, "batch_id", "events_in", "events_out", "duplicates_removed")[:2] == [(0, 52, 50, 2), (1, 50, 50, 0)]
    assert (tmp_path / "bronze" / "year=2024" / "month=03" / "day=01" / "hour=01").is_dir()


def test_silver_trigger_repeats_without_change(spark, tmp_path):
    rows = [(f"e{i}", "d", T0, T0, "1.0", "http", 1.0, None, None, "r", "m", 1.0, 2.0, {}, None) for i in range(6)]
    data = frame(spark, rows, tables.BRONZE)
    process = jobs.silver_batch(str(tmp_path / "s"), str(tmp_path / "r"))
    for batch in (0, 0, 1, 1):
        process(data, batch)
    assert tables.read_silver(spark, str(tmp_path / "s")).count() == 6
    assert values(spark.read.parquet(str(tmp_path / "r")), "batch_id", "events_out") == [(0, 6), (1, 6)]


def test_rollup_streams_equal_batch_for_closed_windows(spark, tmp_path):
    from tidewire.operators import rollup

    rng = random.Random(9)
    rows = [(T0 + timedelta(seconds=7 * i), f"d{i % 2}", f"e{i}", {"temperature": rng.uniform(0, 50)}) for i in range(600)]
    schema = "time timestamp, device_id string, event_id string, metrics map<string,double>"
    source = tmp_path / "t"
    for a, b in ((0, 250), (250, 600)):
        frame(spark, rows[a:b], schema).coalesce(1).write.mode("append").parquet(str(source))
    data = spark.read.parquet(str(source))
    stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    minutes = jobs.rollup_stream(stream, "2 minutes")
    finish(minutes.writeStream.format("parquet").option("path", str(tmp_path / "m")), tmp_path / "c1")
    mark = T0 + timedelta(seconds=7 * 599) - timedelta(minutes=2)
    batch = rollup.rollup_1m(data).filter(F.col("bucket") + F.expr("interval 1 minute") <= F.lit(mark))
    got = spark.read.parquet(str(tmp_path / "m"))
    (message,) = jobs.aggregate_messages(got.orderBy("bucket", "device_id").limit(1)).collect()
    assert message["key"] == "d0" and json.loads(message["value"])["bucket"] == "2024-01-01T00:00:00.000Z"
    assert values(got, "bucket", "device_id", "sample_count") == values(batch, "bucket", "device_id", "sample_count")


def test_rollup_table_refreshes_only_its_window(spark, tmp_path):
    path = str(tmp_path / "r1m")
    schema = "time timestamp, device_id string, event_id string, metrics map<string,double>"

    def telemetry(value, hours):
        return frame(spark, [(T0 + timedelta(hours=h), "d", f"e{h}", {"temperature": value}) for h in hours], schema)

    tables.refresh_rollup(spark, telemetry(1.0, range(0, 26)), path, "1m", T0 + timedelta(hours=2, minutes=30))
    assert spark.read.parquet(path).count() == 3
    for h in (4, 7, 10, 13, 16, 19, 22, 25):
        tables.refresh_rollup(spark, telemetry(1.0, range(0, 26)), path, "1m", T0 + timedelta(hours=h, minutes=30))
    assert spark.read.parquet(path).count() == 26
    # Rows that arrive late enter only inside the refreshed hours.
    tables.refresh_rollup(spark, telemetry(2.0, range(0, 26)), path, "1m", T0 + timedelta(hours=25, minutes=30))
    after = {r["bucket"]: r["avg_temperature"] for r in spark.read.parquet(path).collect()}
    assert sorted(h for h in range(26) if after[T0 + timedelta(hours=h)] == 2.0) == [23, 24, 25]
    hourly = str(tmp_path / "r1h")
    tables.refresh_rollup(spark, spark.read.parquet(path), hourly, "1h", T0 + timedelta(hours=27))
    assert spark.read.parquet(hourly).agg(F.sum("sample_count")).first()[0] == 26


def test_telemetry_table_prunes_days_and_drops_expired_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(datetime(2024, 1, d, 12), "d", f"e{d}", {"temperature": float(d)}, {}, "http", datetime(2024, 1, d, 13)) for d in range(1, 11)]
    tables.write_telemetry(frame(spark, rows, tables.TELEMETRY), path)
    table = tables.read_telemetry(spark, path)
    from tidewire.operators import history

    result = history.history_raw(table, "d", datetime(2024, 1, 3), datetime(2024, 1, 4, 12))
    assert [r["temperature"] for r in result.collect()] == [3.0, 4.0]
    scan = result._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in scan and "TakeOrderedAndProject" in scan
    assert "EqualTo(device_id,d)" in scan and "GreaterThanOrEqual(time" in scan
    listed = [r["path"].rsplit("/", 2)[1] for r in tables.list_files(spark, path).collect()]
    assert sorted(set(listed)) == [f"event_date=2024-01-{d:02d}" for d in range(1, 11)]
    gone = tables.drop_expired_partitions(spark, path, datetime(2024, 2, 4, 18))
    assert gone == [f"event_date=2024-01-0{d}" for d in range(1, 5)]
    assert tables.read_telemetry(spark, path).count() == 6


def test_history_of_a_stored_rollup_skips_days(spark, tmp_path):
    from tidewire.operators import history, rollup

    path = str(tmp_path / "r1m")
    rows = [(datetime(2024, 1, d, 12), "d", f"e{d}", {"temperature": float(d)}, {}, "http", datetime(2024, 1, d, 13)) for d in range(1, 11)]
    tables.write_rollup(rollup.rollup_1m(frame(spark, rows, tables.TELEMETRY)), path)
    stored = {"1m": tables.read_rollup(spark, path)}
    result = history.history(stored, "d", "2024-01-10T00:00:00", "2024-01-03T00:00:00", "2024-01-04T12:00:00", "1m")
    assert [r["temperature"] for r in result.collect()] == [3.0, 4.0]
    scan = result._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in scan and "EqualTo(device_id,d)" in scan


def test_cooldown_reaches_over_triggers(spark, tmp_path):
    path, out = str(tmp_path / "alerts"), str(tmp_path / "out")
    schema = "alert_id string, device_id string, rule_id string, triggered_at timestamp"
    fired = [(0, "a"), (299, "a"), (300, "a"), (10, "b"), (599, "a"), (601, "a"), (309, "b"), (310, "b")]
    for n in range(0, len(fired), 3):
        rows = [(f"{i}", d, "r", T0 + timedelta(seconds=s)) for i, (s, d) in enumerate(fired)][n : n + 3]
        frame(spark, rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        writer = jobs.cooled_alert_stream(stream, 300).writeStream.format("parquet").option("path", out)
        jobs.start(writer, f"{out}-checkpoint", {"availableNow": True}, idle_batches=False).awaitTermination()
    kept = {(r["device_id"], int((r["triggered_at"] - T0).total_seconds())) for r in spark.read.parquet(out).collect()}
    assert kept == {("a", 0), ("a", 300), ("a", 601), ("b", 10), ("b", 310)}


def test_landed_responses(spark, tmp_path):
    from tidewire.operators import external
    from tidewire.sources import landed

    land(tmp_path / "w", "a.json", [
        {"city": "London", "current": {"time": "2024-01-01T10:15", "temperature_2m": 7.5, "weather_code": 48}, "received_at": "2024-01-01T10:16:00Z"},
        {"city": "London", "received_at": "2024-01-01T10:17:00Z"},
        {"city": "Berlin", "current": {"weather_code": 7}, "received_at": "2024-01-01T10:18:00Z"},
    ])
    events = external.weather_normalize(landed.read_weather(spark, str(tmp_path / "w")))
    found = {r["device_id"]: r for r in events.collect()}
    london, berlin = found["weather-lon-001"], found["weather-ber-001"]
    assert london["timestamp"] == datetime(2024, 1, 1, 10, 15) and london["tags"]["condition"] == "Rime Fog"
    assert london["metrics"] == {"temperature": 7.5, "humidity": 0.0, "wind_speed": 0.0, "weather_code": 48.0}
    assert berlin["timestamp"] == datetime(2024, 1, 1, 10, 18) and berlin["tags"]["condition"] == "Unknown"
    land(tmp_path / "q", "a.json", [
        {"location_id": "155", "results": [{"sensors": [
            {"parameter": {"name": "pm25"}, "latest": {"value": 3.0, "datetime": "2024-01-01T09:00:00Z"}},
            {"parameter": {"name": "pm25"}, "latest": {"value": 4.0, "datetime": "2024-01-01T08:00:00+01:00"}},
            {"parameter": {"name": "o3"}, "latest": {"value": None, "datetime": "2030-01-01T00:00:00Z"}},
        ]}, {"sensors": []}], "received_at": "2024-01-01T10:00:00Z"},
        {"location_id": "155", "results": [], "received_at": "2024-01-01T10:00:00Z"},
    ])
    (row,) = external.aq_normalize(landed.read_air_quality(spark, str(tmp_path / "q"))).collect()
    assert row["metrics"] == {"pm25": 4.0} and row["timestamp"] == datetime(2024, 1, 1, 7, 0)
    assert validate.SCHEMA_VERSION == row["schema_version"] and row["tags"]["lon"] == "77.209"


def test_gauges_and_offsets_from_progress(spark, tmp_path):
    land(tmp_path / "log", "a.json", log_rows(20))
    watch = ProgressLog()
    spark.streams.addListener(watch)
    try:
        writer = jobs.telemetry_job(read_log(spark, tmp_path / "log"), str(tmp_path / "t"))
        query = finish(writer.queryName("telemetry"), tmp_path / "c")
        deadline = time.time() + 30
        while not watch.rows and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(watch)
    assert gauges(query)["input_rows"] >= 0
    assert ("telemetry", 0, 22) in watch.rows
    progress = {"sources": [{"endOffset": '{"t":{"0":5,"1":7}}', "latestOffset": {"t": {"0": 9, "1": 7}}}]}
    done, end = offset_frames(spark, "g", progress)
    assert values(done) == [("g", "t", 0, 5), ("g", "t", 1, 7)] and values(end) == [("t", 0, 9), ("t", 1, 7)]


def test_accepted_events_feed_the_anomaly_alerts(spark, tmp_path):
    log = tmp_path / "log"
    rows = []
    for i in range(60):
        t = T0 + timedelta(seconds=i)
        value = message(i, "d", t, {"temperature": 500.0 if i == 50 else 20.0 + i % 2})
        rows += [{"key": "d", "value": value, "topic": "telemetry.raw", "partition": 0, "offset": i, "timestamp": t.isoformat() + "Z"}] * 2
    land(log, "a.json", rows)
    found = jobs.anomaly_alert_stream(jobs.accepted_stream(read_log(spark, log)))
    finish(found.writeStream.format("parquet").option("path", str(tmp_path / "out")), tmp_path / "c", False)
    (alert,) = spark.read.parquet(str(tmp_path / "out")).collect()
    assert alert["rule_id"] == "anomaly-temperature" and alert["value"] == 500.0


def test_late_partition_loses_no_new_event(spark, tmp_path):
    """A log partition two days behind brings events never seen before, and a mark that expired."""
    log = tmp_path / "log"

    def record(i, offset, hours, partition):
        t = T0 + timedelta(hours=hours)
        return {"key": "d", "value": message(i, "d", t, {"temperature": 20.0}), "topic": "telemetry.raw",
                "partition": partition, "offset": offset, "timestamp": t.isoformat() + "Z"}

    land(log, "a.json", [record(1, 0, 48, 0), record(2, 1, 49, 0)])
    land(log, "b.json", [record(3, 2, 97, 0), record(1, 3, 60, 0), record(1, 4, 72, 0)])
    land(log, "c.json", [record(4, 0, 0, 1), record(4, 1, 25, 1), record(4, 2, 26, 1), record(5, 3, 1, 1)])
    accepted = jobs.accepted_stream(read_log(spark, log)).select("event_id", "arrived_at")
    finish(accepted.writeStream.format("parquet").option("path", str(tmp_path / "out")), tmp_path / "c", False)
    got = spark.read.parquet(str(tmp_path / "out"))
    hours = {(r["event_id"][-1], (r["arrived_at"] - T0) / timedelta(hours=1)) for r in got.collect()}
    assert hours == {("1", 48), ("1", 72), ("2", 49), ("3", 97), ("4", 0), ("4", 25), ("5", 1)}
    batch = dedup.realtime_dedup(validate.valid_events(batch_log(spark, log)), arrival="arrived_at")
    assert values(got) == values(batch.select("event_id", "arrived_at"))


def test_state_ignores_device_clocks_and_survives_compaction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "COMPACT_EVERY", 3)
    path = str(tmp_path / "state")

    def events(rows):
        data = [(f"e{i}", d, T0, clock, {"t": float(i)}, None, "http", T0 + timedelta(minutes=m)) for i, d, clock, m in rows]
        return frame(spark, data, "event_id string, device_id string, timestamp timestamp, ingested_at timestamp, "
                     "metrics map<string,double>, tags map<string,string>, source string, arrived_at timestamp")

    future, past = datetime(2030, 1, 1), datetime(2001, 1, 1)
    jobs.save_state(events([(1, "a", T0, 0), (2, "b", T0, 1), (3, "z", T0, 1)]), path, 0)
    jobs.save_state(events([(4, "c", future, 20), (5, "a", past, 30)]), path, 1)
    assert values(jobs.read_state(spark, path), "device_id", "event_id") == [("a", "e5"), ("b", "e2"), ("c", "e4"), ("z", "e3")]
    for batch in range(2, 10):
        jobs.save_state(events([(10 + batch, "b", T0, 58 + batch)]), path, batch)
        jobs.save_state(events([(10 + batch, "b", T0, 58 + batch)]), path, batch)
    # At minute 67 the device last heard of at minute 1 is gone, whatever the clocks say.
    assert values(jobs.read_state(spark, path), "device_id", "event_id") == [("a", "e5"), ("b", "e19"), ("c", "e4")]
    assert tables.numbered(spark, path, "base") == [6, 9]
    assert tables.numbered(spark, path, "version") == [6, 7, 8, 9]
    assert values(jobs.read_state(spark, path, T0 + timedelta(hours=1, minutes=25)), "device_id") == [("a",), ("b",)]


def test_silver_keeps_the_latest_ingestion_whatever_the_triggers(spark, tmp_path):
    from tidewire.operators import silver

    def row(i, day, delay, temperature):
        return (f"e{i}", "d", T0 + timedelta(days=day), T0 + timedelta(hours=delay), "1.0", "http",
                temperature, None, None, "r", "m", 1.0, 2.0, {}, None)

    first = [row(1, 0, 1, 10.0), row(2, 0, 1, 11.0), row(3, 0, 9, 12.0)]
    second = [row(1, 0, 2, 35.0), row(2, 3, 2, 36.0), row(3, 1, 5, 37.0)]
    path = str(tmp_path / "s")
    process = jobs.silver_batch(path, str(tmp_path / "r"))
    for batch, rows in enumerate((first, second)):
        process(frame(spark, rows, tables.BRONZE).withColumn("_file", F.lit(f"f{batch}")), batch)
    expected = values(silver.silver(frame(spark, first + second, tables.BRONZE)).drop("event_date").orderBy("event_id"))
    assert values(tables.read_silver(spark, path).drop("event_date")) == expected
    assert [r[6] for r in expected] == [35.0, 36.0, 12.0]
    tables.compact_silver(spark, path, str(tmp_path / "compact"))
    assert values(spark.read.parquet(str(tmp_path / "compact")).drop("event_date")) == expected
    runs = spark.read.parquet(str(tmp_path / "r"))
    assert values(runs, "batch_id", "processed_files", "skipped_files") == [(0, 1, 0), (1, 1, 1)]
    assert all(r["duration_ms"] > 0 for r in runs.collect())


def test_rolling_moments_equal_the_plain_windows():
    import numpy as np

    from tidewire.streaming.anomaly import rolling_moments

    series = np.random.default_rng(3).normal(10, 2, 25_000)
    for start in (0, 40, 100, 24_990):
        size, mean, deviation = rolling_moments(series, start)
        for i in {0, 1, len(mean) // 2, len(mean) - 1}:
            window = series[max(0, start + i + 1 - 100) : start + i + 1]
            assert size[i] == len(window)
            assert abs(mean[i] - window.mean()) < 1e-9 and abs(deviation[i] - window.std()) < 1e-9

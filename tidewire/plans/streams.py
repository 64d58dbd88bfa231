"""Streaming and file-sink operators as named queries: each runs to the end of its input and reads back."""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.maps import entry, rendered
from tidewire.functions.times import at
from tidewire.operators import ingest, quality, rollup, validate
from tidewire.operators.alerts import alerts_rules
from tidewire.operators.anomaly import samples
from tidewire.plans import adapter
from tidewire.plans.catalog import COOLDOWN_SECONDS, MEASURES, QUERIES, ROLLED, _alerts, _ntz, _rounded, _silver, query
from tidewire.schemas import EVENT_LOG, TOPIC_AGGREGATES, TOPIC_ALERTS, TOPIC_RAW
from tidewire.session import scratch_path
from tidewire.sources import event_log, ledger, tables
from tidewire.streaming import boards, jobs, marks, measures, rollups, scores

ALL = {"availableNow": True}
LOG_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def run(writer, checkpoint: str, idle_batches: bool = True) -> None:
    jobs.start(writer, checkpoint, ALL, idle_batches).awaitTermination()


def to_files(frame: DataFrame, writer_mode: str, path: str, idle_batches: bool = True) -> str:
    """Writes the stream to Parquet and returns the path."""
    writer = frame.writeStream.format("parquet").option("path", path).outputMode(writer_mode)
    run(writer, f"{path}-checkpoint", idle_batches)
    return path


def to_log(records: DataFrame, path: str) -> str:
    """Writes (key, value) messages to a file log and returns its path."""
    run(event_log.write_event_log(records, path, f"{path}-checkpoint", fmt="parquet"), f"{path}-checkpoint")
    return path


def log_files(spark: SparkSession, sf: str) -> str:
    """The raw log as JSON-lines files."""
    path = scratch_path(spark, "log")
    adapter.event_log(spark, sf).select(*EVENT_LOG.fieldNames()).withColumn(
        "timestamp", F.date_format("timestamp", LOG_TIME)
    ).write.json(path)
    return path


def log_stream(spark: SparkSession, sf: str) -> DataFrame:
    jobs.prepare(spark)
    return event_log.read_event_log(spark, log_files(spark, sf), TOPIC_RAW, fmt="json", timestampFormat=LOG_TIME)


def frame_stream(frame: DataFrame, name: str) -> DataFrame:
    """A frame as a stream of files."""
    spark = jobs.prepare(frame.sparkSession)
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.readStream.schema(frame.schema).parquet(path)


@query
def src_event_log(spark, sf):
    path = to_files(log_stream(spark, sf), "append", scratch_path(spark, "copy"))
    return _ntz(spark.read.parquet(path).select("key", "value", "partition", "offset", "timestamp"), "timestamp")


@query
def sink_event_log(spark, sf):
    """Normalised HTTP requests go to the log as messages and come back as valid events."""
    requests = frame_stream(adapter.http_requests(spark, sf), "requests")
    records = ingest.to_log_record(ingest.ingest_normalize(requests))
    path = to_log(records, scratch_path(spark, "records"))
    back = validate.parse_events(spark.read.parquet(path))
    return back.select("key", "status", "event_id", entry("metrics", "temperature").alias("temperature"), "source")


ALERT_MESSAGE = (
    "alertId string, deviceId string, ruleId string, severity string, message string, value double, "
    "threshold double, triggeredAt timestamp"
)


def _alert_log(spark: SparkSession, path: str) -> DataFrame:
    """The messages of an alert log by the names of the alert table."""
    rows = spark.read.parquet(path).select("key", F.from_json("value", ALERT_MESSAGE).alias("a")).select("key", "a.*")
    names = {v: k for k, v in event_log.ALERT_FIELDS.items()}
    return _rounded(_ntz(rows.withColumnsRenamed(names), "triggered_at"), "threshold")


@query
def sink_alerts(spark, sf):
    stream = frame_stream(_alerts(spark, sf), "alerts")
    return _alert_log(spark, to_log(event_log.alert_messages(stream), scratch_path(spark, TOPIC_ALERTS)))


@query
def dlq_stream(spark, sf):
    path = to_files(
        jobs.dead_letter_stream(jobs.parsed_stream(log_stream(spark, sf))), "append", scratch_path(spark, "dlq")
    )
    letter = F.from_json("value", "reason string, error string, raw string, timestamp string")
    return spark.read.parquet(path).select(letter.alias("d")).select("d.*")


@query
def telemetry_stream(spark, sf):
    path = scratch_path(spark, "telemetry")
    run(jobs.telemetry_job(jobs.parsed_stream(log_stream(spark, sf)), path), f"{path}-checkpoint")
    rows = tables.read_telemetry(spark, path).select(
        "event_id", "device_id", "time", "ingested_at", "event_date", "source", entry("metrics", "temperature").alias("temperature"),
        F.size("tags").cast("bigint").alias("n_tags"),
    )
    return _ntz(rows, "time", "ingested_at")


@query
def telemetry_table(spark, sf):
    """Telemetry in a table that is compacted between the triggers of a stream."""
    parts = [adapter.event_log(spark, sf).filter(F.col("id") % 3 == n).drop("id") for n in range(3)]
    for n, part in enumerate(parts):
        parts[n] = part.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    table = jobs.telemetry_table(scratch_path(spark, "telemetry"))
    run(jobs.telemetry_table_job(jobs.parsed_stream(triggers(parts, "log")), table, 2), f"{table.path}-checkpoint")
    table.compact(spark, 1)
    rows = table.read(spark).select(
        "event_id", "device_id", "time", "ingested_at", "event_date", "source", entry("metrics", "temperature").alias("temperature"),
        F.size("tags").cast("bigint").alias("n_tags"),
    )
    return _ntz(rows, "time", "ingested_at")


@query
def bronze_stream(spark, sf):
    """Files land under the hour given here in place of the wall clock."""
    path = scratch_path(spark, "bronze")
    flushed = F.lit("2024-02-03 04:05:06").cast("timestamp")
    run(jobs.archive_job(jobs.parsed_stream(log_stream(spark, sf)), path, flushed), f"{path}-checkpoint")
    rows = tables.read_bronze(spark, path).select(
        "event_id", "device_id", "timestamp", "ingested_at", "temperature", "humidity", "region",
        "year", "month", "day", "hour",
    )
    return _ntz(rows, "timestamp", "ingested_at")


@query
def silver_write(spark, sf):
    path = scratch_path(spark, "silver")
    tables.write_silver(_silver(spark, sf), path)
    return spark.read.parquet(path)


@query
def silver_stream(spark, sf):
    jobs.prepare(spark)
    bronze_path, path = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    rows = adapter.corrected_bronze(spark, sf)
    for column in ("timestamp", "ingested_at"):
        rows = rows.withColumn(column, F.col(column).cast("timestamp"))
    # One file per day and several triggers, so that copies arrive in different ones.
    tables.write_bronze(rows, bronze_path, F.date_trunc("day", "ingested_at"))
    stream = jobs.silver_stream(spark, bronze_path, files=20)
    run(jobs.silver_job(stream, path, f"{path}-runs"), f"{path}-checkpoint")
    return _ntz(tables.read_silver(spark, path), "timestamp", "ingested_at")


@query
def silver_runs(spark, sf):
    """The same by scheduled runs over the files that the ledger doesn't have."""
    jobs.prepare(spark)
    bronze_path, path = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    rows = adapter.corrected_bronze(spark, sf)
    for column in ("timestamp", "ingested_at"):
        rows = rows.withColumn(column, F.col(column).cast("timestamp"))
    tables.write_bronze(rows, bronze_path, F.date_trunc("day", "ingested_at"))
    runs = ledger.Ledger(f"{path}-ledger")
    while jobs.silver_run(spark, bronze_path, path, f"{path}-runs", runs, files=20):
        pass
    return _ntz(tables.read_silver(spark, path), "timestamp", "ingested_at")


@query
def describe_table(spark, sf):
    return tables.describe_table(spark.read.parquet(f"{sf}/lineitem.parquet")).select(
        "column_name", "column_type", F.col("position").cast("bigint").alias("position")
    )


@query
def rollup_stream(spark, sf):
    """Minutes the watermark has closed, with the open end of the table behind them.

    The test tables span less than the usual delay, so it is shorter here.
    """
    rows = adapter.telemetry(spark, sf)
    stream = jobs.rollup_stream(frame_stream(rows, "telemetry"), "10 minutes")
    path = to_files(stream, "append", scratch_path(spark, "rollup"))
    closed = _ntz(spark.read.parquet(path).drop("bucket_time"), "bucket")
    return _rounded(rollup.with_open_end(closed, rows), *ROLLED)


@query
def rollup_5m_stream(spark, sf):
    """Chained windows: minutes roll up to five minutes within one query."""
    rows = adapter.telemetry(spark, sf)
    coarse = jobs.coarse_rollup_stream(jobs.rollup_stream(frame_stream(rows, "telemetry"), "10 minutes"), "5m")
    path = to_files(coarse, "append", scratch_path(spark, "rollup"))
    return _rounded(rollup.with_open_end(_ntz(spark.read.parquet(path), "bucket"), rows, "5m"), *ROLLED)


@query
def aggregates_stream(spark, sf):
    """The aggregates topic: minutes that are closed."""
    stream = frame_stream(adapter.telemetry(spark, sf), "telemetry")
    path = scratch_path(spark, TOPIC_AGGREGATES)
    run(jobs.aggregates_job(stream, path, f"{path}-checkpoint", "10 minutes", "parquet"), f"{path}-checkpoint")
    value = F.from_json("value", AGGREGATE_MESSAGE)
    rows = spark.read.parquet(path).select("key", value.alias("v")).select("key", "v.*")
    return _rounded(_ntz(rows, "bucket"), *ROLLED)


AGGREGATE_MESSAGE = (
    "bucket timestamp, device_id string, avg_temperature double, min_temperature double, max_temperature double, "
    "avg_humidity double, min_humidity double, max_humidity double, avg_pressure double, sample_count bigint"
)


def triggers(parts: list[DataFrame], name: str) -> DataFrame:
    """A stream of files that delivers the parts one after the other."""
    spark = jobs.prepare(parts[0].sparkSession)
    path, files = scratch_path(spark, name), spark.sparkContext.defaultParallelism
    for part in parts:
        part.repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", files).parquet(path)


def by_arrival(rows: DataFrame, n: int) -> list[DataFrame]:
    """The rows cut into `n` spans of arrival of equal length."""
    first, last = rows.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    cuts = [first + (last - first) * i / n for i in range(1, n)]
    bounds = [None, *cuts, None]
    t = F.col("ingested_at")
    return [
        rows.filter((F.lit(True) if a is None else t >= at(a)) & (F.lit(True) if b is None else t < at(b)))
        for a, b in zip(bounds, bounds[1:])
    ]


def _arrivals(frame: DataFrame) -> DataFrame:
    return frame.withColumn("arrived_at", F.col("ingested_at").cast("timestamp"))


def _valid(stream: DataFrame) -> DataFrame:
    return jobs.valid_stream(_arrivals(stream).withColumn("status", F.lit(validate.OK)))


@query
def realtime_dedup_stream(spark, sf):
    """Half the devices lag behind: their events arrive after the last ones of the others."""
    rows = adapter.redelivered_events(spark, sf)
    lags = F.col("device_id").endswith("7") | F.col("device_id").endswith("2")
    stream = triggers([*by_arrival(rows.filter(~lags), 2), *by_arrival(rows.filter(lags), 2)], "events")
    stream = _valid(stream)
    accepted = marks.Marks(scratch_path(spark, "unique"), stream.schema, fold_every=2)
    run(marks.accepted_job(stream, accepted), f"{accepted.path}-checkpoint", False)
    return spark.read.parquet(f"{accepted.path}/accepted").select("event_id", "device_id", "ingested_at")


@query
def latest_state_stream(spark, sf):
    """Devices set their clocks years ahead and behind; only the order of arrival counts."""
    n = F.substring("event_id", -12, 12).cast("bigint") % 5
    days = F.when(n == 1, 2190).when(n == 2, -365).otherwise(0)
    stream = _arrivals(triggers(by_arrival(adapter.events(spark, sf), 3), "events"))
    stream = stream.withColumn("ingested_at", F.col("ingested_at") + F.make_interval(days=days))
    for column in ("timestamp", "ingested_at"):
        stream = stream.withColumn(column, F.col(column).cast("timestamp"))
    outputs = _outputs(spark)
    run(jobs.realtime_job(stream, outputs), f"{outputs.state}-checkpoint")
    s = jobs.read_state(spark, outputs.state).select(
        "device_id", "event_id", "timestamp", "ingested_at", "source",
        *[entry("metrics", m).alias(m) for m in MEASURES], entry("tags", "region").alias("region"),
    )
    return _ntz(s, "timestamp", "ingested_at")


@query
def device_board_stream(spark, sf):
    """The board as triggers make it, the newest arrivals first."""
    stream = triggers(by_arrival(adapter.events(spark, sf), 4)[::-1], "events")
    board = boards.board_table(scratch_path(spark, "board"), compact_every=2)
    run(boards.board_job(stream, board, "ingested_at"), f"{board.path}-checkpoint", False)
    found = boards.read_board(spark, board)
    return _ntz(found, "timestamp").select(
        "device_id", "timestamp", rendered("tags").alias("tags"), *[entry("metrics", m).alias(m) for m in MEASURES]
    )


@query
def alert_cooldown_stream(spark, sf):
    """The cooldown reaches over triggers."""
    stream = _arrivals(triggers(by_arrival(adapter.events(spark, sf), 3), "events"))
    cooled = jobs.cooled_alert_stream(alerts_rules(stream, arrival="arrived_at"), COOLDOWN_SECONDS)
    path = to_files(cooled, "append", scratch_path(spark, "cooled"), False)
    return _ntz(spark.read.parquet(path), "triggered_at")


def _outputs(spark: SparkSession) -> jobs.RealtimeOutputs:
    path = scratch_path(spark, "realtime")
    return jobs.RealtimeOutputs(*[f"{path}/{name}" for name in ("alerts", "live", "state", "log")])


def _realtime_run(spark: SparkSession, sf: str, outputs: jobs.RealtimeOutputs) -> jobs.RealtimeOutputs:
    """Both alert jobs over events of which every tenth is delivered twice."""
    rows = adapter.events(spark, sf)
    again = rows.filter(F.col("event_id").endswith("0"))
    copies = again.withColumn("ingested_at", F.col("ingested_at") + F.expr("interval 1 second"))
    stream = triggers(by_arrival(rows.unionByName(copies), 3), "events")
    valid = _valid(stream)
    accepted = marks.Marks(f"{outputs.state}-accepted", valid.schema)
    run(jobs.realtime_job(valid, outputs, marks=accepted), f"{outputs.state}-checkpoint", False)
    anomalies = jobs.anomaly_job(marks.accepted_stream(spark, accepted), outputs, scores.Tails(f"{outputs.state}-scores"))
    run(anomalies, f"{outputs.state}-checkpoint-anomaly", False)
    return outputs


@query
def realtime_alerts(spark, sf):
    """Threshold and anomaly alerts as they leave by the alert log."""
    return _alert_log(spark, _realtime_run(spark, sf, _outputs(spark)).log)


@query
def realtime_alert_table(spark, sf):
    """Threshold and anomaly alerts in the alert table."""
    rows = jobs.read_alerts(spark, _realtime_run(spark, sf, _outputs(spark)).alerts).drop("created_at")
    return _rounded(_ntz(rows, "triggered_at"), "threshold")


@query
def realtime_alert_snapshots(spark, sf):
    """The same in a compacted table, the live feed in another."""
    outputs = _outputs(spark)
    outputs = dataclasses.replace(outputs, alerts=jobs.alert_table(outputs.alerts), live=jobs.live_table(outputs.live))
    _realtime_run(spark, sf, outputs)
    for table in (outputs.alerts, outputs.live):
        table.compact(spark, 1)
    live = outputs.live.read(spark).groupBy(F.col("device_id").alias("_d"), F.col("type").alias("_t")).count().filter("_t = 'alert'")
    rows = jobs.read_alerts(spark, outputs.alerts).drop("created_at")
    # Every alert of a device is in the live feed, too.
    fed = rows.join(live.select(F.col("_d").alias("device_id"), F.col("count").alias("n_live")), "device_id")
    return _rounded(_ntz(fed, "triggered_at"), "threshold")


@query
def anomaly_stream_(spark, sf):
    parts = by_arrival(adapter.events(spark, sf), 3)
    stream = triggers([samples(part) for part in parts], "samples")
    tails = scores.Tails(scratch_path(spark, "scores"), compact_every=2)
    run(scores.score_job(stream, tails), f"{tails.path}-checkpoint", False)
    found = spark.read.parquet(f"{tails.path}/scores").drop("batch_id")
    return _rounded(_ntz(found, "ts"), "mean", "std_dev", "z_score")


QUERIES["anomaly_stream"] = QUERIES.pop("anomaly_stream_")


SLICES = 4


def _live_rollup(spark: SparkSession, sf: str, interval: str) -> DataFrame:
    """Arrivals in four triggers; rows of a minute older than three hours at their trigger don't enter."""
    jobs.prepare(spark)
    rows = adapter.late_telemetry(spark, sf, SLICES).persist()
    source, path = scratch_path(spark, "arrivals"), scratch_path(spark, "rollups")
    for n in range(SLICES):
        rows.filter(F.col("slice") == n).drop("slice").write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.drop("slice").schema).parquet(source)
        run(rollups.live_rollup_job(stream, path, compact_every=2), f"{path}-checkpoint", idle_batches=False)
    rows.unpersist()
    return _rounded(_ntz(rollups.read_rollups(spark, path, interval).drop("event_date"), "bucket"), *ROLLED)


@query
def rollup_live_1m(spark, sf):
    return _live_rollup(spark, sf, "1m")


@query
def rollup_live_1h(spark, sf):
    return _live_rollup(spark, sf, "1h")


@query
def job_counters(spark, sf):
    """What the realtime and the batch job count while they run over a log that brings some messages twice."""
    log = adapter.event_log(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    again = log.filter("id % 10 = 9").withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 second"))
    rows = log.unionByName(again).withColumn("slice", F.col("id") % 3).drop("id")
    parsed = jobs.parsed_stream(triggers([rows.filter(F.col("slice") == n).drop("slice") for n in range(3)], "log"))
    outputs = _outputs(spark)
    counted = measures.Measures(f"{outputs.state}-measures", compact_every=2)
    accepted = marks.Marks(f"{outputs.state}-accepted", jobs.valid_stream(parsed).schema)
    realtime = jobs.measured_realtime_job(parsed, outputs, accepted, counted, f"{outputs.state}-dlq")
    run(realtime, f"{outputs.state}-checkpoint", False)
    batch = jobs.measured_telemetry_job(parsed, jobs.telemetry_table(f"{outputs.state}-telemetry"), counted)
    run(batch, f"{outputs.state}-checkpoint-batch", False)
    return counted.counters(spark)


@query
def duration_histograms(spark, sf):
    """Durations made from the props number, bucketed per trigger and added up; one trigger is repeated."""
    jobs.prepare(spark)
    e = adapter.source_events(spark, sf)
    added = measures.Measures(scratch_path(spark, "durations"))
    for trigger in (0, 1, 1, 2, 3):
        rows, n = e.filter(F.col("id") % 4 == trigger), F.col("id") % 3 + 1
        parts = [quality.duration_parts(rows, name, F.col("k") / div, n) for name, div in DURATION_UNITS.items()]
        added.add(reduce(DataFrame.unionByName, parts), "job", trigger)
    return _rounded(added.histograms(spark), "value")


# What the props number is divided by, so that it falls on both sides of every bound.
DURATION_UNITS = {
    "processor_event_duration_seconds": 100,
    "batch_flush_duration_seconds": 10_000,
    "archive_flush_duration_seconds": 8,
    "silver_transform_duration_seconds": 1,
}

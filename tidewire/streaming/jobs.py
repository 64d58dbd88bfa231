"""Structured Streaming jobs over the event log.

Realtime, batch and archive are independent readers of one topic, each with its own checkpoint.
Sinks write a trigger's rows under its batch id, so a repeated trigger replaces its own output.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewire.functions.times import iso
from tidewire.operators import alerts, fanout, flatten, rollup, silver, state, validate
from tidewire.operators.anomaly import samples
from tidewire.operators.dedup import PROCESSED_TTL_SECONDS
from tidewire.schemas import (
    ALERT,
    BIGINT,
    BOOLEAN,
    BRONZE_PARTITIONS,
    DATE,
    STRING,
    TELEMETRY,
    TIMESTAMP,
    TOPIC_AGGREGATES,
    TOPIC_ALERTS,
    extended,
    record,
)
from tidewire.session import STATE_STORE, configure
from tidewire.sources import event_log, tables
from tidewire.sources.ledger import Ledger
from tidewire.sources.snapshots import SnapshotTable, append_and_compact, snapshot_job
from tidewire.streaming.anomaly import anomaly_stream
from tidewire.streaming.dedup import first_arrivals
from tidewire.streaming.marks import Marks, idempotent
from tidewire.streaming.measures import Measures, Trigger, measured, publishing
from tidewire.streaming.scores import Tails, scored

ROLLUP_DELAY = "3 hours"
SILVER_FILES = 50
COMPACT_EVERY = 100


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


def parsed_stream(log: DataFrame) -> DataFrame:
    """Parsed messages; `arrived_at` is the time the log recorded them."""
    return validate.parse_events(log.withColumnRenamed("timestamp", "arrived_at"))


def valid_stream(parsed: DataFrame) -> DataFrame:
    return validate.valid_events(parsed).select(*validate.EVENT_COLUMNS, "arrived_at")


def accepted_stream(parsed: DataFrame, ttl_seconds: int = PROCESSED_TTL_SECONDS) -> DataFrame:
    """Valid events without those already accepted within the TTL; no id seen for the first time is dropped.

    For a query that needs them in its own plan; jobs that may write use `marks.Marks`, which stays out of Python.
    """
    return first_arrivals(valid_stream(parsed), ttl_seconds)


IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def start(writer: DataStreamWriter, checkpoint: str, trigger: dict, idle_batches: bool = True) -> StreamingQuery:
    """Windows need batches without input to close. Streams over `accepted_stream` don't, and as their
    marks expire by the wall clock, Spark would run such batches without end: turn them off there."""
    conf = SparkSession.active().conf
    before = conf.get(IDLE_BATCHES)
    conf.set(IDLE_BATCHES, str(idle_batches).lower())
    try:
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
    finally:
        conf.set(IDLE_BATCHES, before)


def dead_letter_stream(parsed: DataFrame) -> DataFrame:
    """Messages for the dead-letter topic, without key."""
    return event_log.keyed_json(validate.dead_letters(parsed, F.col("arrived_at")), None)


def write_part(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_dated(rows: DataFrame, path: str, at: str, batch_id: int) -> None:
    """Rows of one trigger below the days of `at`, so that readers of few days list few files."""
    (
        rows.withColumns({"event_date": F.to_date(at), "batch_id": F.lit(batch_id).cast("bigint")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "batch_id")
        .parquet(path)
    )


def store(rows: DataFrame, target: str | SnapshotTable, origin: str, at: str, batch_id: int) -> None:
    """Rows of one trigger into a folder of their own, or into a table that is compacted every so many triggers."""
    if isinstance(target, SnapshotTable):
        append_and_compact(target, rows, origin, batch_id, COMPACT_EVERY)
    else:
        write_dated(rows, f"{target}/origin={origin}", at, batch_id)


def alert_table(path: str) -> SnapshotTable:
    schema = extended(ALERT, acknowledged=BOOLEAN, created_at=TIMESTAMP)
    return SnapshotTable(path, schema, "triggered_at", ("device_id", "triggered_at"))


def live_table(path: str) -> SnapshotTable:
    schema = record(message_id=STRING, device_id=STRING, type=STRING, data=STRING, received_at=STRING)
    return SnapshotTable(path, schema, "received_at", ("device_id", "received_at"))


def telemetry_table(path: str) -> SnapshotTable:
    return SnapshotTable(path, TELEMETRY, "time", ("device_id", "time"))


@dataclass(frozen=True)
class RealtimeOutputs:
    """Alert table, live feed, state table, and the alert log: a broker list, or a folder for `log_format` files.

    Alert table and live feed are folders, or tables as `alert_table` and `live_table` make them.
    """

    alerts: str | SnapshotTable
    live: str | SnapshotTable
    state: str
    log: str
    log_format: str = "parquet"


def publish_alerts(
    fired: DataFrame, outputs: RealtimeOutputs, origin: str, batch_id: int, measures: Measures | None = None
) -> None:
    """Alerts go to the table, the alert log and the live feed; `origin` keeps the jobs' triggers apart."""
    store(alerts.to_alert_table(fired), outputs.alerts, origin, "triggered_at", batch_id)
    messages = event_log.alert_messages(fired)
    with publishing(measures, fired.sparkSession, TOPIC_ALERTS):
        event_log.publish(messages, outputs.log, TOPIC_ALERTS, f"{origin}-{batch_id}", outputs.log_format)
    live = fanout.alert_messages(fired, F.col("triggered_at"))
    store(live, outputs.live, origin, "received_at", batch_id)


def read_alerts(spark: SparkSession, path: str | SnapshotTable) -> DataFrame:
    """The alert table of all jobs."""
    if isinstance(path, SnapshotTable):
        return path.read(spark)
    schema = extended(
        ALERT, acknowledged=BOOLEAN, created_at=TIMESTAMP, origin=STRING, event_date=DATE, batch_id=BIGINT
    )
    return spark.read.schema(schema).parquet(path).drop("origin", "batch_id")


def realtime_batch(outputs: RealtimeOutputs, rules: DataFrame | None = None) -> Callable[[DataFrame, int], None]:
    """Threshold alerts, live messages and latest state of one trigger's accepted events."""

    def process(events: DataFrame, batch_id: int) -> None:
        events = events.persist()
        try:
            if events.isEmpty():
                return
            fired = alerts.alerts_rules(events, rules, arrival="arrived_at")
            publish_alerts(fired, outputs, "rules", batch_id)
            feed = fanout.telemetry_messages(flatten.live_feed(events, "arrived_at"), F.col("arrived_at"))
            store(feed, outputs.live, "telemetry", "received_at", batch_id)
            save_state(events, outputs.state, batch_id)
        finally:
            events.unpersist()

    return process


def save_state(events: DataFrame, path: str, batch_id: int) -> None:
    """Adds the newest event of each device of this trigger; devices without events are not rewritten.

    `version=n` holds trigger n, `base=n` all that was alive of the triggers before n. Both can be
    written again, as the files they are made from stay until the next base.
    """
    spark = events.sparkSession
    newest = state.newest_per_device(events, arrival="arrived_at", carried=(*state.STATE_COLUMNS, "arrived_at"))
    newest.write.mode("overwrite").parquet(f"{path}/version={batch_id}")
    if batch_id == 0 or batch_id % COMPACT_EVERY:
        return
    held = read_state(spark, path, before=batch_id, arrivals=True)
    bases = [n for n in tables.numbered(spark, path, "base") if n < batch_id]
    held.write.mode("overwrite").parquet(f"{path}/base={batch_id}")
    if bases:
        for kind, numbers in (("base", bases[:-1]), ("version", tables.numbered(spark, path, "version"))):
            for n in (n for n in numbers if n < bases[-1]):
                tables.remove(spark, f"{path}/{kind}={n}")


def read_state(
    spark: SparkSession,
    path: str,
    as_of: datetime | str | None = None,
    before: int | None = None,
    arrivals: bool = False,
) -> DataFrame:
    """State per device at `as_of`, by default the newest arrival; the log's clock orders and expires it."""
    bases, versions = (
        [n for n in tables.numbered(spark, path, kind) if before is None or n < before] for kind in ("base", "version")
    )
    parts = [f"{path}/base={n}" for n in bases[-1:]]
    parts += [f"{path}/version={n}" for n in versions if not bases or n >= bases[-1]]
    rows = spark.read.schema(state.ARRIVED_STATE).parquet(*parts) if parts else spark.createDataFrame([], state.ARRIVED_STATE)
    now = rows.agg(F.max(F.col("arrived_at").cast("timestamp_ntz"))).first()[0] if as_of is None else as_of
    if now is None:
        alive = rows
    else:
        carried = (*state.STATE_COLUMNS, "arrived_at")
        alive = state.newest_per_device(state.alive(rows, now, "arrived_at"), arrival="arrived_at", carried=carried)
    return alive if arrivals else alive.drop("arrived_at")


def cooled_alert_stream(fired: DataFrame, seconds: int) -> DataFrame:
    """Alerts without those of a (device, rule) within `seconds` of the last one let through."""
    return first_arrivals(fired, seconds, "triggered_at", ("alert_id",), ("device_id", "rule_id"))


def realtime_job(
    events: DataFrame, outputs: RealtimeOutputs, rules: DataFrame | None = None, marks: Marks | None = None
) -> DataStreamWriter:
    """Of accepted events, or of valid ones with the marks that tell which of them are accepted."""
    process = realtime_batch(outputs, rules)
    return events.writeStream.foreachBatch(process if marks is None else idempotent(marks, process))


SEVERITIES = ("info", "warning", "critical")


def measured_realtime_job(
    parsed: DataFrame, outputs: RealtimeOutputs, marks: Marks, measures: Measures, dead_letters: str, rules: DataFrame | None = None
) -> DataStreamWriter:
    """The realtime job over all messages: dead letters, idempotency, alerts, live feed and state, with its counters."""

    def process(messages: DataFrame, batch_id: int, trigger: Trigger) -> None:
        started = time.monotonic()
        messages = messages.persist()
        try:
            status = F.col("status")
            rejected = {s: status == s for s in (validate.BAD_JSON, validate.BAD_SCHEMA)}
            counted = trigger.observe(messages, "processor_dlq_total", "reason", rejected)
            write_part(event_log.keyed_json(validate.dead_letters(counted, F.col("arrived_at")), None), dead_letters, batch_id)
            valid = valid_stream(messages)
            n_valid = valid.count()
            events = marks.accept(valid, batch_id)
            fired = alerts.alerts_rules(events, rules, arrival="arrived_at").persist()
            try:
                severities = {s: F.col("severity") == s for s in SEVERITIES}
                fired_counted = trigger.observe(fired, "processor_alerts_fired_total", "severity", severities)
                publish_alerts(fired_counted, outputs, "rules", batch_id, measures)
            finally:
                fired.unpersist()
            feed = fanout.telemetry_messages(flatten.live_feed(events, "arrived_at"), F.col("arrived_at"))
            store(feed, outputs.live, "telemetry", "received_at", batch_id)
            save_state(events, outputs.state, batch_id)
            n = events.count()
            trigger.count("processor_events_processed_total", n, status="ok")
            trigger.count("processor_duplicates_total", n_valid - n)
            if n:
                trigger.took("processor_event_duration_seconds", (time.monotonic() - started) / n, n)
        finally:
            messages.unpersist()

    return parsed.writeStream.foreachBatch(measured(measures, "realtime", process))


def measured_telemetry_job(
    parsed: DataFrame, table: SnapshotTable, measures: Measures, compact_every: int = COMPACT_EVERY
) -> DataStreamWriter:
    """The batch job into a compacted table, with its counters."""

    def process(messages: DataFrame, batch_id: int, trigger: Trigger) -> None:
        started = time.monotonic()
        status = F.col("status")
        rejected = {s: status == s for s in (validate.BAD_JSON, validate.BAD_SCHEMA)}
        counted = trigger.observe(messages, "batch_events_invalid_total", "reason", rejected)
        rows = trigger.observe(flatten.to_telemetry(validate.valid_events(counted)), "batch_events_inserted_total")
        if not append_and_compact(table, rows, "telemetry", batch_id, compact_every):
            # Stored before, but maybe not counted: what is observed must be read.
            rows.write.format("noop").mode("overwrite").save()
        n = trigger.observed[-1][0].get.get("n0", 0)
        if n:
            trigger.took("batch_flush_duration_seconds", (time.monotonic() - started) / n, n)

    return parsed.writeStream.foreachBatch(measured(measures, "batch", process))


def anomaly_alert_stream(accepted: DataFrame, arrival: str = "arrived_at") -> DataFrame:
    """Alert rows of anomalous samples."""
    return alerts.anomaly_alerts(anomaly_stream(samples(accepted, arrival)))


def anomaly_job(accepted: DataFrame, outputs: RealtimeOutputs, tails: Tails | None = None) -> DataStreamWriter:
    """Anomaly alerts into the same table, log and live feed as the threshold alerts.

    With `tails`, samples are scored by the batch operator, else by a stateful one within the query.
    """

    def process(fired: DataFrame, batch_id: int) -> None:
        fired = fired.persist()
        try:
            publish_alerts(fired, outputs, "anomaly", batch_id)
        finally:
            fired.unpersist()

    if tails is None:
        return anomaly_alert_stream(accepted).writeStream.foreachBatch(process)
    judged = scored(tails, lambda rows, batch_id: process(alerts.anomaly_alerts(rows), batch_id))
    return samples(accepted, "arrived_at").writeStream.foreachBatch(judged)


def telemetry_job(parsed: DataFrame, path: str) -> DataStreamWriter:
    """Appends valid events to the telemetry table; redelivered events are kept."""
    rows = tables.with_event_date(flatten.to_telemetry(validate.valid_events(parsed)))
    return rows.writeStream.format("parquet").option("path", path).partitionBy("event_date")


def telemetry_table_job(parsed: DataFrame, table: SnapshotTable, compact_every: int = COMPACT_EVERY) -> DataStreamWriter:
    """The same into a table that is compacted between triggers, days ordered by device and time."""
    return snapshot_job(flatten.to_telemetry(validate.valid_events(parsed)), table, "telemetry", compact_every)


def archive_job(parsed: DataFrame, path: str, flushed_at: Column | None = None) -> DataStreamWriter:
    """Bronze files by the hour of the trigger."""
    at = F.current_timestamp() if flushed_at is None else flushed_at
    rows = flatten.with_hive_partitions(flatten.to_bronze(validate.valid_events(parsed)), at)
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("compression", "snappy")
        .partitionBy(*BRONZE_PARTITIONS)
    )


def rollup_stream(telemetry: DataFrame, delay: str = ROLLUP_DELAY) -> DataFrame:
    """Minute rollups, emitted once the watermark has passed them; later rows do not enter."""
    rows = telemetry.withColumn("time", F.col("time").cast("timestamp"))
    return rollup.rollup_1m(rows.withWatermark("time", delay), event_time=True)


def coarse_rollup_stream(one_minute: DataFrame, interval: str) -> DataFrame:
    return rollup.rollup_from_1m(one_minute, interval, time_col="bucket_time")


def aggregate_messages(one_minute: DataFrame) -> DataFrame:
    """Rollup rows as messages of the aggregates topic, keyed by device."""
    rows = one_minute.drop("bucket_time").withColumn("bucket", iso(F.col("bucket")))
    return event_log.keyed_json(rows, "device_id")


def aggregates_job(
    telemetry: DataFrame, target: str, checkpoint: str, delay: str = ROLLUP_DELAY, fmt: str = "kafka"
) -> DataStreamWriter:
    """Closed minutes to the aggregates topic."""
    messages = aggregate_messages(rollup_stream(telemetry, delay))
    return event_log.write_event_log(messages, target, checkpoint, TOPIC_AGGREGATES, fmt)


def silver_stream(spark: SparkSession, bronze_path: str, files: int = SILVER_FILES) -> DataFrame:
    """New bronze files; the checkpoint remembers which were processed."""
    return (
        spark.readStream.schema(tables.bronze_schema())
        .option("maxFilesPerTrigger", files)
        .option("pathGlobFilter", "*.parquet")
        .parquet(bronze_path)
    )


def refine(bronze: DataFrame, silver_path: str, batch_id: int) -> DataFrame:
    """Adds the silver rows of one trigger or run to the table, and returns their counts; only its own folder is listed."""
    spark = bronze.sparkSession
    fresh = silver.silver(bronze, keep=tables.SILVER_TIES)
    (
        fresh.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.block.size", tables.SILVER_ROW_GROUP_BYTES)
        .partitionBy("batch_id", "event_date")
        .parquet(silver_path)
    )
    own = f"{silver_path}/batch_id={batch_id}"
    n_out = F.lit(spark.read.schema(fresh.schema).parquet(own).count() if tables.exists(spark, own) else 0)
    return bronze.agg(F.count("*").alias("events_in")).select(
        "events_in", n_out.cast("bigint").alias("events_out"), (F.col("events_in") - n_out).alias("duplicates_removed")
    )


def silver_batch(silver_path: str, runs_path: str) -> Callable[[DataFrame, int], None]:
    """Refines one trigger's bronze rows.

    A trigger adds its own rows and reads no earlier silver; `tables.read_silver` shows the latest
    ingestion of each event, whichever triggers and days its copies came in.
    """

    def process(bronze: DataFrame, batch_id: int) -> None:
        spark = bronze.sparkSession
        started = time.monotonic()
        bronze = bronze.persist()
        try:
            stats = refine(bronze, silver_path, batch_id)
            n_files = bronze.select("_file").distinct().count() if "_file" in bronze.columns else 0
            known = files_before(spark, runs_path, batch_id)
            elapsed = (time.monotonic() - started) * 1000
            write_part(silver.run_summary(stats, n_files, known, elapsed), runs_path, batch_id)
        finally:
            bronze.unpersist()

    return process


def files_before(spark: SparkSession, runs_path: str, batch_id: int) -> int:
    """Bronze files that earlier runs processed, which this run skips; the summary of the run before knows the sum."""
    before = batch_id - 1
    if not tables.exists(spark, f"{runs_path}/batch_id={before}/_SUCCESS"):
        # A gap, as after a new checkpoint.
        earlier = [n for n in tables.numbered(spark, runs_path, "batch_id") if n < batch_id]
        if not earlier:
            return 0
        before = earlier[-1]
    last = spark.read.parquet(f"{runs_path}/batch_id={before}").first()
    return last["processed_files"] + last["skipped_files"]


def silver_run(
    spark: SparkSession, bronze_path: str, silver_path: str, runs_path: str, ledger: Ledger, files: int = SILVER_FILES
) -> int:
    """One scheduled run: refines the next bronze files that the ledger doesn't have, and says how many they were.

    A run that stopped before it was closed in the ledger is made again with the same number and replaces its rows.
    """
    started = time.monotonic()
    head = ledger.head(spark)
    run = head.run + 1
    taken, open_files = ledger.pending(spark, bronze_path, files)
    if not taken:
        return 0
    paths = [f"{bronze_path}/{f}" for f in taken]
    bronze = spark.read.schema(tables.bronze_schema()).option("basePath", bronze_path).parquet(*paths)
    bronze = bronze.withColumn("_file", F.col("_metadata.file_path")).persist()
    try:
        stats = refine(bronze, silver_path, run)
        hour = rf"({'/'.join(f'{c}=[^/]+' for c in BRONZE_PARTITIONS)}/[^/]+)$"
        per_file = bronze.groupBy(F.regexp_extract("_file", hour, 1).alias("path")).agg(F.count("*").alias("rows"))
        elapsed = (time.monotonic() - started) * 1000
        write_part(silver.run_summary(stats, len(taken), head.n_done, elapsed), runs_path, run)
        ledger.commit(spark, run, taken, open_files, per_file)
    finally:
        bronze.unpersist()
    return len(taken)


def silver_job(bronze: DataFrame, silver_path: str, runs_path: str) -> DataStreamWriter:
    with_file = bronze.withColumn("_file", F.col("_metadata.file_path"))
    return with_file.writeStream.foreachBatch(silver_batch(silver_path, runs_path))


def live_stream(accepted: DataFrame) -> DataFrame:
    """Live telemetry messages as a stream of their own."""
    return fanout.telemetry_messages(flatten.live_feed(accepted, "arrived_at"), F.col("arrived_at"))

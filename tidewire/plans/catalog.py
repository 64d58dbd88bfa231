"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.ids import uuid_v7
from tidewire.functions.maps import entry, rendered
from tidewire.functions.times import millis
from tidewire.operators import alerts as A
from tidewire.operators import anomaly as Z
from tidewire.operators import dedup, external, fanout, flatten, history, ingest, quality, rollup, silver, state, validate
from tidewire.plans import adapter
from tidewire.schemas import AIR_QUALITY_RESPONSE, WEATHER_RESPONSE
from tidewire.session import cut_lineage, scratch_path
from tidewire.sources import landed, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DEVICE = "dev-0001"
FIRST, LAST = datetime(2024, 1, 1), datetime(2024, 1, 31)
COOLDOWN_SECONDS = 300


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _ntz(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _rounded(frame: DataFrame, *columns: str) -> DataFrame:
    """Six decimals; the offset keeps averages of hundredths off the exact rounding ties."""
    return frame.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in columns})


# --- raw edge ---------------------------------------------------------------------------------


def _parsed_log(spark, sf):
    # The event timestamp replaces the log's column of the same name.
    log = adapter.event_log(spark, sf).withColumnRenamed("timestamp", "logged_at")
    return validate.parse_events(log)


@query
def validate_status(spark, sf):
    rows = _parsed_log(spark, sf).select(
        "id", "status", "event_id", "device_id", "timestamp",
        entry("metrics", "temperature").alias("temperature"), "source",
    )
    return _ntz(rows, "timestamp")


@query
def invalid_counts(spark, sf):
    return validate.invalid_counts(_parsed_log(spark, sf))


@query
def dlq_rows(spark, sf):
    return validate.dead_letters(_parsed_log(spark, sf), F.col("logged_at"))


@query
def device_validate(spark, sf):
    return validate.device_status(adapter.device_documents(spark, sf)).select("id", "status")


@query
def ingest_validate(spark, sf):
    return ingest.ingest_validate(adapter.http_requests(spark, sf)).select("request_id", "status")


def _event_view(events: DataFrame, *keys: str) -> DataFrame:
    rows = events.select(
        *keys, "event_id", "device_id", "timestamp", "ingested_at", "schema_version", "source",
        entry("metrics", "temperature").alias("temperature"),
        F.size("metrics").cast("bigint").alias("n_metrics"),
        entry("tags", "region").alias("region"),
    )
    return _ntz(rows, "timestamp", "ingested_at")


@query
def ingest_normalize(spark, sf):
    return _event_view(ingest.ingest_normalize(adapter.http_requests(spark, sf)), "request_id")


@query
def ingest_batch_explode(spark, sf):
    rows = ingest.ingest_batch(adapter.batch_requests(spark, sf))
    return _event_view(rows, "request_id", "position").withColumn("position", F.col("position").cast("bigint"))


@query
def mqtt_topic_parse(spark, sf):
    return ingest.mqtt_topics(adapter.mqtt_messages(spark, sf)).select("message_id", "device_id")


@query
def mqtt_normalize(spark, sf):
    return _event_view(ingest.mqtt_normalize(adapter.mqtt_messages(spark, sf)), "message_id")


@query
def event_id_v7(spark, sf):
    log = adapter.event_log(spark, sf)
    return log.select("id", uuid_v7(F.col("timestamp"), F.col("topic"), F.col("partition"), F.col("offset")).alias("uuid"))


def _requests(spark, sf):
    """Requests of a third of the models carry no API key and count by region, as their address."""
    api_key = F.when(F.col("model") == "SHT31", " ").otherwise(F.col("source"))
    return adapter.wide(spark, sf).withColumn("client", quality.client_key(api_key, F.col("region")))


@query
def rate_limit_audit(spark, sf):
    # Five keys share a request a second.
    return quality.rate_limit_audit(_requests(spark, sf), "client", "dense_ingested_at", limit=12)


@query
def rate_limit_by_clock(spark, sf):
    return quality.rate_limit_by_clock(_requests(spark, sf), "client", "dense_ts", limit=15)


# --- bronze and silver ------------------------------------------------------------------------


@query
def bronze_flatten(spark, sf):
    return _ntz(flatten.to_bronze(adapter.events(spark, sf)).drop("metrics", "tags"), "timestamp", "ingested_at")


@query
def bronze_layout(spark, sf):
    rows = flatten.with_hive_partitions(adapter.wide(spark, sf), F.col("timestamp"))
    return flatten.bronze_keys(rows, "raw").groupBy("directory", "year", "month", "day", "hour").agg(
        F.count("*").alias("n")
    )


@query
def bronze_scan(spark, sf):
    """Reads two bronze folders as one relation."""
    rows = adapter.bronze(spark, sf)
    paths = []
    for part in (F.col("source") == "http", F.col("source") != "http"):
        paths.append(scratch_path(spark, "bronze"))
        tables.write_bronze(rows.filter(part), paths[-1], F.col("ingested_at"))
    return tables.read_bronze(spark, *paths).groupBy("source", "year", "month", "day").agg(F.count("*").alias("n"))


def _silver(spark, sf):
    return silver.silver(adapter.bronze(spark, sf))


QUERIES["silver"] = _silver


@query
def silver_dedup(spark, sf):
    return silver.latest_ingestion(adapter.bronze(spark, sf)).select("event_id", "device_id", "ingested_at")


@query
def silver_by_category(spark, sf):
    return silver.silver_by_category(_silver(spark, sf))


@query
def silver_increment(spark, sf):
    """All of bronze against silver that already holds the older half of January."""
    bronze = adapter.bronze(spark, sf)
    known = silver.silver(bronze.filter(F.col("timestamp") < F.lit("2024-01-16")))
    return silver.silver_increment(bronze, known).select("event_id", "device_id", "ingested_at", "temp_category")


@query
def silver_stats(spark, sf):
    """The time a run takes is not a matter of the data."""
    files, manifest = adapter.file_listing(spark, sf)
    pending = quality.pending_files(files, manifest).count()
    known = files.filter(F.col("path").endswith(".parquet")).join(manifest, "path", "left_semi").count()
    stats = silver.silver_stats(adapter.bronze(spark, sf))
    return silver.run_summary(stats, pending, known, 0.0).drop("duration_ms")


@query
def silver_removed(spark, sf):
    return silver.silver_stats(adapter.bronze(spark, sf))


@query
def pending_files(spark, sf):
    return quality.pending_files(*adapter.file_listing(spark, sf))


@query
def manifest_compact(spark, sf):
    _, manifest = adapter.file_listing(spark, sf)
    return quality.manifest_compact(manifest)


# --- telemetry table, rollups, history -----------------------------------------------------------


@query
def telemetry_append(spark, sf):
    rows = adapter.telemetry(spark, sf)
    return rows.select(
        "time", "device_id", "event_id", "source", "ingested_at",
        rendered("tags", ",").alias("tags"), F.array_join(F.array_sort(F.map_keys("metrics")), ",").alias("metric_names"),
    )


ROLLED = ("avg_temperature", "avg_humidity", "avg_pressure")


@query
def rollup_1m(spark, sf):
    return _rounded(rollup.rollup_1m(adapter.telemetry(spark, sf)), *ROLLED)


def _rollup(spark, sf, interval):
    return rollup.rollup_from_1m(rollup.rollup_1m(adapter.telemetry(spark, sf)), interval)


@query
def rollup_5m(spark, sf):
    return _rounded(_rollup(spark, sf, "5m"), *ROLLED)


@query
def rollup_1h(spark, sf):
    return _rounded(_rollup(spark, sf, "1h"), *ROLLED)


def _weighted(spark, sf, interval):
    return rollup.weighted_from_1m(rollup.rollup_1m(adapter.telemetry(spark, sf), sums=True), interval)


@query
def rollup_5m_weighted(spark, sf):
    return _rounded(_weighted(spark, sf, "5m"), *ROLLED)


@query
def rollup_1h_weighted(spark, sf):
    return _rounded(_weighted(spark, sf, "1h"), *ROLLED)


@query
def rollup_refresh(spark, sf):
    rows = adapter.telemetry(spark, sf)
    return _rounded(rollup.rollup_refresh(rows, adapter.newest(rows, "time")), *ROLLED)


@query
def retention_keep(spark, sf):
    rows = adapter.wide(spark, sf).select("event_id", F.col("timestamp").alias("time"))
    return rollup.retention_keep(rows, "2024-02-10T12:00:00")


def _history(spark, sf, interval, **kw):
    rows = adapter.telemetry(spark, sf)
    relation = rows
    if interval != "raw":
        path = scratch_path(spark, "rollup")
        tables.write_rollup(rollup.rollup_1m(rows) if interval == "1m" else _rollup(spark, sf, interval), path)
        relation = tables.read_rollup(spark, path)
    args = {"start": FIRST, "end": LAST, "limit": 10_000, **kw}
    return history.history({interval: relation}, DEVICE, LAST, interval=interval, **args)


MEASURES = ("temperature", "humidity", "pressure")


@query
def history_raw(spark, sf):
    return _history(spark, sf, "raw")


@query
def history_default(spark, sf):
    """The default range and limit, asked at the time of the newest reading."""
    rows = adapter.telemetry(spark, sf)
    return history.history({"raw": rows}, DEVICE, adapter.newest(rows, "time"))


@query
def history_1m(spark, sf):
    return _rounded(_history(spark, sf, "1m"), *MEASURES)


@query
def history_5m(spark, sf):
    return _rounded(_history(spark, sf, "5m"), *MEASURES)


@query
def history_1h(spark, sf):
    return _rounded(_history(spark, sf, "1h"), *MEASURES)


@query
def history_envelope(spark, sf):
    envelope = history.history_envelope(_history(spark, sf, "raw"), DEVICE, "raw", FIRST, LAST)
    options = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"}
    return envelope.withColumn("data", F.to_json("data", options))


# --- alerts and anomalies ------------------------------------------------------------------------


@query
def metrics_long(spark, sf):
    return flatten.metrics_long(adapter.events(spark, sf), "event_id", "device_id")


def _alerts(spark, sf):
    return A.alerts_rules(adapter.events(spark, sf))


def _scored(spark, sf):
    return Z.anomaly_zscore(Z.samples(adapter.events(spark, sf)))


def _all_alerts(spark, sf):
    return A.alerts_all(_alerts(spark, sf), A.anomaly_alerts(_scored(spark, sf)))


@query
def alerts_rules(spark, sf):
    return _alerts(spark, sf)


@query
def alerts_device_rules(spark, sf):
    """Rules held in a table: some for all devices, and one for the device named after each supplier."""
    general = A.rules_frame(spark)
    personal = (
        spark.read.parquet(f"{sf}/supplier.parquet")
        .select(
            F.concat(F.lit("own-"), F.col("s_suppkey").cast("string")).alias("rule_id"),
            F.concat(F.lit("dev-"), F.lpad(F.col("s_suppkey").cast("string"), 4, "0")).alias("device_id_pattern"),
            F.lit("humidity").alias("metric"),
            F.lit(">=").alias("operator"),
            F.lit(60.0).alias("threshold"),
            F.lit("info").alias("severity"),
            F.col("s_name").alias("message"),
        )
    )
    return A.alerts_rules(adapter.events(spark, sf), general.unionByName(personal)).drop("alert_id")


@query
def anomaly_zscore(spark, sf):
    return _rounded(_scored(spark, sf), "mean", "std_dev", "z_score")


@query
def anomaly_alerts(spark, sf):
    return _rounded(A.anomaly_alerts(_scored(spark, sf)), "threshold")


@query
def alerts_all(spark, sf):
    return _rounded(_all_alerts(spark, sf), "threshold")


@query
def alert_log(spark, sf):
    return _rounded(A.alert_log(_all_alerts(spark, sf)), "threshold")


@query
def alerts_open(spark, sf):
    """Alerts of values below 45 count as acknowledged."""
    table = A.to_alert_table(_alerts(spark, sf)).withColumn("acknowledged", F.col("value") < 45)
    return A.alerts_open(table).drop("created_at")


@query
def alert_cooldown(spark, sf):
    return A.alert_cooldown(_alerts(spark, sf), COOLDOWN_SECONDS)


@query
def recent_samples(spark, sf):
    return Z.recent_samples(Z.samples(adapter.events(spark, sf)))


# --- state, devices, live feed ---------------------------------------------------------------------


@query
def realtime_dedup(spark, sf):
    return dedup.realtime_dedup(adapter.redelivered_events(spark, sf)).select("event_id", "device_id", "ingested_at")


def _state(spark, sf, **kw):
    rows = adapter.events(spark, sf)
    return state.latest_state(rows, adapter.newest(rows, "ingested_at"), **kw)


def _state_view(frame: DataFrame) -> DataFrame:
    return frame.select(
        "device_id", "timestamp", "ingested_at", "source",
        *[entry("metrics", m).alias(m) for m in MEASURES],
        entry("tags", "region").alias("region"),
    )


@query
def latest_state(spark, sf):
    s = _state(spark, sf)
    return s.select(
        "device_id", "event_id", "timestamp", "ingested_at", "source",
        *[entry("metrics", m).alias(m) for m in MEASURES], entry("tags", "region").alias("region"),
    )


@query
def latest_state_by_event_time(spark, sf):
    return _state_view(_state(spark, sf, by="event_time"))


@query
def devices_list(spark, sf):
    return _state_view(state.devices_list(_state(spark, sf)))


@query
def devices_count(spark, sf):
    return state.devices_count(_state(spark, sf))


@query
def device_get(spark, sf):
    return _state_view(state.device_get(_state(spark, sf), DEVICE))


@query
def device_point_read(spark, sf):
    """The same from a stored state, of which one bucket's file is read."""
    path = scratch_path(spark, "state")
    tables.write_by_device(_state(spark, sf), path)
    return _state_view(state.devices_list(tables.read_device(spark, path, DEVICE)))


@query
def device_board(spark, sf):
    board = state.board_order(state.device_board(adapter.events(spark, sf)))
    return board.select(
        "device_id", "timestamp", rendered("tags").alias("tags"), *[entry("metrics", m).alias(m) for m in MEASURES]
    )


@query
def device_registry(spark, sf):
    return state.device_registry(adapter.events(spark, sf))


@query
def active_devices(spark, sf):
    rows = adapter.events(spark, sf)
    return state.active_devices(rows, adapter.newest(rows, "ingested_at"))


@query
def live_feed(spark, sf):
    feed = flatten.live_feed(adapter.events(spark, sf))
    return feed.select(
        "event_id", "device_id", "timestamp",
        *[entry("metrics", m).alias(m) for m in MEASURES], rendered("tags", ",").alias("tags"),
    )


def _messages(spark, sf):
    events = adapter.events(spark, sf)
    feed = fanout.telemetry_messages(flatten.live_feed(events), F.col("timestamp"))
    return feed.unionByName(fanout.alert_messages(A.alerts_rules(events), F.col("triggered_at")))


def _members(spark, sf):
    log = adapter.subscription_log(spark, sf)
    return fanout.audience_members(log, log.select("client_id").distinct())


@query
def audience_members(spark, sf):
    return _members(spark, sf)


@query
def live_fanout(spark, sf):
    routed = fanout.live_fanout(_messages(spark, sf), _members(spark, sf))
    return routed.select("message_id", "device_id", "type", "audience", "n_clients", "received_at")


@query
def live_messages_sent(spark, sf):
    return fanout.messages_sent(fanout.live_fanout(_messages(spark, sf), _members(spark, sf)))


@query
def live_client_feed(spark, sf):
    members = _members(spark, sf)
    routed = fanout.live_fanout(_messages(spark, sf), members)
    return fanout.client_feed(routed, members, "client-07").select("message_id", "type", "device_id")


def _intervals(spark, sf):
    return cut_lineage(fanout.audience_intervals(adapter.client_log(spark, sf)), "intervals")


@query
def live_fanout_asof(spark, sf):
    routed = fanout.live_fanout_asof(_messages(spark, sf), _intervals(spark, sf))
    return routed.select("message_id", "device_id", "type", "audience", "n_clients", "received_at")


@query
def live_client_feed_asof(spark, sf):
    found = fanout.client_feed_asof(_messages(spark, sf), _intervals(spark, sf), "client-07")
    return found.select("message_id", "type", "device_id", "audience")


@query
def live_device_filter(spark, sf):
    return fanout.live_device_filter(_messages(spark, sf), f" {DEVICE} ").select("message_id", "type", "device_id")


# --- external feeds ----------------------------------------------------------------------------


def _weather(spark, sf, **kw):
    responses = landed.parse_responses(adapter.weather_responses(spark, sf), WEATHER_RESPONSE)
    return external.weather_normalize(responses, **kw)


def _air_quality(spark, sf):
    responses = landed.parse_responses(adapter.air_quality_responses(spark, sf), AIR_QUALITY_RESPONSE)
    return external.aq_normalize(responses)


def _external_view(events: DataFrame) -> DataFrame:
    rows = events.select(
        "event_id", "device_id", "timestamp", "ingested_at", "schema_version", "source",
        rendered("tags", ",").alias("tags"),
        *[
            entry("metrics", m).alias(m)
            for m in ("temperature", "humidity", "wind_speed", "weather_code", "pm25", "o3")
        ],
        F.size("metrics").cast("bigint").alias("n_metrics"),
    )
    return _ntz(rows, "timestamp", "ingested_at")


@query
def weather_normalize(spark, sf):
    return _external_view(_weather(spark, sf)).drop("pm25", "o3")


@query
def weather_missing_as_null(spark, sf):
    return _external_view(_weather(spark, sf, missing_as_null=True)).select(
        "event_id", "temperature", "humidity", "weather_code", "n_metrics"
    )


@query
def aq_normalize(spark, sf):
    return _external_view(_air_quality(spark, sf)).drop("temperature", "humidity", "wind_speed", "weather_code")


@query
def external_events(spark, sf):
    return _external_view(external.external_events(_weather(spark, sf), _air_quality(spark, sf)))


@query
def weather_board(spark, sf):
    events = _weather(spark, sf)
    newest = state.newest_per_device(events)
    return _ntz(external.weather_board(newest), "timestamp")


# --- counters, histograms, lag -------------------------------------------------------------------


@query
def pipeline_counters(spark, sf):
    c = F.col
    # Messages are parsed once; all counters by status come from this small table.
    outcomes = cut_lineage(
        _parsed_log(spark, sf).groupBy("status", "source").agg(F.count("*").alias("n")), "outcomes"
    )
    ok = outcomes.filter(c("status") == validate.OK)
    rejected = outcomes.filter(c("status").isin(validate.BAD_JSON, validate.BAD_SCHEMA))
    arrived = adapter.redelivered_events(spark, sf)
    accepted = dedup.realtime_dedup(arrived)
    skipped = arrived.select(F.lit(1).alias("n")).unionByName(accepted.select(F.lit(-1).alias("n")))
    requests = ingest.ingest_validate(adapter.http_requests(spark, sf)).groupBy("status").agg(F.count("*").alias("n"))
    outcome = F.when(c("status") == validate.OK, "ok").otherwise("invalid")
    messages = adapter.mqtt_messages(spark, sf).select(F.lit(1).alias("n"))
    bridged = ingest.mqtt_normalize(adapter.mqtt_messages(spark, sf)).select(F.lit(-1).alias("n"))
    runs = silver.silver_stats(adapter.bronze(spark, sf))
    n = c("n")
    return quality.counters(
        quality.counter(requests, "ingest_events_total", n, source=F.lit("http"), status=outcome),
        quality.counter(bridged, "ingest_events_total", -n, source=F.lit("mqtt"), status=F.lit("ok")),
        quality.counter(messages.unionByName(bridged), "ingest_events_total", n, source=F.lit("mqtt"), status=F.lit("invalid")),
        quality.counter(accepted, "processor_events_processed_total", status=F.lit("ok")),
        quality.counter(skipped, "processor_duplicates_total", n),
        quality.counter(rejected, "processor_dlq_total", n, reason=c("status")),
        quality.counter(rejected, "batch_events_invalid_total", n, reason=c("status")),
        quality.counter(ok, "batch_events_inserted_total", n),
        quality.counter(ok, "archive_events_buffered_total", n),
        quality.counter(runs, "silver_events_in_total", c("events_in")),
        quality.counter(runs, "silver_events_out_total", c("events_out")),
        quality.counter(runs, "silver_duplicates_removed_total", c("duplicates_removed")),
        quality.counter(_alerts(spark, sf), "processor_alerts_fired_total", severity=c("severity")),
        quality.counter(_scored(spark, sf).filter("is_anomaly"), "processor_anomalies_detected_total", metric=c("metric")),
    )


@query
def latency_histogram(spark, sf):
    rows = adapter.wide(spark, sf)
    seconds = (millis(F.col("ingested_at")) - millis(F.col("timestamp"))) / 1000
    return _rounded(quality.histogram(rows, seconds, quality.INGEST_LATENCY, ["source"]), "sum")


@query
def consumer_lag(spark, sf):
    return quality.consumer_lag(*adapter.offsets(spark, sf))

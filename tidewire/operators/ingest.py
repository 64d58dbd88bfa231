"""Normalisation of HTTP bodies and MQTT messages into canonical events.

Ingest time is a column of the request, never the clock of the task, so a rerun gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import checks as C
from tidewire.functions.ids import uuid_v7
from tidewire.functions.times import iso
from tidewire.operators.validate import BAD_JSON, BAD_SCHEMA, OK, SCHEMA_VERSION

MAX_BATCH = 1000


def _body(doc: Column) -> Column:
    """Typed HTTP body of one event, with `valid`.

    The metric-key bound of the canonical schema is applied here as well, so that a body that
    passes is sure to normalise.
    """
    device = C.text_member(doc, "deviceId")
    ts = C.instant_text(C.text_member(doc, "timestamp"))
    metrics = C.numbers_map(C.member(doc, "metrics"))
    tags = C.strings_map(C.member(doc, "tags"))
    valid = (
        C.is_object(doc)
        & C.length_between(device, 1, 128)
        & (C.member(doc, "timestamp").isNull() | ts.isNotNull())
        & metrics.isNotNull()
        & (C.member(doc, "tags").isNull() | tags.isNotNull())
    )
    return F.struct(
        C.is_true(valid).alias("valid"),
        device.alias("device_id"),
        ts.alias("timestamp"),
        metrics.alias("metrics"),
        tags.alias("tags"),
    )


def ingest_validate(requests: DataFrame, body: str = "body") -> DataFrame:
    """Adds `status` and `event` (the typed body) to single-event requests."""
    doc = F.col("_doc")
    return (
        C.staged(C.with_document(requests, body), event=_body(doc))
        .withColumn(
            "status",
            F.when(doc.isNull(), BAD_JSON).when(~F.col("event.valid"), BAD_SCHEMA).otherwise(OK),
        )
        .drop("_doc")
    )


def _canonical(events: DataFrame, keep: list[str], received: str, source: str, position: list[Column]) -> DataFrame:
    at = F.col(received).cast("timestamp")
    return events.select(
        *keep,
        uuid_v7(at, *position).alias("event_id"),
        F.col("event.device_id").alias("device_id"),
        F.coalesce(F.col("event.timestamp"), at).alias("timestamp"),
        at.alias("ingested_at"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.col("event.metrics").alias("metrics"),
        F.col("event.tags").alias("tags"),
        F.lit(source).alias("source"),
    )


def ingest_normalize(
    requests: DataFrame, request_id: str = "request_id", received: str = "received_at", body: str = "body"
) -> DataFrame:
    """Valid single-event requests as canonical events."""
    ok = ingest_validate(requests, body).filter(F.col("status") == OK)
    return _canonical(ok, [request_id], received, "http", [F.col(request_id), F.lit(0)])


def ingest_batch(
    requests: DataFrame, request_id: str = "request_id", received: str = "received_at", body: str = "body"
) -> DataFrame:
    """Batch requests as canonical events: 1 to 1000 events, all of them valid or none accepted."""
    doc = F.col("_doc")
    members = F.try_variant_get(doc, "$.events", "array<variant>")
    bodies = F.when(C.member(doc, "events").isNotNull(), F.transform(members, _body))
    accepted = F.size("_bodies").between(1, MAX_BATCH) & F.forall("_bodies", lambda b: b["valid"])
    rows = (
        C.staged(C.with_document(requests, body), _bodies=bodies)
        .filter(C.is_true(accepted))
        .select(request_id, received, F.posexplode("_bodies").alias("position", "event"))
    )
    return _canonical(rows, [request_id, "position"], received, "http", [F.col(request_id), F.col("position")])


def mqtt_device(topic: Column) -> Column:
    """Device of `devices/{id}/telemetry`; NULL for any other topic or an empty id."""
    parts = F.split(topic, "/", -1)
    device = F.get(parts, 1)
    fits = (F.size(parts) == 3) & (F.get(parts, 0) == "devices") & (F.get(parts, 2) == "telemetry") & (device != "")
    return F.when(fits, device)


def mqtt_topics(messages: DataFrame, topic: str = "topic") -> DataFrame:
    return messages.withColumn("device_id", mqtt_device(F.col(topic))).filter(F.col("device_id").isNotNull())


def mqtt_normalize(
    messages: DataFrame,
    message_id: str = "message_id",
    received: str = "received_at",
    topic: str = "topic",
    payload: str = "payload",
) -> DataFrame:
    """Valid messages as canonical events; invalid ones are dropped without a dead letter.

    A payload that is not an object is a valid event without metrics; `size(metrics) = 0` finds it.
    """
    doc = F.col("_doc")
    stamp = C.member(doc, "timestamp")
    metrics = C.member(doc, "metrics")
    ts = C.instant_text(C.text_member(doc, "timestamp"))
    values = C.numbers_map(metrics)
    tags = C.strings_map(C.member(doc, "tags"))
    no_metrics = F.create_map().cast("map<string,double>")
    event = F.struct(
        F.col("device_id"),
        ts.alias("timestamp"),
        F.when(metrics.isNull(), no_metrics).otherwise(values).alias("metrics"),
        tags.alias("tags"),
        C.is_true(
            C.length_between(F.col("device_id"), 1, 128)
            & (stamp.isNull() | ts.isNotNull())
            & (metrics.isNull() | values.isNotNull())
            & (C.member(doc, "tags").isNull() | tags.isNotNull())
        ).alias("valid"),
    )
    parsed = C.with_document(mqtt_topics(messages, topic), payload).filter(doc.isNotNull())
    rows = C.staged(parsed, event=event).filter("event.valid")
    return _canonical(rows, [message_id], received, "mqtt", [F.col(topic), F.col(message_id)])


def to_log_record(events: DataFrame) -> DataFrame:
    """Canonical events as keyed JSON messages; the key keeps a device's events in one log partition."""
    value = F.to_json(
        F.struct(
            F.col("event_id").alias("eventId"),
            F.col("device_id").alias("deviceId"),
            iso(F.col("timestamp")).alias("timestamp"),
            iso(F.col("ingested_at")).alias("ingestedAt"),
            F.col("schema_version").alias("schemaVersion"),
            "metrics",
            "tags",
            "source",
        )
    )
    return events.select(F.col("device_id").alias("key"), value.alias("value"))

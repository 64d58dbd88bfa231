"""Validation of raw event text and routing of what fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import checks as C
from tidewire.functions.times import iso

EMPTY, BAD_JSON, BAD_SCHEMA, OK = "empty", "invalid_json", "schema_invalid", "ok"

SOURCES = ("http", "mqtt", "replay")
SCHEMA_VERSION = "1.0"

EVENT_COLUMNS = (
    "event_id", "device_id", "timestamp", "ingested_at",
    "schema_version", "metrics", "tags", "source",
)


# Message field names of an event (fixed values).
MESSAGE_FIELDS = (
    "eventId", "deviceId", "timestamp", "ingestedAt", "schemaVersion", "metrics", "tags", "source",
)


def parse_events(log: DataFrame, value: str = "value") -> DataFrame:
    """Adds `status` and the typed event columns (NULL unless the status is ok).

    Precedence: empty, invalid_json, schema_invalid, ok.
    """
    c, text, doc = F.col, F.col(value), F.col("_doc")
    opened = C.staged(
        C.with_document(log, value),
        _object=C.is_object(doc),
        _m=C.members(doc, *MESSAGE_FIELDS),
    )
    metrics, tags = c("_m.metrics"), c("_m.tags")
    typed = C.staged(
        opened,
        _event_id=C.text(c("_m.eventId")),
        _device_id=C.text(c("_m.deviceId")),
        _timestamp_text=C.text(c("_m.timestamp")),
        _ingested_at_text=C.text(c("_m.ingestedAt")),
        _schema_version=C.text(c("_m.schemaVersion")),
        _metrics_object=C.is_object(metrics),
        _metrics_members=C.variants(metrics),
        _metrics=C.numbers(metrics),
        _no_tags=tags.isNull(),
        _tags_object=C.is_object(tags),
        _tags_members=C.variants(tags),
        _tags=C.strings(tags),
        _source=C.text(c("_m.source")),
    )
    fields = C.staged(
        typed,
        _timestamp=C.instant_text(c("_timestamp_text")),
        _ingested_at=C.instant_text(c("_ingested_at_text")),
    )
    valid = C.is_true(
        c("_object")
        & c("_event_id").rlike(C.UUID_FORMAT)
        & C.length_between(c("_device_id"), 1, 128)
        & c("_timestamp").isNotNull()
        & c("_ingested_at").isNotNull()
        & (c("_schema_version") == SCHEMA_VERSION)
        & c("_source").isin(*SOURCES)
        & c("_metrics_object")
        & C.numbers_valid(c("_metrics_members"), c("_metrics"))
        # Tags are optional, yet a JSON null is not allowed: absent means no variant at all.
        & (c("_no_tags") | (c("_tags_object") & C.strings_valid(c("_tags_members"))))
    )
    status = (
        F.when(text.isNull() | (text == ""), EMPTY)
        .when(doc.isNull(), BAD_JSON)
        .when(~valid, BAD_SCHEMA)
        .otherwise(OK)
    )
    ok = c("status") == OK
    return C.staged(fields, status=status).select(
        *log.columns, "status", *[F.when(ok, c(f"_{name}")).alias(name) for name in EVENT_COLUMNS]
    )


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("status") == OK)


def dead_letters(parsed: DataFrame, at: Column, value: str = "value") -> DataFrame:
    """Rejected messages as {reason, error, raw, timestamp}; empty values are skipped, not rejected."""
    error = F.when(F.col("status") == BAD_JSON, "value is not one JSON document").otherwise(
        "value does not match the telemetry event schema"
    )
    return parsed.filter(F.col("status").isin(BAD_JSON, BAD_SCHEMA)).select(
        F.col("status").alias("reason"),
        error.alias("error"),
        F.substring(F.col(value), 1, 1000).alias("raw"),
        iso(at).alias("timestamp"),
    )


def invalid_counts(parsed: DataFrame) -> DataFrame:
    return (
        parsed.filter(F.col("status").isin(BAD_JSON, BAD_SCHEMA))
        .groupBy(F.col("status").alias("reason"))
        .agg(F.count("*").alias("n"))
    )


def device_status(devices: DataFrame, value: str = "value") -> DataFrame:
    """Device metadata check: bounded ids and names, optional model, region and string tags."""
    doc = F.col("_doc")

    def optional_text(name: str) -> Column:
        s = C.text_member(doc, name)
        return C.member(doc, name).isNull() | C.length_between(s, 0, 64)

    valid = C.is_true(
        C.is_object(doc)
        & C.length_between(C.text_member(doc, "deviceId"), 1, 128)
        & C.length_between(C.text_member(doc, "name"), 1, 128)
        & optional_text("model")
        & optional_text("region")
        & (C.member(doc, "tags").isNull() | C.strings_map(C.member(doc, "tags")).isNotNull())
    )
    status = F.when(doc.isNull(), BAD_JSON).when(~valid, BAD_SCHEMA).otherwise(OK)
    return (
        C.with_document(devices, value)
        .withColumn("status", status)
        .drop("_doc")
    )

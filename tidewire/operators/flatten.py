"""Projections of canonical events: telemetry table rows, bronze rows, long metric rows, live feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.maps import entry

METRICS = ("temperature", "humidity", "pressure")


def to_telemetry(events: DataFrame) -> DataFrame:
    """Rows of the telemetry table; redelivered events are not removed here."""
    return events.select(
        F.col("timestamp").alias("time"),
        "device_id",
        "event_id",
        "metrics",
        F.coalesce("tags", F.create_map().cast("map<string,string>")).alias("tags"),
        "source",
        "ingested_at",
    )


def to_bronze(events: DataFrame) -> DataFrame:
    """Flat archive row: three metrics and four tags promoted, full maps kept beside them."""
    return events.select(
        "event_id",
        "device_id",
        F.date_trunc("MILLISECOND", "timestamp").alias("timestamp"),
        F.date_trunc("MILLISECOND", "ingested_at").alias("ingested_at"),
        "schema_version",
        "source",
        *[entry("metrics", m).alias(m) for m in METRICS],
        entry("tags", "region").alias("region"),
        entry("tags", "model").alias("model"),
        entry("tags", "lat").try_cast("double").alias("lat"),
        entry("tags", "lon").try_cast("double").alias("lon"),
        "metrics",
        "tags",
    )


def with_hive_partitions(bronze: DataFrame, flushed_at: Column) -> DataFrame:
    """Zero-padded year/month/day/hour of the flush time (not of the event time)."""
    at = flushed_at.cast("timestamp")
    return bronze.withColumns(
        {
            "year": F.date_format(at, "yyyy"),
            "month": F.date_format(at, "MM"),
            "day": F.date_format(at, "dd"),
            "hour": F.date_format(at, "HH"),
        }
    )


def bronze_keys(bronze: DataFrame, zone: str) -> DataFrame:
    """Directory of every row under the hourly layout."""
    part = [F.concat(F.lit(f"{c}="), F.col(c)) for c in ("year", "month", "day", "hour")]
    return bronze.withColumn("directory", F.concat_ws("/", F.lit(zone), *part))


def metrics_long(events: DataFrame, *keep: str) -> DataFrame:
    """One row per (event, metric)."""
    return events.select(*keep, F.explode("metrics").alias("metric", "value"))


def live_feed(events: DataFrame, *keep: str) -> DataFrame:
    return events.select("event_id", "device_id", "metrics", "tags", "timestamp", *keep)

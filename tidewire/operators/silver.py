"""Bronze to silver: drop incomplete rows, keep the latest ingestion per event, derive columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tidewire.functions.times import millis

REQUIRED = ("event_id", "device_id", "timestamp")

CARRIED = (
    "event_id", "device_id", "timestamp", "ingested_at", "source",
    "temperature", "humidity", "pressure", "region", "model", "lat", "lon",
)


def latest_ingestion(bronze: DataFrame, ties: tuple[str, ...] | None = None) -> DataFrame:
    """Complete rows, one per event_id: the latest ingestion, remaining columns break ties.

    Spark keeps one row per event and task before the shuffle (WindowGroupLimit), so an event
    with very many copies does not pile up in one task.
    """
    complete = bronze.filter(" AND ".join(f"{c} IS NOT NULL" for c in REQUIRED))
    names = ties or [f.name for f in bronze.schema.fields if not isinstance(f.dataType, MapType)]
    last = [F.col(c).desc_nulls_last() for c in names if c not in ("event_id", "ingested_at")]
    newest = Window.partitionBy("event_id").orderBy(F.col("ingested_at").desc_nulls_last(), *last)
    return complete.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def temp_category(t: Column) -> Column:
    return (
        F.when(t.isNull(), "unknown").when(t < 15, "low").when(t < 30, "normal").when(t < 40, "high")
        .otherwise("critical")
    )


def climate_zone(lat: Column, lon: Column) -> Column:
    """Zones by latitude in degrees (fixed values); the first that holds counts."""
    return (
        F.when(lat.isNull() | lon.isNull(), "unknown")
        .when(lat > 60, "arctic")
        .when(lat < -60, "antarctic")
        .when((lat >= 23.5) & (lat <= 66.5), "northern-temperate")
        .when((lat <= -23.5) & (lat >= -66.5), "southern-temperate")
        .otherwise("tropical")
    )


def hemisphere(lat: Column) -> Column:
    """An unknown latitude counts as equatorial."""
    return F.when(lat > 0, "northern").when(lat < 0, "southern").otherwise("equatorial")


def enrich(deduplicated: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    c = F.col
    ts = c("timestamp")
    return deduplicated.select(
        "event_id",
        "device_id",
        "timestamp",
        "ingested_at",
        (millis(c("ingested_at")) - millis(ts)).alias("ingest_latency_ms"),
        "source",
        "temperature",
        "humidity",
        "pressure",
        "region",
        "model",
        F.hour(ts).cast("bigint").alias("hour_of_day"),
        (F.dayofweek(ts) - 1).cast("bigint").alias("day_of_week"),
        F.to_date(ts).alias("event_date"),
        temp_category(c("temperature")).alias("temp_category"),
        climate_zone(c("lat"), c("lon")).alias("climate_zone"),
        hemisphere(c("lat")).alias("hemisphere"),
        (c("temperature") >= 30).alias("is_high_temp"),
        (c("humidity") < 20).alias("is_low_humidity"),
        (c("pressure") < 1000).alias("is_low_pressure"),
        *keep,
    )


def silver(bronze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """`keep` names bronze columns to carry along."""
    return enrich(latest_ingestion(bronze.select(*CARRIED)), keep)


def silver_increment(bronze_batch: DataFrame, recent_silver: DataFrame) -> DataFrame:
    """Silver rows of a new batch, without events that recent silver already holds."""
    return silver(bronze_batch).join(recent_silver.select("event_id"), "event_id", "left_anti")


def silver_by_category(refined: DataFrame) -> DataFrame:
    return refined.groupBy("temp_category", "climate_zone", "hemisphere").agg(F.count("*").alias("n"))


def silver_stats(bronze: DataFrame) -> DataFrame:
    """Rows in and out of a silver run; the total removed also counts the incomplete rows.

    Grouping by event first lets each task collapse copies before the shuffle.
    """
    complete = F.col("event_id").isNotNull() & F.col("device_id").isNotNull() & F.col("timestamp").isNotNull()
    per_event = bronze.groupBy("event_id").agg(
        F.count("*").alias("seen"), F.count_if(complete).alias("complete")
    )
    totals = per_event.agg(
        F.coalesce(F.sum("seen"), F.lit(0)).alias("events_in"),
        F.count_if(F.col("complete") > 0).alias("events_out"),
        F.coalesce(F.sum("complete"), F.lit(0)).alias("complete"),
    )
    c = F.col
    return totals.select(
        "events_in",
        "events_out",
        (c("events_in") - c("complete")).alias("incomplete_removed"),
        (c("complete") - c("events_out")).alias("copies_removed"),
        (c("events_in") - c("events_out")).alias("duplicates_removed"),
    )


def run_summary(stats: DataFrame, processed_files: int, skipped_files: int, duration_ms: float) -> DataFrame:
    """One row per silver run."""
    return stats.select(
        F.lit(processed_files).cast("bigint").alias("processed_files"),
        F.lit(skipped_files).cast("bigint").alias("skipped_files"),
        "events_in",
        "events_out",
        "duplicates_removed",
        F.lit(float(duration_ms)).alias("duration_ms"),
    )

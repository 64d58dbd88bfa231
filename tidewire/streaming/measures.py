"""Counters and histograms of running jobs.

Each trigger adds its counts and duration buckets to a table, under its job's name and batch id, so a repeated trigger
counts once; readers add them up. Counts come from `observe`, on the rows that the trigger writes anyway. The duration
of an event is its trigger's, divided by the number of events. What a file sink has written is what its own log names.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewire.operators import quality
from tidewire.schemas import DOUBLE, STRING, TIMESTAMP, record
from tidewire.sources import tables
from tidewire.sources.snapshots import SnapshotTable, append_and_compact

COMPACT_EVERY = 100
MEASURE = record(at=TIMESTAMP, name=STRING, labels=STRING, le=STRING, value=DOUBLE)
SINK_FILE = "path string, size bigint"


class Trigger:
    """What one trigger counts before it is stored."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.counts, self.observed = spark, {}, []
        self.durations: list[tuple[str, float, int]] = []

    def count(self, name: str, n: int, **labels: str) -> None:
        if n:
            key = (name, ",".join(f"{k}={v}" for k, v in labels.items()))
            self.counts[key] = self.counts.get(key, 0) + int(n)

    def observe(self, rows: DataFrame, name: str, label: str | None = None, by: dict[str, Column] | None = None) -> DataFrame:
        """Counts rows as they are first written; `by` names the values of the label and which rows have them."""
        seen = Observation()
        conditions = by or {"": F.lit(True)}
        self.observed.append((seen, name, label, list(conditions)))
        return rows.observe(seen, *[F.count_if(c).alias(f"n{i}") for i, c in enumerate(conditions.values())])

    def took(self, name: str, seconds: float, observations: int = 1) -> None:
        self.durations.append((name, seconds, observations))

    def rows(self) -> DataFrame:
        for seen, name, label, values in self.observed:
            got = seen.get
            for i, value in enumerate(values):
                # Spark may find a plan empty and leave the observation out.
                self.count(name, got.get(f"n{i}", 0), **({label: value} if label else {}))
        counted = [(name, labels, None, float(n)) for (name, labels), n in self.counts.items()]
        parts = self.spark.createDataFrame(counted, "name string, labels string, le string, value double")
        for name, seconds, n in self.durations:
            one = self.spark.createDataFrame([(float(seconds), n)], "s double, n bigint")
            parts = parts.unionByName(quality.duration_parts(one, name, F.col("s"), F.col("n")))
        return parts


class Measures:
    def __init__(self, path: str, compact_every: int = COMPACT_EVERY) -> None:
        self.table = SnapshotTable(path, MEASURE, "at", ("name", "labels"))
        self.compact_every = compact_every

    def add(self, parts: DataFrame, job: str, batch_id: int) -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
        rows = parts.withColumn("at", F.lit(now).cast("timestamp")).coalesce(1)
        append_and_compact(self.table, rows, job, batch_id, self.compact_every)

    def merged(self, spark: SparkSession) -> DataFrame:
        return quality.merge_measures(self.table.read(spark).select("name", "labels", "le", "value"))

    def counters(self, spark: SparkSession) -> DataFrame:
        """(name, labels, value)"""
        return self.merged(spark).filter("le IS NULL").select("name", "labels", F.col("value").cast("bigint").alias("value"))

    def histograms(self, spark: SparkSession) -> DataFrame:
        """(name, le, value): cumulative counts up to `le`, and the rows sum and count."""
        return self.merged(spark).filter("le IS NOT NULL").select("name", "le", "value")


@contextmanager
def publishing(measures: Measures | None, spark: SparkSession, topic: str):
    """Counts a failed send to a topic; the failure goes on."""
    try:
        yield
    except Exception:
        if measures is not None:
            trigger = Trigger(spark)
            trigger.count("kafka_producer_errors_total", 1, topic=topic)
            measures.add(trigger.rows(), f"errors-{time.time_ns()}", 0)
        raise


def measured(
    measures: Measures, job: str, process: Callable[[DataFrame, int, Trigger], None]
) -> Callable[[DataFrame, int], None]:
    """A trigger's processing that counts into a `Trigger`, which is stored when all its rows are."""

    def each(rows: DataFrame, batch_id: int) -> None:
        trigger = Trigger(rows.sparkSession)
        process(rows, batch_id, trigger)
        measures.add(trigger.rows(), job, batch_id)

    return each


def sink_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, size) of the files that a file sink has committed, which its log names; contents are not read."""
    if not tables.exists(spark, path):
        return spark.createDataFrame([], SINK_FILE)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", F.col("length").alias("size"))


def archive_counters(spark: SparkSession, path: str, zone: str = "telemetry") -> DataFrame:
    files = sink_files(spark, path)
    return quality.counters(
        quality.counter(files, "archive_files_written_total", zone=F.lit(zone)),
        quality.counter(files, "archive_bytes_written_total", F.col("size")),
    )


def silver_measures(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counters and the duration histogram of silver, from its run summaries."""
    names = {"silver_files_processed_total": "processed_files", "silver_events_in_total": "events_in",
             "silver_events_out_total": "events_out", "silver_duplicates_removed_total": "duplicates_removed"}
    counted = quality.counters(*[quality.counter(runs, name, F.col(c)) for name, c in names.items()])
    return counted, quality.duration_parts(runs, "silver_transform_duration_seconds", F.col("duration_ms") / 1000)

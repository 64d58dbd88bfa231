"""Rollups that are current while the stream runs and take late rows.

A trigger adds partial sums, counts and extremes of its own rows per minute and device, and rewrites nothing; partial
rows add up in any order, so late rows need no earlier ones. What a trigger may still change is the reach of the
minute's refresh policy, three hours before the log's clock; older rows don't enter. As no minute beyond that changes,
neither does any five minutes or hour made from it within their own, longer reach.

    open/version=<n>   partial rows of trigger n
    open/base=<n>      merged partial rows of all triggers before n, without closed days
    folds/version=<n>  the first day that was not closed at base n
    closed/<interval>  finished rollups of closed days, by day
    runs/version=<n>   clock, rows and late rows of trigger n

Every `compact_every` triggers the open rows are folded into a base, and days wholly out of reach are finished and
closed. Each step can be repeated: a trigger overwrites its own version, and the files that a base is made from stay
until the next one. Readers go by the newest complete base, so they see a day either open or closed.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tidewire.functions.times import at
from tidewire.operators import rollup
from tidewire.schemas import DATE, TELEMETRY, extended
from tidewire.sources import tables

COMPACT_EVERY = 100
INTERVALS = ("1m", "5m", "1h")
RUN = "clock timestamp, rows bigint, late bigint"


def partial_schema(spark: SparkSession) -> StructType:
    return rollup.minute_partials(spark.createDataFrame([], TELEMETRY)).schema


def clock_before(spark: SparkSession, path: str, batch_id: int) -> datetime | None:
    """The newest arrival of all earlier triggers."""
    earlier = [n for n in tables.numbered(spark, f"{path}/runs", "version") if n < batch_id]
    if not earlier:
        return None
    run = spark.read.schema(RUN).parquet(f"{path}/runs/version={earlier[-1]}")
    return run.select(F.col("clock").cast("timestamp_ntz")).first()[0]


def add_trigger(telemetry: DataFrame, path: str, batch_id: int, arrival: str, compact_every: int = COMPACT_EVERY) -> None:
    """Adds one trigger's telemetry rows to the rollups below `path`."""
    spark = telemetry.sparkSession
    before = clock_before(spark, path, batch_id)
    telemetry = telemetry.withColumn("time", F.col("time").cast("timestamp")).persist()
    try:
        newest = telemetry.agg(F.max(F.col(arrival).cast("timestamp_ntz"))).first()[0]
        clock = max((t for t in (before, newest) if t is not None), default=None)
        if clock is None:
            return
        first, _ = rollup.POLICIES["1m"].window(clock)
        in_reach = F.col("time") >= at(first)
        fresh = rollup.minute_partials(telemetry.filter(in_reach))
        fresh.write.mode("overwrite").parquet(f"{path}/open/version={batch_id}")
        counted = telemetry.agg(
            F.lit(clock).cast("timestamp").alias("clock"), F.count("*").alias("rows"), F.count_if(~in_reach).alias("late")
        )
        counted.write.mode("overwrite").parquet(f"{path}/runs/version={batch_id}")
    finally:
        telemetry.unpersist()
    if batch_id and batch_id % compact_every == 0:
        fold(spark, path, batch_id, first.date())


def open_partials(spark: SparkSession, path: str, before: int | None = None) -> tuple[DataFrame, date | None]:
    """Merged partial rows of open days, and the first open day (None: no day is closed)."""
    bases, versions = (
        [n for n in tables.numbered(spark, f"{path}/open", kind) if before is None or n < before] for kind in ("base", "version")
    )
    parts = [f"{path}/open/base={n}" for n in bases[-1:]]
    parts += [f"{path}/open/version={n}" for n in versions if not bases or n >= bases[-1]]
    schema = partial_schema(spark)
    rows = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
    closed = spark.read.parquet(f"{path}/folds/version={bases[-1]}").first()["first_open"] if bases else None
    return rollup.merge_partials(rows), closed


def fold(spark: SparkSession, path: str, batch_id: int, first_open: date) -> None:
    """Merges the triggers before this one into a base, and finishes the days before `first_open`."""
    held, _ = open_partials(spark, path, before=batch_id)
    closing = F.to_date("bucket") < F.lit(first_open)
    minutes = rollup.from_partials(held.filter(closing))
    for interval in INTERVALS:
        done = minutes if interval == "1m" else rollup.rollup_from_1m(minutes, interval)
        tables.write_rollup(done, f"{path}/closed/{interval}")
    bases = [n for n in tables.numbered(spark, f"{path}/open", "base") if n < batch_id]
    spark.createDataFrame([(first_open,)], "first_open date").coalesce(1).write.mode("overwrite").parquet(f"{path}/folds/version={batch_id}")
    held.filter(~closing).write.mode("overwrite").parquet(f"{path}/open/base={batch_id}")
    if bases:
        # What the last base was made from; what this one was made from stays for a repeated trigger.
        for kind, numbers in (("base", bases[:-1]), ("version", tables.numbered(spark, f"{path}/open", "version"))):
            for n in (n for n in numbers if n < bases[-1]):
                tables.remove(spark, f"{path}/open/{kind}={n}")


def read_rollups(spark: SparkSession, path: str, interval: str) -> DataFrame:
    """The rollup as of the last trigger, the running bucket included; `event_date` lets readers skip closed days."""
    held, first_open = open_partials(spark, path)
    minutes = rollup.from_partials(held)
    current = minutes if interval == "1m" else rollup.rollup_from_1m(minutes, interval)
    current = current.withColumn("event_date", F.to_date("bucket"))
    if first_open is None or not tables.exists(spark, f"{path}/closed/{interval}"):
        return current
    closed = spark.read.schema(extended(current.drop("event_date").schema, event_date=DATE)).parquet(f"{path}/closed/{interval}")
    return closed.filter(F.col("event_date") < F.lit(first_open)).unionByName(current)


def rollup_batch(path: str, arrival: str = "ingested_at", compact_every: int = COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    def process(telemetry: DataFrame, batch_id: int) -> None:
        add_trigger(telemetry, path, batch_id, arrival, compact_every)

    return process


def live_rollup_job(
    telemetry: DataFrame, path: str, arrival: str = "ingested_at", compact_every: int = COMPACT_EVERY
) -> DataStreamWriter:
    """Keeps the rollups of a stream of telemetry rows below `path`."""
    return telemetry.writeStream.foreachBatch(rollup_batch(path, arrival, compact_every))

"""Tumbling rollups: 1 minute from telemetry, 5 minutes and 1 hour from the 1-minute rollup."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.maps import entry
from tidewire.functions.times import at, instant
from tidewire.operators.flatten import METRICS


@dataclass(frozen=True)
class RefreshPolicy:
    """Buckets that lie wholly inside [as_of - start_offset, as_of - end_offset] are recomputed."""

    width: timedelta
    start_offset: timedelta
    end_offset: timedelta

    def window(self, as_of: datetime | str) -> tuple[datetime, datetime]:
        epoch = datetime(1970, 1, 1)
        now = instant(as_of)

        def floor(t: datetime) -> datetime:
            return epoch + self.width * ((t - epoch) // self.width)

        start = now - self.start_offset
        first = floor(start)
        return (first if first == start else first + self.width), floor(now - self.end_offset)


# Refresh windows (fixed values).
POLICIES = {
    "1m": RefreshPolicy(timedelta(minutes=1), timedelta(hours=3), timedelta(minutes=1)),
    "5m": RefreshPolicy(timedelta(minutes=5), timedelta(days=1), timedelta(minutes=5)),
    "1h": RefreshPolicy(timedelta(hours=1), timedelta(days=7), timedelta(hours=1)),
}

WIDTHS = {"1m": "1 minute", "5m": "5 minutes", "1h": "1 hour"}


def one_row_per_event(telemetry: DataFrame) -> DataFrame:
    """Telemetry without redelivered events (the plain rollup keeps them)."""
    return telemetry.dropDuplicates(["event_id"])


def rollup_1m(telemetry: DataFrame, sums: bool = False, event_time: bool = False) -> DataFrame:
    """Per (minute, device). `sums` adds the sums and counts that weighted rollups need.

    `event_time` adds the column a stream must use to roll the result up further.
    """
    readings = telemetry.select("time", "device_id", *[entry("metrics", m).alias(m) for m in METRICS])
    aggregates = []
    for m in METRICS:
        aggregates.append(F.avg(m).alias(f"avg_{m}"))
        if m != "pressure":
            aggregates += [F.min(m).alias(f"min_{m}"), F.max(m).alias(f"max_{m}")]
        if sums:
            aggregates += [F.sum(m).alias(f"sum_{m}"), F.count(m).alias(f"n_{m}")]
    grouped = readings.groupBy(F.window("time", WIDTHS["1m"]).alias("_w"), "device_id").agg(
        *aggregates, F.count("*").alias("sample_count")
    )
    times = [F.col("_w.start").alias("bucket")]
    if event_time:
        times.append(F.window_time("_w").alias("bucket_time"))
    return grouped.select(*times, *[c for c in grouped.columns if c != "_w"])


def minute_partials(telemetry: DataFrame) -> DataFrame:
    """Per (minute, device) what `merge_partials` can add up: sums, counts, extremes."""
    rolled = rollup_1m(telemetry, sums=True)
    return rolled.drop(*[f"avg_{m}" for m in METRICS])


def merge_partials(partials: DataFrame) -> DataFrame:
    """One row per (minute, device) from any number of partial ones."""

    def merged(c: str) -> Column:
        over = F.min if c.startswith("min_") else F.max if c.startswith("max_") else F.sum
        return over(c).alias(c)

    measures = [c for c in partials.columns if c not in ("bucket", "device_id")]
    return partials.groupBy("bucket", "device_id").agg(*map(merged, measures))


def from_partials(partials: DataFrame) -> DataFrame:
    """The minute rollup of merged partial rows."""
    averages = {f"avg_{m}": F.try_divide(F.col(f"sum_{m}"), F.col(f"n_{m}")) for m in METRICS}
    rolled = partials.withColumns(averages)
    columns = [c for m in METRICS for c in (f"avg_{m}", f"min_{m}", f"max_{m}") if c in rolled.columns]
    return rolled.select("bucket", "device_id", *columns, "sample_count")


def rollup_from_1m(one_minute: DataFrame, interval: str, time_col: str = "bucket") -> DataFrame:
    """Averages of minute averages (each minute counts the same), extremes and counts."""
    grouped = one_minute.groupBy(F.window(time_col, WIDTHS[interval]).alias("_w"), "device_id").agg(
        F.avg("avg_temperature").alias("avg_temperature"),
        F.min("min_temperature").alias("min_temperature"),
        F.max("max_temperature").alias("max_temperature"),
        F.avg("avg_humidity").alias("avg_humidity"),
        F.avg("avg_pressure").alias("avg_pressure"),
        F.sum("sample_count").alias("sample_count"),
    )
    return grouped.select(F.col("_w.start").alias("bucket"), *[c for c in grouped.columns if c != "_w"])


def with_open_end(closed: DataFrame, telemetry: DataFrame, interval: str = "1m") -> DataFrame:
    """Stored buckets and, computed now, the later ones that the stream has not closed yet."""
    last = closed.agg(F.max(F.col("bucket").cast("timestamp_ntz"))).first()[0]
    open_end = telemetry
    if last is not None:
        open_end = telemetry.filter(F.col("time") >= at(last + POLICIES[interval].width))
    minutes = rollup_1m(open_end)
    return closed.unionByName(minutes if interval == "1m" else rollup_from_1m(minutes, interval))


def weighted_from_1m(one_minute: DataFrame, interval: str) -> DataFrame:
    """True averages over the samples; needs a 1-minute rollup built with `sums=True`."""
    grouped = one_minute.groupBy(F.window("bucket", WIDTHS[interval]).alias("_w"), "device_id").agg(
        *[F.try_divide(F.sum(f"sum_{m}"), F.sum(f"n_{m}")).alias(f"avg_{m}") for m in METRICS],
        F.min("min_temperature").alias("min_temperature"),
        F.max("max_temperature").alias("max_temperature"),
        F.sum("sample_count").alias("sample_count"),
    )
    return grouped.select(F.col("_w.start").alias("bucket"), *[c for c in grouped.columns if c != "_w"])


def refresh_range(frame: DataFrame, time_col: str, interval: str, as_of: datetime | str) -> DataFrame:
    """Input rows of the buckets a refresh recomputes; the range reaches the scan as a filter."""
    start, end = POLICIES[interval].window(as_of)
    return frame.filter((F.col(time_col) >= at(start)) & (F.col(time_col) < at(end)))


def rollup_refresh(telemetry: DataFrame, as_of: datetime | str) -> DataFrame:
    """The 1-minute buckets one refresh run recomputes."""
    return rollup_1m(refresh_range(telemetry, "time", "1m", as_of))


def retention_start(as_of: datetime | str, days: int = 30) -> date:
    """First day retention keeps: a one-day chunk goes as a whole, once all of it is too old."""
    return (instant(as_of) - timedelta(days=days)).date()


def retention_keep(telemetry: DataFrame, as_of: datetime | str, days: int = 30) -> DataFrame:
    cutoff = retention_start(as_of, days)
    kept = telemetry.filter(F.col("time") >= at(cutoff.isoformat()))
    if "event_date" in telemetry.columns:
        kept = kept.filter(F.col("event_date") >= F.lit(cutoff))
    return kept

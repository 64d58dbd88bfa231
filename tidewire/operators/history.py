"""History queries over raw telemetry and its rollups."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.maps import entry
from tidewire.functions.times import at, instant
from tidewire.operators.flatten import METRICS

DEFAULT_LIMIT = 1000
MAX_LIMIT = 10_000
DEFAULT_RANGE = timedelta(hours=1)
INTERVALS = ("raw", "1m", "5m", "1h")


def history_range(
    now: datetime | str, start: datetime | str | None = None, end: datetime | str | None = None
) -> tuple[datetime, datetime]:
    """Closed range; it ends now and starts one hour before now, whatever the given end."""
    now = instant(now)
    return (
        now - DEFAULT_RANGE if start is None else instant(start),
        now if end is None else instant(end),
    )


def history_limit(limit: int | str | None) -> int:
    """Leading integer of the request value; none or 0 means 1000, at most 10000."""
    found = re.match(r"\s*([+-]?\d+)", "" if limit is None else str(limit))
    n = int(found.group(1)) if found else 0
    if n < 0:
        raise ValueError(f"limit must not be negative: {limit}")
    return min(n or DEFAULT_LIMIT, MAX_LIMIT)


def _in_range(frame: DataFrame, time_col: str, device_id: str, start: datetime, end: datetime) -> DataFrame:
    rows = frame.filter(
        (F.col("device_id") == device_id) & (F.col(time_col) >= at(start)) & (F.col(time_col) <= at(end))
    )
    if "event_date" in frame.columns:
        # A range on the time column does not prune date partitions by itself.
        rows = rows.filter(F.col("event_date").between(F.lit(start.date()), F.lit(end.date())))
    return rows


def history_raw(telemetry: DataFrame, device_id: str, start: datetime, end: datetime, limit=None) -> DataFrame:
    return (
        _in_range(telemetry, "time", device_id, start, end)
        .select("time", *[entry("metrics", m).alias(m) for m in METRICS], "event_id")
        .orderBy("time", "event_id")
        .limit(history_limit(limit))
        .drop("event_id")
    )


def history_rollup(rollup: DataFrame, device_id: str, start: datetime, end: datetime, limit=None) -> DataFrame:
    return (
        _in_range(rollup, "bucket", device_id, start, end)
        .select(
            F.col("bucket").alias("time"),
            *[F.col(f"avg_{m}").alias(m) for m in METRICS],
            "sample_count",
        )
        .orderBy("time")
        .limit(history_limit(limit))
    )


def history(
    relations: dict[str, DataFrame],
    device_id: str,
    now: datetime | str,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    interval: str = "raw",
    limit: int | str | None = None,
) -> DataFrame:
    """`relations` maps raw, 1m, 5m, 1h to the telemetry table and its rollups."""
    if interval not in INTERVALS:
        raise ValueError(f"unknown interval {interval!r}")
    first, last = history_range(now, start, end)
    query = history_raw if interval == "raw" else history_rollup
    return query(relations[interval], device_id, first, last, limit)


def history_envelope(rows: DataFrame, device_id: str, interval: str, start: datetime, end: datetime) -> DataFrame:
    """One row around a history result, which holds at most 10000 rows."""
    return rows.agg(
        F.count("*").alias("count"),
        F.array_sort(F.collect_list(F.struct(*rows.columns))).alias("data"),
    ).select(
        F.lit(device_id).alias("device_id"),
        F.lit(interval).alias("interval"),
        at(start).cast("timestamp_ntz").alias("from"),
        at(end).cast("timestamp_ntz").alias("to"),
        "count",
        "data",
    )

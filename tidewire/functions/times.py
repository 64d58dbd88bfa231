"""Time arithmetic that gives the same result for TIMESTAMP and TIMESTAMP_NTZ columns (UTC session)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def instant(value: datetime | str) -> datetime:
    """A UTC instant as a naive datetime; ValueError when the text is not a date."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def at(value: datetime | str) -> Column:
    """Literal that compares with either timestamp type and still reaches the scan as a filter."""
    return F.lit(instant(value).isoformat(sep=" "))


def iso(ts: Column) -> Column:
    """2024-01-01T00:00:00.000Z"""
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")

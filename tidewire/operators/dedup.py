"""Idempotency of the realtime path: the first arrival of an event id wins."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewire.operators.spacing import keep_spaced

PROCESSED_TTL_SECONDS = 86_400


def realtime_dedup(
    events: DataFrame, arrival: str = "ingested_at", ttl_seconds: float = PROCESSED_TTL_SECONDS
) -> DataFrame:
    """Drops an event id accepted less than 24 h before; the mark is not renewed by copies."""
    return keep_spaced(events, ["event_id"], arrival, ttl_seconds, ties=["device_id", "source"])

"""Latest device state and the views over it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.times import at, instant
from tidewire.operators.flatten import metrics_long
from tidewire.schemas import LATEST_STATE, TIMESTAMP, extended

STATE_TTL = timedelta(hours=1)
STATE_COLUMNS = tuple(LATEST_STATE.fieldNames())
ARRIVED_STATE = extended(LATEST_STATE, arrived_at=TIMESTAMP)


def alive(frame: DataFrame, as_of: datetime | str, arrival: str = "ingested_at", ttl: timedelta = STATE_TTL) -> DataFrame:
    """Rows that arrived within the TTL before `as_of`; the range reaches the scan as a filter."""
    now = instant(as_of)
    return frame.filter((F.col(arrival) > at(now - ttl)) & (F.col(arrival) <= at(now)))


def newest_per_device(
    events: DataFrame, by: str = "arrival", arrival: str = "ingested_at", carried: tuple[str, ...] = STATE_COLUMNS
) -> DataFrame:
    """The last processed event per device, or the newest by event time (`by="event_time"`)."""
    if by not in ("arrival", "event_time"):
        raise ValueError(f"by must be 'arrival' or 'event_time', not {by!r}")
    order = F.struct(arrival if by == "arrival" else "timestamp", "event_id")
    fields = [c for c in carried if c != "device_id"]
    return (
        events.groupBy("device_id")
        .agg(F.max_by(F.struct(*fields), order).alias("_s"))
        .select("device_id", *[F.col(f"_s.{c}").alias(c) for c in fields])
    )


def latest_state(
    events: DataFrame, as_of: datetime | str, by: str = "arrival", arrival: str = "ingested_at", ttl: timedelta = STATE_TTL
) -> DataFrame:
    """State per device; a device without an event for one TTL has none.

    The last event decides whether the state is alive, so older arrivals are not read at all.
    """
    return newest_per_device(alive(events, as_of, arrival, ttl), by, arrival)


def devices_list(state: DataFrame) -> DataFrame:
    return state.select("device_id", "timestamp", "ingested_at", "metrics", "tags", "source")


def devices_count(state: DataFrame) -> DataFrame:
    return state.agg(F.count("*").alias("n"))


def device_get(state: DataFrame, device_id: str) -> DataFrame:
    """State of one device; an empty result means not found."""
    return devices_list(state.filter(F.col("device_id") == device_id))


def device_board(events: DataFrame, arrival: str = "ingested_at") -> DataFrame:
    """Merged view per device: newest value of each metric, newest tags of an event that has any.

    Metrics and tags are reduced apart, so that an event's tags are not copied to each of its metrics.
    """
    order = F.struct(arrival, "event_id")
    latest = events.groupBy("device_id").agg(
        F.max_by("tags", F.when(F.col("tags").isNotNull(), order)).alias("tags"),
        F.max_by("timestamp", order).alias("timestamp"),
    )
    per_metric = (
        metrics_long(events, "device_id", arrival, "event_id")
        .groupBy("device_id", "metric")
        .agg(F.max_by("value", order).alias("value"))
    )
    merged = per_metric.groupBy("device_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("_metrics")
    )
    none = F.create_map().cast("map<string,double>")
    return latest.join(merged, "device_id", "left").select(
        "device_id", "tags", "timestamp", F.coalesce("_metrics", none).alias("metrics")
    )


BOARD_PART = "device_id string, item string, at timestamp, event_id string, value double, timestamp timestamp, tags map<string,string>"
TIME_ITEM, TAGS_ITEM, METRIC_ITEM = "time", "tags", "metric:"


def board_parts(events: DataFrame, arrival: str = "ingested_at") -> DataFrame:
    """What events say of each device: its time, its tags, each of its metrics, with when they were said.

    Parts of any number of triggers give the board by `merge_board_parts` and `board_of`.
    """
    said = events.select(
        "device_id", F.col(arrival).cast("timestamp").alias("at"), "event_id", F.col("timestamp").cast("timestamp").alias("timestamp"), "tags"
    )
    none = {"value": F.lit(None).cast("double"), "timestamp": F.lit(None).cast("timestamp"), "tags": F.lit(None).cast("map<string,string>")}
    times = said.withColumns({**none, "timestamp": F.col("timestamp"), "item": F.lit(TIME_ITEM)})
    tags = said.filter("tags IS NOT NULL").withColumns({**none, "tags": F.col("tags"), "item": F.lit(TAGS_ITEM)})
    values = metrics_long(events, "device_id", "event_id", F.col(arrival).cast("timestamp").alias("at")).withColumns(
        {"timestamp": none["timestamp"], "tags": none["tags"], "item": F.concat(F.lit(METRIC_ITEM), F.col("metric"))}
    )
    columns = ["device_id", "item", "at", "event_id", "value", "timestamp", "tags"]
    return merge_board_parts(times.select(*columns).unionByName(tags.select(*columns)).unionByName(values.select(*columns)))


def merge_board_parts(parts: DataFrame) -> DataFrame:
    """The newest part of each device and item."""
    fields = ("at", "event_id", "value", "timestamp", "tags")
    newest = parts.groupBy("device_id", "item").agg(F.max_by(F.struct(*fields), F.struct("at", "event_id")).alias("_s"))
    return newest.select("device_id", "item", *[F.col(f"_s.{c}").alias(c) for c in fields])


def board_of(merged: DataFrame) -> DataFrame:
    """The board of merged parts, as `device_board` has it."""
    item, name = F.col("item"), F.substring("item", F.lit(len(METRIC_ITEM) + 1), F.length("item"))
    is_metric = item.startswith(METRIC_ITEM)
    # An item is there once, so any of its rows is it.
    return merged.groupBy("device_id").agg(
        F.first(F.when(item == TAGS_ITEM, F.col("tags")), ignorenulls=True).alias("tags"),
        F.first(F.when(item == TIME_ITEM, F.col("timestamp")), ignorenulls=True).alias("timestamp"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(is_metric, F.struct(name.alias("metric"), "value"))))).alias("metrics"),
    )


def board_order(board: DataFrame) -> DataFrame:
    return board.orderBy(F.col("device_id").asc_nulls_last())


def device_registry(events: DataFrame) -> DataFrame:
    """First and last time a device was seen, with its newest known model and region."""
    order = F.struct("timestamp", "event_id")

    def newest(tag: str):
        value = F.try_element_at("tags", F.lit(tag))
        return F.max_by(value, F.when(value.isNotNull(), order)).alias(tag)

    return events.groupBy("device_id").agg(
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
        newest("model"),
        newest("region"),
    ).select("device_id", F.col("device_id").alias("name"), "model", "region", "first_seen", "last_seen")


def active_devices(events: DataFrame, as_of: datetime | str, arrival: str = "ingested_at") -> DataFrame:
    """Devices heard of within the TTL."""
    return alive(events, as_of, arrival).select("device_id").distinct().agg(F.count("device_id").alias("n"))

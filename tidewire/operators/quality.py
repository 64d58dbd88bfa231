"""Counters, histograms, consumer lag, rate limits and the processed-files manifest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.asof import as_of
from tidewire.operators.spacing import keep_spaced
from tidewire.session import cut_lineage

# Histogram bounds in seconds (fixed values).
INGEST_LATENCY = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5)
DURATIONS = {
    "processor_event_duration_seconds": (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5),
    "batch_flush_duration_seconds": (0.0001, 0.0005, 0.001, 0.005, 0.01),
    "archive_flush_duration_seconds": (0.1, 0.5, 1, 2, 5, 10),
    "silver_transform_duration_seconds": (0.5, 1, 2, 5, 10, 30, 60),
}

RATE_LIMIT = 1000
RATE_WINDOW_SECONDS = 60
SILVER_BATCH_FILES = 50
MANIFEST_KEYS = 10_000


def counter(rows: DataFrame, name: str, weight: Column | None = None, **labels: Column) -> DataFrame:
    """(name, labels, value) with labels as `k=v,...`."""
    text = F.concat_ws(",", *[F.concat(F.lit(f"{k}="), v) for k, v in labels.items()])
    value = F.count("*") if weight is None else F.sum(weight)
    return (
        rows.groupBy(text.alias("labels"))
        .agg(value.cast("bigint").alias("value"))
        .select(F.lit(name).alias("name"), "labels", "value")
    )


def counters(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def histogram(rows: DataFrame, value: Column, bounds: tuple[float, ...], by: list[str]) -> DataFrame:
    """Cumulative buckets per group, one pass over the rows; the last bucket is +Inf."""
    v = value.cast("double")
    buckets = [F.count_if(v <= float(b)).alias(f"_b{i}") for i, b in enumerate(bounds)]
    totals = rows.groupBy(*by).agg(*buckets, F.count(v).alias("count"), F.sum(v).alias("sum"))
    entries = [F.struct(F.lit(str(b)).alias("le"), F.col(f"_b{i}").alias("n")) for i, b in enumerate(bounds)]
    entries.append(F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("n")))
    return totals.select(*by, "sum", "count", F.inline(F.array(*entries)))


def duration_parts(rows: DataFrame, name: str, seconds: Column, weight: Column | None = None) -> DataFrame:
    """A histogram of `DURATIONS` as rows (name, labels, le, value) that add up over any number of parts.

    `weight` is the number of observations that a row stands for. The sum and the count are rows with `le` sum and count.
    """
    s, w = seconds.cast("double"), (F.lit(1) if weight is None else weight).cast("double")
    w = F.when(s.isNotNull(), w)
    bounds = [(str(b), F.sum(F.when(s <= float(b), w))) for b in DURATIONS[name]]
    columns = [*bounds, ("+Inf", F.sum(w)), ("count", F.sum(w)), ("sum", F.sum(s * w))]
    totals = rows.agg(*[v.alias(f"_{i}") for i, (_, v) in enumerate(columns)])
    parts = F.array(*[F.struct(F.lit(le).alias("le"), F.coalesce(F.col(f"_{i}"), F.lit(0.0)).alias("value")) for i, (le, _) in enumerate(columns)])
    return totals.select(F.lit(name).alias("name"), F.lit("").alias("labels"), F.inline(parts))


def merge_measures(parts: DataFrame) -> DataFrame:
    """One row per counter, or bound of a histogram, from the parts of any number of triggers."""
    return parts.groupBy("name", "labels", "le").agg(F.sum("value").alias("value"))


def consumer_lag(committed: DataFrame, latest: DataFrame) -> DataFrame:
    """Messages each group is behind per partition; an unknown end or a group without commit counts as 0."""
    end = F.coalesce(F.col("latest"), F.lit(0))
    done = F.greatest(F.lit(0), F.col("committed"))
    return committed.join(latest, ["topic", "partition"], "left").select(
        "group", "topic", "partition", F.greatest(F.lit(0), end - done).cast("bigint").alias("lag")
    )


def rate_limit_audit(
    requests: DataFrame, key: str, time: str, limit: int = RATE_LIMIT, seconds: int = RATE_WINDOW_SECONDS
) -> DataFrame:
    """Requests per key and window, and how many of them exceed the limit.

    A key's window starts with its first request after the last window has ended. Requests without a key or time are
    not counted. Only distinct times of a key travel, so a flood at one instant is one row a task.
    """
    counted = requests.select(F.col(key).alias("key"), F.col(time).alias("at")).dropna()
    counted = cut_lineage(counted.groupBy("key", "at").agg(F.count("*").alias("n")), "requests")
    starts = keep_spaced(counted.select("key", "at"), ["key"], "at", seconds, ties=[]).select("key", F.col("at").alias("window_start"))
    starts = cut_lineage(starts.withColumn("from", F.col("window_start")), "windows")
    placed = as_of(counted, starts, ["key"], "at", "from", ["window_start"], salt_by=["at"])
    return _rejected(placed.groupBy("key", "window_start").agg(F.sum("n").alias("requests")), limit)


def rate_limit_by_clock(
    requests: DataFrame, key: str, time: str, limit: int = RATE_LIMIT, seconds: int = RATE_WINDOW_SECONDS
) -> DataFrame:
    """The same for windows that all start at the epoch, in one aggregation."""
    counted = requests.groupBy(F.window(time, f"{seconds} seconds").alias("_w"), F.col(key).alias("key")).agg(
        F.count("*").alias("requests")
    )
    return _rejected(counted.withColumn("window_start", F.col("_w.start")), limit)


def _rejected(counted: DataFrame, limit: int) -> DataFrame:
    over = F.greatest(F.lit(0), F.col("requests") - limit).cast("bigint")
    return counted.select("key", "window_start", "requests", over.alias("rejected"))


def client_key(api_key: Column, address: Column) -> Column:
    """Rate limits count by API key, else by client address."""
    return F.coalesce(F.nullif(F.trim(api_key), F.lit("")), address)


def pending_files(listing: DataFrame, manifest: DataFrame, n: int = SILVER_BATCH_FILES) -> DataFrame:
    """The first `n` Parquet files, by path, that no earlier run has processed."""
    return (
        listing.filter(F.col("path").endswith(".parquet"))
        .join(manifest.select("path"), "path", "left_anti")
        .orderBy("path")
        .limit(n)
    )


def manifest_compact(manifest: DataFrame, n: int = MANIFEST_KEYS) -> DataFrame:
    """The newest `n` entries."""
    return manifest.orderBy(F.col("processed_at").desc_nulls_last(), F.col("path").desc()).limit(n)

"""Rolling z-score over the last 100 samples of each (device, metric)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.times import micros
from tidewire.operators.flatten import metrics_long
from tidewire.operators.joins import fits
from tidewire.session import cut_lineage

# Verdict parameters (fixed values).
WINDOW_SIZE = 100
MIN_SAMPLES = 20
Z_THRESHOLD = 3.0

# A series of more rows than this is cut into blocks.
SERIES_ROWS = 2_000_000
BLOCK_ROWS = 500_000
BIN_MICROS = 1_000_000
PARTS_PER_BLOCK = 4
MAX_PARTS = 10_000

SERIES = ("device_id", "metric")
ORDER = ("ts", "event_id")


def samples(events: DataFrame, arrival: str = "ingested_at") -> DataFrame:
    return metrics_long(events, "device_id", "event_id", F.col(arrival).alias("ts"))


def anomaly_zscore(
    readings: DataFrame,
    series_rows: int = SERIES_ROWS,
    block_rows: int = BLOCK_ROWS,
    bin_micros: int = BIN_MICROS,
) -> DataFrame:
    """Scores every sample against the 100 latest ones, itself included.

    Fewer than 20 samples give no verdict (NULL); a constant window is never anomalous. One task
    holds at most about `series_rows` rows: longer series are cut into blocks that carry the 99
    samples before them.
    """
    series = list(SERIES)
    sizes = readings.groupBy(*series).agg(F.count("*").alias("_n"))
    long_series = sizes.filter(F.col("_n") > series_rows).select(*series)
    if long_series.isEmpty():
        return _verdict(_rolling(readings, series)).select(*readings.columns, *_SCORES)
    long_series = cut_lineage(long_series)
    marked = F.broadcast(long_series) if fits(long_series) else long_series
    short = _rolling(readings.join(marked, series, "left_anti"), series)
    blocks = _with_blocks(readings.join(marked, series, "left_semi"), block_rows, bin_micros)
    long = _rolling(blocks, [*series, "_block"]).filter(~F.col("_context"))
    scored = short.unionByName(long.drop("_block", "_context"))
    return _verdict(scored).select(*readings.columns, *_SCORES)


_SCORES = ("n_samples", "mean", "std_dev", "z_score", "is_anomaly")


def _rolling(readings: DataFrame, partition: list[str]) -> DataFrame:
    in_order = Window.partitionBy(*partition).orderBy(*ORDER)
    latest = in_order.rowsBetween(1 - WINDOW_SIZE, 0)
    return readings.withColumns(
        {
            "n_samples": F.least(F.row_number().over(in_order), F.lit(WINDOW_SIZE)).cast("bigint"),
            "mean": F.avg("value").over(latest),
            "std_dev": F.stddev_pop("value").over(latest),
        }
    )


def _verdict(rolled: DataFrame) -> DataFrame:
    c = F.col
    judged = c("n_samples") >= MIN_SAMPLES
    z = F.when(c("std_dev") == 0, 0.0).otherwise(F.try_divide(F.abs(c("value") - c("mean")), c("std_dev")))
    return (
        rolled.withColumn("z_score", F.when(judged, z))
        .withColumn("is_anomaly", c("z_score") > Z_THRESHOLD)
    )


def _with_blocks(readings: DataFrame, block_rows: int, bin_micros: int) -> DataFrame:
    """Copies each row into its block, and as context into the blocks that start within 99 samples.

    Samples are counted per small time bin; blocks consist of whole bins. The bins that reach into
    the last 99 samples before a block are its context, which may hold a few samples more than needed.
    """
    series = list(SERIES)
    reach = WINDOW_SIZE - 1
    place = ["_bin", "_part"]
    in_time = Window.partitionBy(*series).orderBy(*place)
    binned = _with_bins(readings, block_rows, bin_micros)
    bins = (
        binned.groupBy(*series, *place)
        .agg(F.count("*").alias("_n"))
        .withColumn("_end", F.sum("_n").over(in_time.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_before", F.col("_end") - F.col("_n"))
        .withColumn("_block", F.floor(F.col("_before") / block_rows))
        .withColumn("_previous", F.lag("_block").over(in_time))
    )
    opens = F.when(
        F.col("_previous") < F.col("_block"), F.struct(F.col("_block").alias("block"), F.col("_before").alias("start"))
    )
    # Every bin holds a sample, so a block that starts more than 99 bins later is out of reach.
    ahead = F.collect_list(opens).over(in_time.rowsBetween(1, reach))
    near = F.filter(ahead, lambda b: b["start"] - F.col("_end") < reach)
    targets = bins.withColumn("_near", near).select(
        *series,
        *place,
        F.concat(
            F.array(F.struct(F.col("_block").alias("_block"), F.lit(False).alias("_context"))),
            F.transform("_near", lambda b: F.struct(b["block"].alias("_block"), F.lit(True).alias("_context"))),
        ).alias("_targets"),
    )
    return (
        binned.join(targets, [*series, *place])
        .select(*readings.columns, F.inline("_targets"))
    )


def _with_bins(readings: DataFrame, block_rows: int, bin_micros: int) -> DataFrame:
    """Adds the time bin, and the part of a bin that alone holds more rows than a block.

    Such bins, of a bulk load stamped once, are cut into ranges of the order within them. The
    ranges are written, as they come from a sample and both counts and rows need the same ones.
    """
    series = list(SERIES)
    binned = readings.withColumn("_bin", F.floor(micros(F.col("ts")) / bin_micros))
    counts = binned.groupBy(*series, "_bin").agg(F.count("*").alias("_n"))
    crowded = cut_lineage(counts.filter(F.col("_n") > block_rows), "crowded")
    rows = crowded.agg(F.sum("_n")).first()[0]
    if rows is None:
        return binned.withColumn("_part", F.lit(0))
    marked = crowded.drop("_n")
    marked = F.broadcast(marked) if fits(marked) else marked
    parts = min(MAX_PARTS, -(-rows * PARTS_PER_BLOCK // block_rows))
    ranged = (
        binned.join(marked, [*series, "_bin"], "left_semi")
        .repartitionByRange(parts, *series, *ORDER)
        .withColumn("_part", F.spark_partition_id())
    )
    rest = binned.join(marked, [*series, "_bin"], "left_anti").withColumn("_part", F.lit(0))
    return rest.unionByName(cut_lineage(ranged, "parts"))


def recent_samples(readings: DataFrame, n: int = WINDOW_SIZE) -> DataFrame:
    """The newest `n` samples per series."""
    newest = Window.partitionBy(*SERIES).orderBy(F.col("ts").desc(), F.col("event_id").desc())
    return readings.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n).drop("_rn")

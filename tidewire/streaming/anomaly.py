"""Rolling z-score as a stateful stream."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructType, TimestampType

from tidewire.operators.anomaly import MIN_SAMPLES, WINDOW_SIZE, Z_THRESHOLD

# Python workers get the processor's code with the query and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCORED = (
    StructType()
    .add("device_id", StringType())
    .add("metric", StringType())
    .add("event_id", StringType())
    .add("ts", TimestampType())
    .add("value", DoubleType())
    .add("n_samples", LongType())
    .add("mean", DoubleType())
    .add("std_dev", DoubleType())
    .add("z_score", DoubleType())
    .add("is_anomaly", BooleanType())
)


CHUNK = 10_000


def rolling_moments(series: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size, mean and deviation of the window that ends at each sample from `start` on."""
    ends = np.arange(start, len(series))
    size = np.minimum(ends + 1, WINDOW_SIZE)
    mean, deviation = np.empty(len(ends)), np.empty(len(ends))
    growing = int(np.count_nonzero(ends + 1 < WINDOW_SIZE))
    for i, end in enumerate(ends[:growing]):
        mean[i], deviation[i] = series[: end + 1].mean(), series[: end + 1].std()
    if growing < len(ends):
        windows = sliding_window_view(series, WINDOW_SIZE)[ends[growing] + 1 - WINDOW_SIZE :]
        for i in range(0, len(windows), CHUNK):
            part = windows[i : i + CHUNK]
            at = slice(growing + i, growing + i + len(part))
            mean[at], deviation[at] = part.mean(axis=1), part.std(axis=1)
    return size, mean, deviation


class RollingScore(StatefulProcessor):
    """Keeps the last samples of one (device, metric); the rows of a trigger are scored in arrival order.

    The trigger size (maxOffsetsPerTrigger, maxFilesPerTrigger) bounds the rows of one key at a time.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._recent = handle.getValueState("recent", "samples array<double>")

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "event_id", "value"], ignore_index=True)
        held = list(self._recent.get()[0]) if self._recent.exists() else []
        value = batch["value"].to_numpy(dtype=float)
        series = np.concatenate([np.array(held, dtype=float), value])
        size, mean, deviation = rolling_moments(series, len(held))
        with np.errstate(divide="ignore", invalid="ignore"):
            z = np.where(deviation == 0, 0.0, np.abs((value - mean) / deviation))
        judged = pd.Series(size >= MIN_SAMPLES)
        self._recent.update((series[-WINDOW_SIZE:].tolist(),))
        yield pd.DataFrame(
            {
                "device_id": key[0], "metric": key[1], "event_id": batch["event_id"], "ts": batch["ts"],
                "value": value, "n_samples": size, "mean": mean, "std_dev": deviation,
                "z_score": pd.array(z, dtype="Float64"),
                "is_anomaly": pd.array(z > Z_THRESHOLD, dtype="boolean"),
            }
        ).assign(
            z_score=lambda d: d["z_score"].where(judged), is_anomaly=lambda d: d["is_anomaly"].where(judged)
        )

    def close(self) -> None:
        pass


def anomaly_stream(readings: DataFrame) -> DataFrame:
    """Scores of a stream of (device_id, metric, event_id, ts, value); needs the RocksDB state store."""
    rows = readings.withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.groupBy("device_id", "metric").transformWithStateInPandas(
        statefulProcessor=RollingScore(),
        outputStructType=SCORED,
        outputMode="append",
        timeMode="none",
    )

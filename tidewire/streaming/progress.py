"""Gauges of running streams, from query progress."""

from __future__ import annotations

import json
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidewire.schemas import BIGINT, INT, STRING, record

OFFSETS = record(topic=STRING, partition=INT, value=BIGINT)


def _flat(offsets: dict | str | None) -> list[tuple[str, int, int]]:
    held = json.loads(offsets) if isinstance(offsets, str) else offsets or {}
    return [(t, int(p), int(o)) for t, ps in held.items() if isinstance(ps, dict) for p, o in ps.items()]


def offset_frames(spark: SparkSession, group: str, progress: dict) -> tuple[DataFrame, DataFrame]:
    """Committed and latest offsets of a Kafka query's last progress, as inputs of `consumer_lag`."""
    committed, latest = [], []
    for source in progress.get("sources", []):
        committed += _flat(source.get("endOffset"))
        latest += _flat(source.get("latestOffset"))
    done = spark.createDataFrame(committed, OFFSETS).withColumnRenamed("value", "committed")
    end = spark.createDataFrame(latest, OFFSETS).withColumnRenamed("value", "latest")
    return done.selectExpr(f"'{group}' AS group", "*"), end


def gauges(query: StreamingQuery) -> dict[str, float]:
    last = query.lastProgress
    if not last:
        return {}
    operators = last["stateOperators"] or []
    return {
        "input_rows": float(last["numInputRows"]),
        "rows_per_second": float(last["processedRowsPerSecond"] or 0.0),
        "state_rows": float(sum(o["numRowsTotal"] for o in operators)),
    }


class ProgressLog(StreamingQueryListener):
    """Holds (query name, batch id, input rows) of the newest triggers."""

    def __init__(self, triggers: int = 10_000) -> None:
        self.rows: deque[tuple[str | None, int, int]] = deque(maxlen=triggers)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows.append((p.name, p.batchId, p.numInputRows))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

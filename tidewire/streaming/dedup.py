"""Idempotency and alert cooldown of the realtime stream: keyed marks, so that no event is late."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import TimestampType

from tidewire.operators.dedup import PROCESSED_TTL_SECONDS

# Python workers get the processor's code with the query and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FirstArrival(StatefulProcessor):
    """Holds when a row of the key was last accepted.

    Another one passes once it arrives a TTL after that. Of one trigger's rows of a key, one per
    arrival time is held in memory.
    """

    def __init__(self, arrival: str, ttl_seconds: int, ties: tuple[str, ...]) -> None:
        self._arrival, self._ttl, self._ties = arrival, ttl_seconds, ties

    def init(self, handle: StatefulProcessorHandle) -> None:
        # The store forgets by the wall clock; a day at least, so that slow triggers lose no short mark.
        held = max(self._ttl, PROCESSED_TTL_SECONDS)
        self._mark = handle.getValueState("mark", "at bigint", held * 1000)

    def handleInputRows(self, key, rows, timer_values) -> Iterator[Row]:
        def rank(row: Row) -> tuple:
            return tuple((row[c] is not None, row[c]) for c in self._ties)

        by_time: dict[int, Row] = {}
        for row in rows:
            held = by_time.get(row[self._arrival])
            if held is None or rank(row) < rank(held):
                by_time[row[self._arrival]] = row
        held = self._mark.get()
        mark = before = None if held is None else held[0]
        for at in sorted(by_time):
            if mark is None or at >= mark + self._ttl * 1_000_000:
                mark = at
                yield by_time[at]
        if mark != before:
            self._mark.update((mark,))

    def close(self) -> None:
        pass


def first_arrivals(
    events: DataFrame,
    ttl_seconds: int,
    arrival: str = "arrived_at",
    ties: tuple[str, ...] = ("device_id", "source"),
    keys: tuple[str, ...] = ("event_id",),
) -> DataFrame:
    """Stream counterpart of `keep_spaced`: equal to it while each key's rows come in order of arrival.

    Needs the RocksDB state store. Times pass Python as microseconds and so keep their exact value.
    """
    times = [f.name for f in events.schema.fields if isinstance(f.dataType, TimestampType)]
    rows = events.withColumns({c: F.unix_micros(c) for c in times})
    kept = rows.groupBy(*keys).transformWithState(
        statefulProcessor=FirstArrival(arrival, ttl_seconds, ties),
        outputStructType=rows.schema,
        outputMode="append",
        timeMode="processingTime",
    )
    return kept.withColumns({c: F.timestamp_micros(c) for c in times})

"""The device board as a stream: of each device the newest value of each metric, its tags and its time.

A trigger writes what is newest among its own events; arrivals decide, so triggers may come in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tidewire.operators import state
from tidewire.streaming.merged import COMPACT_EVERY, MergedTable


def board_table(path: str, compact_every: int = COMPACT_EVERY) -> MergedTable:
    return MergedTable(path, state.BOARD_PART, state.merge_board_parts, compact_every)


def board_job(events: DataFrame, table: MergedTable, arrival: str = "arrived_at") -> DataStreamWriter:
    def process(batch: DataFrame, batch_id: int) -> None:
        table.add(state.board_parts(batch, arrival), batch_id)

    return events.writeStream.foreachBatch(process)


def read_board(spark: SparkSession, table: MergedTable) -> DataFrame:
    return state.board_of(table.read(spark))

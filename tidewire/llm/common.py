"""What the operators share: the tables, word boundaries, Arrow batches, digests."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# A word is a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

ROWS_PER_BATCH = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(frame: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of the frame has it (in any case)."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def in_batches(
    frame: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType, start: Callable | None = None
) -> DataFrame:
    """`mapInArrow` in slices of a few rows, as texts can be long; Spark bounds its batches by bytes.

    `start`, if given, makes per task the state that `work` gets as a second argument.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extra = (start(),) if start else ()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_BATCH):
                out = work(batch.slice(at, ROWS_PER_BATCH), *extra)
                if out is not None:
                    yield out

    return frame.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; a null text is empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()

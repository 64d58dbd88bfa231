"""Tables by day that are written by streams and compacted while they are read.

    data/part=<name>/event_date=<day>   rows of one trigger, or of one compaction, of one day
    snapshots/<n>.json                  the folders that make up the table, and each writer's last trigger

A change writes its folders first and then a new snapshot, by a rename that fails if the number is taken; who fails
reads the newer snapshot and tries again. Readers take the newest snapshot and list its folders only, so they see all
of a change or nothing, and a compaction may run beside the stream. A trigger that a writer's snapshot already has is
not written again, even after its rows were compacted. `vacuum` deletes what no kept snapshot names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tidewire.schemas import DATE, STRING, extended
from tidewire.sources import tables

MOST_PARTS = 8
KEEP_SNAPSHOTS = 10
FILE_ROWS = 5_000_000
ATTEMPTS = 20


@dataclass
class Snapshot:
    number: int = -1
    # (part, day) of every folder.
    folders: list[tuple[str, str]] = field(default_factory=list)
    writers: dict[str, int] = field(default_factory=dict)


class SnapshotTable:
    """Rows with the columns of `schema`, by the day of the timestamp `at`; compacted files are ordered by `order`."""

    def __init__(self, path: str, schema: StructType, at: str, order: tuple[str, ...], file_rows: int = FILE_ROWS) -> None:
        self.path, self.schema, self.at, self.order, self.file_rows = path.rstrip("/"), schema, at, list(order), file_rows

    # --- snapshots ------------------------------------------------------------------------------

    def _numbers(self, spark: SparkSession) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in tables.names(spark, f"{self.path}/snapshots") if n.endswith(".json"))

    def _load(self, spark: SparkSession, number: int) -> Snapshot:
        held = json.loads(tables.read_text(spark, f"{self.path}/snapshots/{number}.json"))
        return Snapshot(number, [tuple(f) for f in held["folders"]], held["writers"])

    def newest(self, spark: SparkSession) -> Snapshot:
        numbers = self._numbers(spark)
        return self._load(spark, numbers[-1]) if numbers else Snapshot()

    def _commit(self, spark: SparkSession, change: Callable[[Snapshot], Snapshot | None]) -> Snapshot:
        """Applies a change to the newest snapshot, again if another one came first."""
        for _ in range(ATTEMPTS):
            last = self.newest(spark)
            new = change(last)
            if new is None:
                return last
            body = json.dumps({"folders": new.folders, "writers": new.writers})
            if tables.write_new(spark, f"{self.path}/snapshots/{last.number + 1}.json", body):
                return Snapshot(last.number + 1, new.folders, new.writers)
        raise RuntimeError(f"{self.path}: no snapshot could be written in {ATTEMPTS} attempts")

    # --- changes --------------------------------------------------------------------------------

    def _write(self, rows: DataFrame, part: str) -> list[tuple[str, str]]:
        """Writes one part and names its folders. Rows in the order of `event_date` keep what order they have within it."""
        target = f"{self.path}/data/part={part}"
        rows.write.mode("overwrite").partitionBy("event_date").option("maxRecordsPerFile", self.file_rows).parquet(target)
        found = tables.names(rows.sparkSession, target)
        return [(part, n.removeprefix("event_date=")) for n in sorted(found) if n.startswith("event_date=")]

    def append(self, rows: DataFrame, writer: str, batch_id: int) -> bool:
        """Adds one trigger's rows, once; tells whether they were read."""
        spark = rows.sparkSession
        if self.newest(spark).writers.get(writer, -1) >= batch_id:
            return False
        dated = rows.select(*self.schema.fieldNames()).withColumn("event_date", F.to_date(self.at))
        added = self._write(dated, f"{writer}-{batch_id}")

        def add(last: Snapshot) -> Snapshot | None:
            if last.writers.get(writer, -1) >= batch_id:
                return None
            return Snapshot(folders=[*last.folders, *added], writers=last.writers | {writer: batch_id})

        self._commit(spark, add)
        return True

    def compact(self, spark: SparkSession, most_parts: int = MOST_PARTS) -> list[str]:
        """Rewrites the days that lie in more than `most_parts` parts, ordered, and names them."""
        parts: dict[str, list[str]] = {}
        for part, day in self.newest(spark).folders:
            parts.setdefault(day, []).append(part)
        crowded = {day: p for day, p in parts.items() if len(p) > most_parts}
        if not crowded:
            return []
        replaced = {(p, day) for day, ps in crowded.items() for p in ps}
        rows = self._read(spark, sorted(replaced))
        ordered = rows.repartitionByRange("event_date", *self.order).sortWithinPartitions("event_date", *self.order)
        added = self._write(ordered, f"compact-{uuid.uuid4().hex}")

        def swap(last: Snapshot) -> Snapshot | None:
            # Another compaction may have replaced some of the folders.
            if not replaced <= set(last.folders):
                return None
            return Snapshot(folders=[f for f in last.folders if f not in replaced] + added, writers=last.writers)

        self._commit(spark, swap)
        return sorted(crowded)

    def vacuum(self, spark: SparkSession, keep: int = KEEP_SNAPSHOTS) -> None:
        """Deletes old snapshots, and folders that only they name; a part younger than the newest snapshot stays."""
        numbers = self._numbers(spark)
        old, kept = numbers[:-keep], [self._load(spark, n) for n in numbers[-keep:]]
        named = {f for s in kept for f in s.folders}
        for gone in {f for n in old for f in self._load(spark, n).folders} - named:
            tables.remove(spark, f"{self.path}/data/part={gone[0]}/event_date={gone[1]}")
        for n in old:
            tables.remove(spark, f"{self.path}/snapshots/{n}.json")

    # --- reading --------------------------------------------------------------------------------

    def _read(self, spark: SparkSession, folders: list[tuple[str, str]]) -> DataFrame:
        schema = extended(self.schema, part=STRING, event_date=DATE)
        if not folders:
            return spark.createDataFrame([], schema).drop("part")
        paths = [f"{self.path}/data/part={part}/event_date={day}" for part, day in folders]
        return spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths).drop("part")

    def read(self, spark: SparkSession, first: str | None = None, last: str | None = None) -> DataFrame:
        """The newest snapshot, with `event_date`; only folders of the days asked for (both included) are listed."""
        days = [f for f in self.newest(spark).folders if (first is None or f[1] >= first) and (last is None or f[1] <= last)]
        return self._read(spark, days)


def append_and_compact(table: SnapshotTable, rows: DataFrame, writer: str, batch_id: int, compact_every: int) -> bool:
    """Adds a trigger's rows, and compacts the table every so many triggers; tells whether the rows were read."""
    added = table.append(rows, writer, batch_id)
    if batch_id % compact_every == compact_every - 1:
        table.compact(rows.sparkSession)
        table.vacuum(rows.sparkSession)
    return added


def snapshot_job(rows: DataFrame, table: SnapshotTable, writer: str, compact_every: int = 100) -> DataStreamWriter:
    """Appends a stream to the table, and compacts it between triggers."""

    def process(batch: DataFrame, batch_id: int) -> None:
        append_and_compact(table, batch, writer, batch_id, compact_every)

    return rows.writeStream.foreachBatch(process)

"""Idempotency of a stream by a table of marks: which keys were accepted, and when.

A trigger drops rows whose key has a mark less than the TTL before them, and applies the batch operator to the others,
all in JVM joins. What it accepts is written once, and is itself the newest part of the marks:

    accepted/batch_id=<n>               accepted rows of trigger n, also a table for streams behind this one
    marks/fold=<n>/hour=<h>             marks of all triggers between two folds, by hour of arrival, in the order of `bucket`
    folds/version=<n>                   when fold n was made and the newest mark in it

A trigger reads the hours that can still block one of its rows, and of their files the row groups of the buckets, hashes of
the key, that its rows fall into. Every
`fold_every` triggers the accepted rows since the last fold become marks. A fold goes, folder and all, once both the
wall clock and the log's clock have passed its marks by the TTL, so neither a lagging log partition nor a stream that
stood still loses a mark. A repeated trigger finds its accepted rows and writes nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tidewire.functions.times import micros
from tidewire.operators.dedup import PROCESSED_TTL_SECONDS
from tidewire.operators.spacing import keep_spaced
from tidewire.schemas import BIGINT, INT, extended, record
from tidewire.session import cut_lineage
from tidewire.sources import tables

BUCKETS = 64
FOLD_EVERY = 100
FOLD = "written double, newest bigint"


class Marks:
    """The marks below `path` of rows that are accepted once per `keys` and TTL; keys are not null."""

    def __init__(
        self,
        path: str,
        schema: StructType,
        keys: tuple[str, ...] = ("event_id",),
        arrival: str = "arrived_at",
        ttl_seconds: int = PROCESSED_TTL_SECONDS,
        ties: tuple[str, ...] = ("device_id", "source"),
        fold_every: int = FOLD_EVERY,
        clock: Callable[[], float] = time.time,
    ) -> None:
        self.path, self.schema, self.keys, self.arrival, self.ties = path, schema, list(keys), arrival, list(ties)
        self.ttl, self.fold_every, self.clock = ttl_seconds, fold_every, clock

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("int")

    def _as_marks(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.keys, micros(F.col(self.arrival)).alias("mark"))

    def accepted(self, spark: SparkSession, batch_ids: list[int]) -> DataFrame:
        paths = [f"{self.path}/accepted/batch_id={n}" for n in batch_ids]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def known(self, spark: SparkSession, batch_id: int, low: int, buckets: list[int]) -> DataFrame | None:
        """Marks after `low` of the given buckets, set before this trigger; none before the first."""
        folds = [n for n in tables.numbered(spark, f"{self.path}/folds", "version") if n <= batch_id]
        since = folds[-1] if folds else 0
        recent = [n for n in tables.numbered(spark, f"{self.path}/accepted", "batch_id") if since <= n < batch_id]
        found = self._as_marks(self.accepted(spark, recent))
        stored = [p for n in folds if tables.exists(spark, p := f"{self.path}/marks/fold={n}")]
        if not recent and not stored:
            return None
        if stored:
            kinds = {f.name: f.dataType for f in self.schema.fields}
            schema = record(**{k: kinds[k] for k in self.keys}, mark=BIGINT, bucket=INT)
            old = spark.read.schema(extended(schema, fold=BIGINT, hour=BIGINT)).option("basePath", f"{self.path}/marks").parquet(*stored)
            hours = F.col("hour") >= low // 3_600_000_000
            found = found.unionByName(old.filter(hours & F.col("bucket").isin(buckets)).drop("fold", "hour", "bucket"))
        return found.filter(F.col("mark") > low)

    def accept(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """The rows of this trigger that no mark blocks, read from where they are stored."""
        spark = rows.sparkSession
        if not tables.exists(spark, f"{self.path}/accepted/batch_id={batch_id}/_SUCCESS"):
            self._store(rows.select(*self.schema.fieldNames()), batch_id)
        if batch_id and batch_id % self.fold_every == 0 and not tables.exists(spark, f"{self.path}/folds/version={batch_id}/_SUCCESS"):
            self._fold(spark, batch_id)
        return self.accepted(spark, [batch_id])

    def _store(self, rows: DataFrame, batch_id: int) -> None:
        spark, gap = rows.sparkSession, self.ttl * 1_000_000
        target = f"{self.path}/accepted/batch_id={batch_id}"
        rows = rows.persist()
        try:
            at = micros(F.col(self.arrival))
            low, buckets = rows.agg(F.min(at), F.collect_set(self._bucket())).first()
            if low is None:
                return rows.write.mode("overwrite").parquet(target)
            known = self.known(spark, batch_id, low - gap, sorted(buckets))
            free = rows
            if known is not None:
                # Both sides are known in size when they meet, so Spark broadcasts the smaller one if it is small.
                asked = known.join(rows.select(*self.keys).distinct(), self.keys, "left_semi")
                blocks = cut_lineage(asked.groupBy(*self.keys).agg(F.max("mark").alias("mark")), "blocks")
                held = rows.join(blocks, self.keys, "left")
                free = held.filter(F.col("mark").isNull() | (at >= F.col("mark") + gap)).drop("mark")
            keep_spaced(free, self.keys, self.arrival, self.ttl, self.ties).write.mode("overwrite").parquet(target)
        finally:
            rows.unpersist()
        return None

    def _fold(self, spark: SparkSession, batch_id: int) -> None:
        folds = tables.numbered(spark, f"{self.path}/folds", "version")
        since = max((n for n in folds if n < batch_id), default=0)
        batches = [n for n in tables.numbered(spark, f"{self.path}/accepted", "batch_id") if since <= n < batch_id]
        marks = self._as_marks(self.accepted(spark, batches)).groupBy(*self.keys).agg(F.max("mark").alias("mark"))
        marks = marks.withColumns({"bucket": self._bucket(), "hour": F.floor(F.col("mark") / 3_600_000_000)})
        target = f"{self.path}/marks/fold={batch_id}"
        marks.repartition("bucket").sortWithinPartitions("hour", "bucket").write.mode("overwrite").partitionBy("hour").parquet(target)
        newest = spark.read.schema(marks.schema).parquet(target).agg(F.max("mark")).first()[0] or 0
        made = [(n, *spark.read.schema(FOLD).parquet(f"{self.path}/folds/version={n}").first()) for n in folds if n < batch_id]
        now, gap = float(self.clock()), self.ttl * 1_000_000
        log_clock = max([newest, *[m for _, _, m in made]])
        spark.createDataFrame([(now, newest)], FOLD).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/folds/version={batch_id}")
        for n, written, last in made:
            if written + self.ttl <= now and last + gap <= log_clock:
                tables.remove(spark, f"{self.path}/marks/fold={n}")


def accepted_stream(spark: SparkSession, marks: Marks) -> DataFrame:
    """What the job in front accepts, as a stream for others."""
    tables.make_folder(spark, f"{marks.path}/accepted")
    return spark.readStream.schema(marks.schema).option("recursiveFileLookup", "true").parquet(f"{marks.path}/accepted")


def idempotent(marks: Marks, process: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A trigger's processing, applied to the rows that are accepted."""

    def each(rows: DataFrame, batch_id: int) -> None:
        process(marks.accept(rows, batch_id), batch_id)

    return each


def accepted_job(valid: DataFrame, marks: Marks) -> DataStreamWriter:
    """Stores what is accepted and nothing else."""
    return valid.writeStream.foreachBatch(idempotent(marks, lambda rows, batch_id: None))

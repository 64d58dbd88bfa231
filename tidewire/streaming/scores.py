"""Rolling z-score of a stream, by the batch operator over each trigger's samples and the ones before them.

The last 99 samples of each series, its tail, stand in a table:

    tails/version=<n>   tails of the series that trigger n had samples of
    tails/base=<n>      the newest tail of every series before trigger n
    scores/batch_id=<n> scored samples of trigger n

A trigger reads the tails of its own series and puts them before its samples. The batch operator cuts long series into
blocks with the samples before them as context, so a series with most of a trigger's samples spreads over tasks, and
nothing passes Python. Samples are scored in the order of `ts` and `event_id`; one that comes in a later trigger than
samples after it is scored in its place among the tail. A repeated trigger finds what it has written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidewire.operators.anomaly import ORDER, SERIES, WINDOW_SIZE, anomaly_zscore, recent_samples
from tidewire.operators.joins import fits
from tidewire.session import cut_lineage
from tidewire.sources import tables

COMPACT_EVERY = 100
TAIL = "device_id string, metric string, version bigint, samples array<struct<ts timestamp, event_id string, value double>>"
SAMPLE = ["device_id", "metric", "event_id", "ts", "value"]
SCORED = (
    "device_id string, metric string, event_id string, ts timestamp, value double, n_samples bigint, mean double, "
    "std_dev double, z_score double, is_anomaly boolean"
)


class Tails:
    """The tails and scores below `path`; `blocks` are passed on to the batch operator."""

    def __init__(self, path: str, compact_every: int = COMPACT_EVERY, **blocks: int) -> None:
        self.path, self.compact_every, self.blocks = path, compact_every, blocks

    def newest(self, spark: SparkSession, before: int) -> DataFrame:
        """The tail of each series as of the trigger before."""
        bases, versions = ([n for n in tables.numbered(spark, f"{self.path}/tails", k) if n < before] for k in ("base", "version"))
        parts = [f"{self.path}/tails/base={n}" for n in bases[-1:]]
        parts += [f"{self.path}/tails/version={n}" for n in versions if not bases or n >= bases[-1]]
        rows = spark.read.schema(TAIL).parquet(*parts) if parts else spark.createDataFrame([], TAIL)
        return rows.groupBy(*SERIES).agg(F.max("version").alias("version"), F.max_by("samples", "version").alias("samples"))

    def score(self, samples: DataFrame, batch_id: int) -> DataFrame:
        """The trigger's samples with their scores, read from where they are stored."""
        spark, target = samples.sparkSession, f"{self.path}/scores/batch_id={batch_id}"
        if not tables.exists(spark, f"{self.path}/tails/version={batch_id}/_SUCCESS"):
            fresh = samples.select(*SAMPLE).withColumns({"ts": F.col("ts").cast("timestamp"), "_old": F.lit(False)}).persist()
            try:
                self._store(fresh, batch_id, target)
            finally:
                fresh.unpersist()
        if batch_id and batch_id % self.compact_every == 0 and not tables.exists(spark, f"{self.path}/tails/base={batch_id}/_SUCCESS"):
            self._compact(spark, batch_id)
        return spark.read.schema(SCORED).parquet(target)

    def _store(self, fresh: DataFrame, batch_id: int, target: str) -> None:
        touched = fresh.select(*SERIES).distinct()
        touched = F.broadcast(touched) if fits(touched) else touched
        held = self.newest(fresh.sparkSession, batch_id).join(touched, list(SERIES), "left_semi")
        held = held.select(*SERIES, F.inline("samples")).withColumn("_old", F.lit(True))
        both = cut_lineage(fresh.unionByName(held), "samples")
        scored = anomaly_zscore(both, **self.blocks).filter("NOT _old").drop("_old")
        scored.write.mode("overwrite").parquet(target)
        tails = recent_samples(both, WINDOW_SIZE - 1).groupBy(*SERIES).agg(
            F.sort_array(F.collect_list(F.struct(*ORDER, "value"))).alias("samples")
        )
        tails = tails.select(*SERIES, F.lit(batch_id).cast("bigint").alias("version"), "samples")
        tails.write.mode("overwrite").parquet(f"{self.path}/tails/version={batch_id}")

    def _compact(self, spark: SparkSession, batch_id: int) -> None:
        bases = [n for n in tables.numbered(spark, f"{self.path}/tails", "base") if n < batch_id]
        self.newest(spark, batch_id).write.mode("overwrite").parquet(f"{self.path}/tails/base={batch_id}")
        if bases:
            for kind, numbers in (("base", bases[:-1]), ("version", tables.numbered(spark, f"{self.path}/tails", "version"))):
                for n in (n for n in numbers if n < bases[-1]):
                    tables.remove(spark, f"{self.path}/tails/{kind}={n}")


def scored(tails: Tails, process: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    def each(samples: DataFrame, batch_id: int) -> None:
        process(tails.score(samples, batch_id), batch_id)

    return each


def score_job(samples: DataFrame, tails: Tails) -> DataStreamWriter:
    """Stores the scores and nothing else."""
    return samples.writeStream.foreachBatch(scored(tails, lambda rows, batch_id: None))

"""Tables of parts that add up: what each trigger adds, folded now and then.

    version=<n>   the parts of trigger n
    base=<n>      the merged parts of all triggers before n

Both can be written again, as the files that a base is made from stay until the next base.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewire.sources import tables

COMPACT_EVERY = 100


class MergedTable:
    """Parts of `schema` below `path`; `merge` gives the parts of any number of triggers as one part."""

    def __init__(self, path: str, schema: str, merge: Callable[[DataFrame], DataFrame], compact_every: int = COMPACT_EVERY) -> None:
        self.path, self.schema, self.merge, self.compact_every = path, schema, merge, compact_every

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        bases, versions = (
            [n for n in tables.numbered(spark, self.path, kind) if before is None or n < before] for kind in ("base", "version")
        )
        parts = [f"{self.path}/base={n}" for n in bases[-1:]]
        parts += [f"{self.path}/version={n}" for n in versions if not bases or n >= bases[-1]]
        rows = spark.read.schema(self.schema).parquet(*parts) if parts else spark.createDataFrame([], self.schema)
        return self.merge(rows)

    def add(self, parts: DataFrame, batch_id: int) -> None:
        spark = parts.sparkSession
        parts.write.mode("overwrite").parquet(f"{self.path}/version={batch_id}")
        if batch_id == 0 or batch_id % self.compact_every:
            return
        bases = [n for n in tables.numbered(spark, self.path, "base") if n < batch_id]
        self.read(spark, before=batch_id).write.mode("overwrite").parquet(f"{self.path}/base={batch_id}")
        if bases:
            for kind, numbers in (("base", bases[:-1]), ("version", tables.numbered(spark, self.path, "version"))):
                for n in (n for n in numbers if n < bases[-1]):
                    tables.remove(spark, f"{self.path}/{kind}={n}")

"""Which bronze files were processed: a ledger that a run reads only at its head.

    head.json                           the last run, the first open hour, and the files done in open hours
    entries/date=<day>/run=<n>.parquet  (path, run, rows) of every run, for audits

Bronze files lie below the hour of their flush, so an hour that lies before the newest one and whose files are all done
stays done. A run lists only open hours and reads only the head; neither grows with the number of runs.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.schemas import BRONZE_PARTITIONS
from tidewire.sources import tables

BATCH_FILES = 50
ENTRY = "path string, run bigint, rows bigint"


@dataclass
class Head:
    run: int = -1
    # Folder of the first open hour, such as year=2024/month=01/day=31/hour=07; empty: all hours are open.
    first_open: str = ""
    done: list[str] = field(default_factory=list)
    n_done: int = 0


class Ledger:
    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def head(self, spark: SparkSession) -> Head:
        path = f"{self.path}/head.json"
        return Head(**json.loads(tables.read_text(spark, path))) if tables.exists(spark, path) else Head()

    def open_hours(self, spark: SparkSession, root: str, first: str) -> list[str]:
        """Folders of hours from `first` on, ascending; folders of days before it are not entered."""
        bounds = first.split("/") if first else []
        found = [""]
        for level, name in enumerate(BRONZE_PARTITIONS):
            bound = "/".join(bounds[: level + 1])
            below = []
            for parent in found:
                for n in tables.names(spark, f"{root}/{parent}" if parent else root):
                    path = f"{parent}/{n}" if parent else n
                    if n.startswith(f"{name}=") and path >= bound:
                        below.append(path)
            found = below
        return sorted(found)

    def pending(self, spark: SparkSession, root: str, n: int = BATCH_FILES) -> tuple[list[str], list[str]]:
        """The first `n` files below `root` that no run has processed, by path, and all open files."""
        head = self.head(spark)
        hours = self.open_hours(spark, root, head.first_open)
        files = [f"{h}/{f}" for h in hours for f in sorted(tables.names(spark, f"{root}/{h}")) if f.endswith(".parquet")]
        done = set(head.done)
        return [f for f in files if f not in done][:n], files

    def commit(self, spark: SparkSession, run: int, taken: list[str], files: list[str], rows: DataFrame | None = None) -> None:
        """Closes a run: its entry first, then the head. `rows` has (path, rows); a run that is closed stays as it is."""
        head = self.head(spark)
        if run <= head.run:
            return
        if rows is not None:
            entry = rows.select("path", F.lit(run).cast("bigint").alias("run"), F.col("rows").cast("bigint").alias("rows"))
            entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/entries/date={date.today().isoformat()}/run={run}.parquet")
        done = set(head.done) | set(taken)
        left = [f for f in files if f not in done]
        hours = sorted({f.rsplit("/", 1)[0] for f in files})
        newest = hours[-1] if hours else head.first_open
        first = min([newest, *[f.rsplit("/", 1)[0] for f in left]])
        kept = sorted(f for f in done if f.rsplit("/", 1)[0] >= first)
        body = json.dumps({"run": run, "first_open": first, "done": kept, "n_done": head.n_done + len(taken)})
        tables.replace_text(spark, f"{self.path}/head.json", body)

    def entries(self, spark: SparkSession) -> DataFrame:
        folder = f"{self.path}/entries"
        if not tables.exists(spark, folder):
            return spark.createDataFrame([], ENTRY)
        return spark.read.schema(ENTRY).option("recursiveFileLookup", "true").parquet(folder)

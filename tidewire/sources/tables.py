"""Parquet tables: telemetry by day, bronze by hour, silver, rollups and device state."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewire.functions.times import at
from tidewire.operators.flatten import with_hive_partitions
from tidewire.operators.rollup import POLICIES, refresh_range, retention_start, rollup_1m, rollup_from_1m
from tidewire.operators.silver import CARRIED, latest_ingestion
from tidewire.schemas import BRONZE, BRONZE_PARTITIONS, DATE, INT, STRING, TELEMETRY, extended

WRITE_ROWS = 5_000_000
# Stored beside silver so that ties between copies fall as in the batch operator.
SILVER_TIES = ("lat", "lon")
SILVER_ROW_GROUP_BYTES = 32 * 1024 * 1024


def read_table(spark: SparkSession, *paths: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def describe_table(frame: DataFrame) -> DataFrame:
    """Column names and types, read from the schema alone."""
    spark = frame.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(frame.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, column_type string, nullable boolean")


def with_event_date(telemetry: DataFrame) -> DataFrame:
    return telemetry.withColumn("event_date", F.to_date("time"))


def write_telemetry(telemetry: DataFrame, path: str, mode: str = "append") -> None:
    """Day partitions; within a file rows are ordered by device and time, so row groups can be skipped.

    Range partitioning puts each day into its own files and splits large days and devices.
    """
    rows = with_event_date(telemetry)
    (
        rows.repartitionByRange("event_date", "device_id", "time")
        .sortWithinPartitions("event_date", "device_id", "time")
        .write.mode(mode)
        .option("maxRecordsPerFile", WRITE_ROWS)
        .partitionBy("event_date")
        .parquet(path)
    )


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(extended(TELEMETRY, event_date=DATE)).parquet(path)


def drop_expired_partitions(spark: SparkSession, path: str, as_of: datetime | str, days: int = 30) -> list[str]:
    """Deletes the day partitions retention no longer keeps; the rest is not rewritten."""
    first_kept = f"event_date={retention_start(as_of, days)}"
    root, fs = _file_system(spark, path)
    chunks = [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]
    expired = [c for c in chunks if c.getName().startswith("event_date=") and c.getName() < first_kept]
    for chunk in expired:
        fs.delete(chunk, True)
    return sorted(c.getName() for c in expired)


def _file_system(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    root, fs = _file_system(spark, path)
    return fs.exists(root)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    root, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def read_text(spark: SparkSession, path: str) -> str:
    root, fs = _file_system(spark, path)
    stream = fs.open(root)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file as a whole unless there is one of that name; tells whether it did."""
    target, fs = _file_system(spark, path)
    return not fs.exists(target) and _write_whole(spark, path, text, replace=False)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a file as a whole; readers see the old one or the new one."""
    _write_whole(spark, path, text, replace=True)


def _write_whole(spark: SparkSession, path: str, text: str, replace: bool) -> bool:
    """By a rename, which FileContext, unlike FileSystem, can be told not to replace by."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, fs = _file_system(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(draft, False)
    stream.write(text.encode())
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, int(replace))
    if replace:
        options[0] = rename.OVERWRITE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, options)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if replace or not fs.exists(target):
            raise RuntimeError(f"cannot write {path}") from error
        return False
    return True


def make_folder(spark: SparkSession, path: str) -> None:
    root, fs = _file_system(spark, path)
    fs.mkdirs(root)


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the complete `prefix=<n>` directories below `path`, ascending."""
    if not exists(spark, path):
        return []
    root, fs = _file_system(spark, path)
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{prefix}=") and exists(spark, f"{path}/{name}/_SUCCESS"):
            found.append(int(name.split("=", 1)[1]))
    return sorted(found)


def remove(spark: SparkSession, path: str) -> None:
    root, fs = _file_system(spark, path)
    fs.delete(root, True)


def write_bronze(bronze: DataFrame, path: str, flushed_at: Column, mode: str = "append") -> None:
    """Hourly Hive layout of the flush time, Snappy."""
    rows = with_hive_partitions(bronze, flushed_at)
    (
        rows.write.mode(mode)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", WRITE_ROWS)
        .partitionBy(*BRONZE_PARTITIONS)
        .parquet(path)
    )


def bronze_schema() -> StructType:
    return extended(BRONZE, **dict.fromkeys(BRONZE_PARTITIONS, STRING))


def read_bronze(spark: SparkSession, *paths: str) -> DataFrame:
    """One or more bronze tables; the given schema keeps the zero-padded partition values as strings."""
    return reduce(DataFrame.unionByName, [spark.read.schema(bronze_schema()).parquet(path) for path in paths])


def write_silver(refined: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Snappy Parquet; Spark sizes row groups by bytes, not by rows."""
    (
        refined.write.mode(mode)
        .option("compression", "snappy")
        .option("parquet.block.size", SILVER_ROW_GROUP_BYTES)
        .parquet(path)
    )


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The streamed silver table: of each event the latest ingestion, as batch `silver` has it."""
    stored = spark.read.parquet(path)
    return latest_ingestion(stored, ties=CARRIED).drop("batch_id", *SILVER_TIES)


def compact_silver(spark: SparkSession, path: str, target: str) -> None:
    """Rewrites the streamed table by day, without superseded rows."""
    (
        read_silver(spark, path)
        .repartitionByRange("event_date", "device_id", "timestamp")
        .write.mode("overwrite")
        .option("parquet.block.size", SILVER_ROW_GROUP_BYTES)
        .partitionBy("event_date")
        .parquet(target)
    )


def write_by_device(rows: DataFrame, path: str, buckets: int = 64) -> None:
    """One file per bucket of devices, ordered by device, with a bloom filter of them, so that one device is one small read."""
    bucketed = rows.withColumn("bucket", _bucket_of(F.col("device_id"), buckets))
    (
        bucketed.repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "device_id")
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#device_id", "true")
        .option("maxRecordsPerFile", WRITE_ROWS)
        .partitionBy("bucket")
        .parquet(path)
    )


def read_device(spark: SparkSession, path: str, device_id: str, buckets: int = 64, schema: StructType | None = None) -> DataFrame:
    """The rows of one device: only its bucket's folder is listed in the plan."""
    stored = read_table(spark, path, schema=None if schema is None else extended(schema, bucket=INT))
    # The bucket is worked out first, as partitions are pruned by literals.
    bucket = spark.range(1).select(_bucket_of(F.lit(device_id), buckets)).first()[0]
    return stored.filter((F.col("bucket") == bucket) & (F.col("device_id") == device_id)).drop("bucket")


def _bucket_of(device: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(device), F.lit(buckets)).cast("int")


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Paths below `root`; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path")
    )


def write_rollup(rollup: DataFrame, path: str) -> None:
    """Day partitions, ordered by device and time; only the days in `rollup` are replaced."""
    (
        rollup.withColumn("event_date", F.to_date("bucket"))
        .repartitionByRange("event_date", "device_id", "bucket")
        .sortWithinPartitions("event_date", "device_id", "bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """A stored rollup; `event_date` lets history queries skip days."""
    return spark.read.parquet(path)


def refresh_rollup(
    spark: SparkSession, source: DataFrame, path: str, interval: str, as_of: datetime | str
) -> None:
    """Recomputes the buckets of one refresh run in a rollup table; other buckets stay as they are.

    `source` is telemetry for 1m and the 1-minute rollup for 5m and 1h.
    """
    start, end = POLICIES[interval].window(as_of)
    if start >= end:
        return
    time_col = "time" if interval == "1m" else "bucket"
    scope = refresh_range(source, time_col, interval, as_of)
    fresh = rollup_1m(scope) if interval == "1m" else rollup_from_1m(scope, interval)
    if exists(spark, path):
        days = F.col("event_date").between(F.lit(start.date()), F.lit(end.date()))
        outside = (F.col("bucket") < at(start)) | (F.col("bucket") >= at(end))
        stored = spark.read.schema(extended(fresh.schema, event_date=DATE)).parquet(path)
        fresh = fresh.unionByName(stored.filter(days & outside).drop("event_date"))
    write_rollup(fresh, path)

"""Event log: keyed JSON messages in Spark's Kafka column layout, from Kafka or from files.

Kafka needs the spark-sql-kafka package on the cluster; files need nothing and serve the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidewire.schemas import EVENT_LOG


def _layout(log: DataFrame) -> DataFrame:
    return log.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT_LOG.fields])


def read_event_log(
    spark: SparkSession, source: str, topic: str | None = None, starting: str = "earliest", fmt: str = "kafka", **options
) -> DataFrame:
    """Stream of a topic. For Kafka `source` is the broker list, otherwise a directory of files.

    The realtime reader starts at the earliest offset; the batch and archive readers at the latest.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        log = (
            reader.option("kafka.bootstrap.servers", source)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .load()
        )
        return _layout(log)
    log = _layout(reader.schema(EVENT_LOG).load(source))
    return log if topic is None else log.filter(F.col("topic") == topic)


def write_event_log(
    records: DataFrame, target: str, checkpoint: str, topic: str | None = None, fmt: str = "kafka"
) -> DataStreamWriter:
    """Writer of (key, value) records; key = device id, no key for dead letters."""
    writer = records.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if fmt == "kafka":
        return writer.option("kafka.bootstrap.servers", target).option("topic", topic)
    return writer.option("path", target)


def publish(records: DataFrame, target: str, topic: str, part: str, fmt: str = "kafka") -> None:
    """Sends one trigger's messages; files of a repeated part replace each other, Kafka gets them again."""
    if fmt == "kafka":
        records.write.format(fmt).option("kafka.bootstrap.servers", target).option("topic", topic).save()
    else:
        records.write.format(fmt).mode("overwrite").save(f"{target}/part={part}")


def keyed_json(rows: DataFrame, key: str | None, rename: dict[str, str] | None = None) -> DataFrame:
    """Rows as messages: JSON value of all columns, key column or none."""
    names = rename or {}
    value = F.to_json(F.struct(*[F.col(c).alias(names.get(c, c)) for c in rows.columns]))
    k = F.col(key) if key else F.lit(None).cast("string")
    return rows.select(k.alias("key"), value.alias("value"))


# Message field names of an alert (fixed values).
ALERT_FIELDS = {
    "alert_id": "alertId",
    "device_id": "deviceId",
    "rule_id": "ruleId",
    "triggered_at": "triggeredAt",
}


def alert_messages(alerts: DataFrame) -> DataFrame:
    return keyed_json(alerts, "device_id", ALERT_FIELDS)

"""Schemas of the records that cross a storage boundary."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DoubleType, IntegerType, LongType, MapType,
    StringType, StructType, TimestampType,
)

STRING, DOUBLE, INT, BIGINT = StringType(), DoubleType(), IntegerType(), LongType()
TIMESTAMP, DATE, BOOLEAN = TimestampType(), DateType(), BooleanType()
METRICS_MAP = MapType(STRING, DOUBLE)
TAGS_MAP = MapType(STRING, STRING)


def record(**fields: DataType) -> StructType:
    schema = StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    return schema


def extended(schema: StructType, **fields: DataType) -> StructType:
    """A copy with more fields (StructType.add would change the original)."""
    return StructType([*schema.fields, *record(**fields).fields])


# Spark's Kafka column layout; file-based logs use the same columns.
EVENT_LOG = record(
    key=STRING, value=STRING, topic=STRING, partition=INT, offset=BIGINT, timestamp=TIMESTAMP
)

TELEMETRY = record(
    time=TIMESTAMP, device_id=STRING, event_id=STRING, metrics=METRICS_MAP, tags=TAGS_MAP,
    source=STRING, ingested_at=TIMESTAMP,
)

BRONZE = record(
    event_id=STRING, device_id=STRING, timestamp=TIMESTAMP, ingested_at=TIMESTAMP,
    schema_version=STRING, source=STRING, temperature=DOUBLE, humidity=DOUBLE, pressure=DOUBLE,
    region=STRING, model=STRING, lat=DOUBLE, lon=DOUBLE, metrics=METRICS_MAP, tags=TAGS_MAP,
)

# Kept as strings: as integers the zero padding would be lost.
BRONZE_PARTITIONS = ("year", "month", "day", "hour")

ALERT = record(
    alert_id=STRING, device_id=STRING, rule_id=STRING, severity=STRING, message=STRING,
    value=DOUBLE, threshold=DOUBLE, triggered_at=TIMESTAMP,
)

RULE = record(
    rule_id=STRING, device_id_pattern=STRING, metric=STRING, operator=STRING, threshold=DOUBLE,
    severity=STRING, message=STRING,
)

LATEST_STATE = record(
    device_id=STRING, event_id=STRING, timestamp=TIMESTAMP, ingested_at=TIMESTAMP,
    metrics=METRICS_MAP, tags=TAGS_MAP, source=STRING,
)

WEATHER_RESPONSE = record(
    city=STRING,
    current=record(
        time=STRING, temperature_2m=DOUBLE, wind_speed_10m=DOUBLE, relative_humidity_2m=DOUBLE, weather_code=DOUBLE
    ),
)

AIR_QUALITY_RESPONSE = record(
    location_id=STRING,
    results=ArrayType(
        record(
            sensors=ArrayType(
                record(parameter=record(name=STRING), latest=record(value=DOUBLE, datetime=STRING))
            )
        )
    ),
)

# Topic names (fixed values).
TOPIC_RAW = "telemetry.raw"
TOPIC_ALERTS = "telemetry.alerts"
TOPIC_AGGREGATES = "telemetry.aggregates"

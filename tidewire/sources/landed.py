"""Landed responses of the external feeds, one JSON document per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewire.functions.checks import staged
from tidewire.schemas import AIR_QUALITY_RESPONSE, TIMESTAMP, WEATHER_RESPONSE, extended


def _landing(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The landing time, written by the poller beside each response, stands for the time of the poll."""
    return spark.read.schema(extended(schema, received_at=TIMESTAMP)).json(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return _landing(spark, path, WEATHER_RESPONSE)


def read_air_quality(spark: SparkSession, path: str) -> DataFrame:
    return _landing(spark, path, AIR_QUALITY_RESPONSE)


def parse_responses(raw: DataFrame, schema: StructType, text: str = "response") -> DataFrame:
    """Responses held as text in a column; unreadable ones become rows of NULLs."""
    names = [c for c in raw.columns if c != text]
    parsed = staged(raw, _r=F.from_json(text, schema))
    return parsed.select(*names, "_r.*")

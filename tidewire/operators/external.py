"""Weather and air-quality responses as canonical events, and the weather board."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.checks import staged
from tidewire.functions.ids import uuid_v7
from tidewire.functions.maps import entry
from tidewire.functions.numbers import to_fixed
from tidewire.operators.validate import SCHEMA_VERSION

# Cities polled for weather (fixed values): name, device_id, lat, lon, region.
CITIES = [
    ("San Francisco", "weather-sf-001", 37.7749, -122.4194, "us-west"),
    ("New York", "weather-ny-001", 40.7128, -74.0060, "us-east"),
    ("London", "weather-lon-001", 51.5074, -0.1278, "eu-west"),
    ("Tokyo", "weather-tyo-001", 35.6762, 139.6503, "ap-northeast"),
    ("Sydney", "weather-syd-001", -33.8688, 151.2093, "ap-southeast"),
    ("Dubai", "weather-dxb-001", 25.2048, 55.2708, "me-south"),
    ("Singapore", "weather-sin-001", 1.3521, 103.8198, "ap-southeast"),
    ("Berlin", "weather-ber-001", 52.5200, 13.4050, "eu-central"),
]

# Air-quality sites (fixed values): location_id, city, country, lat, lon, device_id.
AIR_QUALITY_SITES = [
    ("2178", "Los Angeles", "US", 34.0522, -118.2437, "aq-la-001"),
    ("8118", "London", "GB", 51.5074, -0.1278, "aq-lon-001"),
    ("155", "Delhi", "IN", 28.6139, 77.2090, "aq-del-001"),
    ("2473", "Beijing", "CN", 39.9042, 116.4074, "aq-bei-001"),
]

# Labels of WMO weather codes (fixed values).
WEATHER_CONDITIONS = {
    0: "Clear", 1: "Mainly Clear", 2: "Partly Cloudy", 3: "Overcast",
    45: "Fog", 48: "Rime Fog",
    51: "Light Drizzle", 53: "Drizzle", 55: "Heavy Drizzle",
    61: "Light Rain", 63: "Rain", 65: "Heavy Rain",
    71: "Light Snow", 73: "Snow", 75: "Heavy Snow",
    80: "Rain Showers", 81: "Heavy Showers", 82: "Violent Showers",
    95: "Thunderstorm", 96: "Thunderstorm Hail", 99: "Severe Thunderstorm",
}

WEATHER_PREFIX = "weather-"


def _dimension(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows]
    return F.broadcast(spark.range(1).select(F.inline(F.array(*structs))))


def cities(spark: SparkSession) -> DataFrame:
    return _dimension(spark, CITIES, ["city", "device_id", "lat", "lon", "region"])


def air_quality_sites(spark: SparkSession) -> DataFrame:
    return _dimension(spark, AIR_QUALITY_SITES, ["location_id", "city", "country", "lat", "lon", "device_id"])


def condition(code: Column) -> Column:
    """Label of a code, which a feed may write as 61 or 61.0."""
    pairs = [F.lit(x) for item in WEATHER_CONDITIONS.items() for x in item]
    whole = F.when(code == F.floor(code), code.cast("int"))
    return F.coalesce(F.try_element_at(F.create_map(*pairs), whole), F.lit("Unknown"))


def _reported_at(text: Column) -> Column:
    """Feed time, UTC when it carries no offset; minutes are precise enough for some feeds."""
    patterns = ("yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mmXXX")
    return F.coalesce(F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(p)) for p in patterns])


def _event(rows: DataFrame, reported: Column, received: Column, metrics: Column, tags: Column) -> DataFrame:
    """Canonical events; a time that is given but unreadable drops the row."""
    at = received.cast("timestamp")
    absent = reported.isNull() | (reported == "")
    timed = staged(rows, _at=F.when(absent, at).otherwise(_reported_at(reported)))
    return timed.filter("_at IS NOT NULL").select(
        uuid_v7(at, F.col("device_id"), at).alias("event_id"),
        "device_id",
        F.col("_at").alias("timestamp"),
        at.alias("ingested_at"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        metrics.alias("metrics"),
        tags.alias("tags"),
        F.lit("http").alias("source"),
    )


def weather_normalize(responses: DataFrame, received: str = "received_at", missing_as_null: bool = False) -> DataFrame:
    """One event per response with current data. A missing reading counts as 0, or is left out
    with `missing_as_null`."""
    c = F.col

    def reading(name: str) -> Column:
        value = c(f"current.{name}").cast("double")
        return value if missing_as_null else F.coalesce(value, F.lit(0.0))

    rows = responses.filter(c("current").isNotNull()).join(cities(responses.sparkSession), "city")
    metrics = F.create_map(
        F.lit("temperature"), reading("temperature_2m"),
        F.lit("humidity"), reading("relative_humidity_2m"),
        F.lit("wind_speed"), reading("wind_speed_10m"),
        F.lit("weather_code"), reading("weather_code"),
    )
    if missing_as_null:
        metrics = F.map_filter(metrics, lambda _, v: v.isNotNull())
    tags = F.create_map(
        F.lit("region"), c("region"),
        F.lit("source"), F.lit("open-meteo"),
        F.lit("city"), c("city"),
        F.lit("condition"), condition(F.coalesce(c("current.weather_code"), F.lit(0.0))),
        F.lit("lat"), c("lat").cast("string"),
        F.lit("lon"), c("lon").cast("string"),
    )
    return _event(rows, c("current.time"), c(received), metrics, tags)


def aq_normalize(responses: DataFrame, received: str = "received_at") -> DataFrame:
    """One event per response whose first result has readings.

    A repeated parameter keeps its last value. The event time is that of the last reading that has
    one, which need not be the newest.
    """
    c = F.col
    usable = F.filter(
        F.get(c("results"), 0)["sensors"],
        lambda s: (s["parameter"]["name"] != "") & s["latest"]["value"].isNotNull(),
    )
    rows = (
        staged(responses, _sensors=usable)
        .filter(F.size("_sensors") > 0)
        .join(air_quality_sites(responses.sparkSession), "location_id")
    )
    metrics = F.map_from_entries(
        F.transform("_sensors", lambda s: F.struct(s["parameter"]["name"], s["latest"]["value"]))
    )
    timed = F.filter("_sensors", lambda s: s["latest"]["datetime"] != "")
    last_time = F.try_element_at(timed, F.lit(-1))["latest"]["datetime"]
    tags = F.create_map(
        F.lit("region"), F.lit("unknown"),
        F.lit("source"), F.lit("openaq"),
        F.lit("city"), c("city"),
        F.lit("country"), c("country"),
        F.lit("lat"), c("lat").cast("string"),
        F.lit("lon"), c("lon").cast("string"),
    )
    return _event(rows, last_time, c(received), metrics, tags)


def external_events(weather: DataFrame, air_quality: DataFrame) -> DataFrame:
    return weather.unionByName(air_quality)


def weather_board(state: DataFrame) -> DataFrame:
    """Weather devices of the latest state with display defaults."""
    c = F.col

    def tag(name: str, default: Column) -> Column:
        return F.coalesce(F.nullif(entry("tags", name), F.lit("")), default)

    def reading(name: str) -> Column:
        return F.coalesce(entry("metrics", name), F.lit(0.0))

    return state.filter(c("device_id").startswith(WEATHER_PREFIX)).select(
        "device_id",
        tag("city", c("device_id")).alias("city"),
        to_fixed(reading("temperature"), 1).alias("temperature"),
        tag("condition", F.lit("Unknown")).alias("condition"),
        reading("humidity").alias("humidity"),
        to_fixed(reading("wind_speed"), 1).alias("wind_speed"),
        tag("region", F.lit("unknown")).alias("region"),
        "timestamp",
    )

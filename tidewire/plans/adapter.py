"""Telemetry inputs derived from the `events` table (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tidewire.functions.maps import without_nulls
from tidewire.schemas import BIGINT, DOUBLE, STRING, record
from tidewire.session import configure

X = F.expr

EVENTS = record(
    event_id=BIGINT, ts=TimestampNTZType(), user_id=BIGINT, event_type=STRING, value=DOUBLE, props=STRING
)


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    # A given schema saves the job that would read it from the files.
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("id"),
        "ts",
        "user_id",
        "event_type",
        "value",
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )


def spread(frame: DataFrame, key: str) -> DataFrame:
    """Spreads rows over all cores when the input has fewer splits than cores, as one small file has.

    Parsing text is heavy enough to pay for moving it; input with enough splits stays where it is.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame if frame.rdd.getNumPartitions() >= cores else frame.repartition(cores, key)


def device(user_id: str = "user_id") -> Column:
    return X(f"concat('dev-', lpad(cast({user_id} % 20 as string), 4, '0'))")


def event_uuid(id_: str = "id") -> Column:
    return X(f"concat('00000000-0000-7000-8000-', lpad(cast({id_} as string), 12, '0'))")


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat reading per source event; `dense_ts` places them one second apart."""
    e = source_events(spark, sf_dir)
    return e.select(
        "id",
        event_uuid().alias("event_id"),
        F.when(X("id % 97 <> 0"), device()).alias("device_id"),
        F.col("ts").alias("timestamp"),
        X("ts + k * interval '0.001' second").alias("ingested_at"),
        X("timestamp_ntz'2024-01-01 00:00:00' + id * interval '1' second").alias("dense_ts"),
        X("timestamp_ntz'2024-01-01 00:00:00' + id * interval '1' second + k * interval '0.001' second").alias(
            "dense_ingested_at"
        ),
        F.lit("1.0").alias("schema_version"),
        X("element_at(array('http', 'mqtt', 'replay'), cast(id % 3 + 1 as int))").alias("source"),
        X("case when event_type in ('click', 'view') then value end").alias("temperature"),
        X("case when event_type in ('view', 'purchase') then value end").alias("humidity"),
        X("case when event_type in ('purchase', 'error') then 950 + value end").alias("pressure"),
        X("element_at(array('us-east', 'us-west', 'eu-west'), cast(user_id % 3 + 1 as int))").alias("region"),
        X("element_at(array('DHT22', 'BME280', 'SHT31'), cast(user_id % 3 + 1 as int))").alias("model"),
        X("case when user_id % 7 <> 0 then cast((user_id * 37) % 181 - 90 as double) end").alias("lat"),
        X("case when user_id % 7 <> 0 then cast((user_id * 53) % 361 - 180 as double) end").alias("lon"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat readings, every tenth one delivered again a second later."""
    rows = wide(spark, sf_dir).drop("dense_ts", "dense_ingested_at")
    again = rows.filter("id % 10 = 0").withColumn("ingested_at", X("ingested_at + interval '1' second"))
    return rows.unionByName(again).drop("id")


def corrected_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat readings, every tenth one delivered again an hour later with another reading and day."""
    rows = wide(spark, sf_dir).drop("dense_ts", "dense_ingested_at")
    again = rows.filter("id % 10 = 0").withColumns(
        {
            "ingested_at": X("ingested_at + interval '1' hour"),
            "timestamp": X("timestamp + interval '1' day"),
            "temperature": X("temperature + 5"),
        }
    )
    return rows.unionByName(again).drop("id")


def _metrics() -> Column:
    pairs = [x for m in ("temperature", "humidity", "pressure") for x in (F.lit(m), F.col(m))]
    return without_nulls(F.create_map(*pairs))


def _tags() -> Column:
    pairs = [x for t in ("region", "model", "lat", "lon") for x in (F.lit(t), F.col(t).cast("string"))]
    return F.when(X("id % 4 <> 3"), without_nulls(F.create_map(*pairs)))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical events one second apart; every fourth has no tags."""
    return wide(spark, sf_dir).filter("device_id IS NOT NULL").select(
        "event_id",
        "device_id",
        F.col("dense_ts").alias("timestamp"),
        F.col("dense_ingested_at").alias("ingested_at"),
        "schema_version",
        _metrics().alias("metrics"),
        _tags().alias("tags"),
        "source",
    )


def redelivered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with copies 1 s, 23 h 59 min, 24 h, 25 h, 26 h and 50 h after the first arrival."""
    rows = events(spark, sf_dir).withColumn("_id", F.substring("event_id", -12, 12).cast("bigint"))
    copies = rows.withColumn(
        "_after",
        F.explode(
            X(
                "case _id % 10 when 0 then array(0, 1) when 1 then array(0, 86340) "
                "when 2 then array(0, 86400) when 3 then array(0, 90000, 93600, 180000) else array(0) end"
            )
        ),
    )
    return copies.withColumn("ingested_at", X("ingested_at + _after * interval '1' second")).drop("_id", "_after")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewire.operators.flatten import to_telemetry

    return to_telemetry(events(spark, sf_dir))


def late_telemetry(spark: SparkSession, sf_dir: str, slices: int) -> DataFrame:
    """Telemetry whose every seventh row arrives half an hour late and every fiftieth four hours; `slice` cuts arrivals evenly."""
    n = F.substring("event_id", -12, 12).cast("bigint")
    minutes = F.when(n % 50 == 0, 240).when(n % 7 == 0, 30).otherwise(0)
    rows = telemetry(spark, sf_dir).withColumn("ingested_at", F.col("time") + minutes * X("interval '1' minute"))
    x = F.unix_micros(F.col("ingested_at").cast("timestamp"))
    low, high = rows.agg(F.min(x), F.max(x)).first()
    return rows.withColumn("slice", F.least(F.lit(slices - 1), F.floor((x - low) * slices / (high - low + 1))).cast("int"))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log messages; `id % 20` decides which failure a message shows (FIXTURES.md)."""
    e = spread(source_events(spark, sf_dir), "id").withColumn("at", X("concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS\"), 'Z')"))

    def body(**changes: str) -> Column:
        part = {
            "id": event_uuid(), "device": device(), "version": F.lit("1.0"), "source": F.lit("http"),
            "reading": F.col("value").cast("string"), "at": F.col("at"),
            **{k: X(v) for k, v in changes.items()},
        }
        return F.concat(
            F.lit('{"eventId":"'), part["id"], F.lit('","deviceId":"'), part["device"],
            F.lit('","timestamp":"'), part["at"], F.lit('","ingestedAt":"'), F.col("at"),
            F.lit('","schemaVersion":"'), part["version"], F.lit('","metrics":{"temperature":'), part["reading"],
            F.lit('},"source":"'), part["source"], F.lit('"}'),
        )

    k = F.col("id") % 20
    value = (
        F.when(k == 0, F.lit(None).cast("string"))
        .when(k == 1, "")
        .when(k == 2, '{"eventId":')
        .when(k == 3, "5")
        .when(k == 4, body(source="'kafka'"))
        .when(k == 5, body(reading="concat('\"', cast(value as string), '\"')"))
        .when(k == 6, body(device="''"))
        .when(k == 7, body(version="'1'"))
        .when(k == 8, body(at="replace(at, 'Z', '')"))
        .otherwise(body())
    )
    return e.select(
        "id",
        device().alias("key"),
        value.alias("value"),
        F.lit("telemetry.raw").alias("topic"),
        X("cast(id % 8 as int)").alias("partition"),
        F.col("id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def http_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spread(source_events(spark, sf_dir), "id")
    head = F.concat(F.lit('{"deviceId":"'), device(), F.lit('"'))
    metrics = F.concat(F.lit(',"metrics":{"temperature":'), F.col("value").cast("string"), F.lit("}"))
    stamp = X("concat(',\"timestamp\":\"', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS\"), '+05:30\"')")
    local = X("concat(',\"timestamp\":\"', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '\"')")
    k = F.col("id") % 10
    body = (
        F.when(k == 0, F.concat(head, metrics, F.lit("}")))
        .when(k == 1, F.concat(head, stamp, metrics, F.lit("}")))
        .when(k == 2, F.concat(head, metrics))
        .when(k == 3, F.concat(F.lit('{"deviceId":""'), metrics, F.lit("}")))
        .when(k == 4, F.concat(head, F.lit(',"metrics":{"' + "m" * 65 + '":1}}')))
        .when(k == 5, F.concat(head, local, metrics, F.lit("}")))
        .when(k == 6, F.concat(head, metrics, F.lit(',"tags":{"region":7}}')))
        .when(k == 7, "[]")
        .otherwise(F.concat(head, metrics, F.lit(',"tags":{"region":"us-east"}}')))
    )
    return e.select(F.col("id").alias("request_id"), F.col("ts").alias("received_at"), body.alias("body"))


def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spread(source_events(spark, sf_dir), "id")
    one = F.concat(
        F.lit('{"deviceId":"'), device(), F.lit('","metrics":{"temperature":'), F.col("value").cast("string"), F.lit("}}")
    )
    k = F.col("id") % 6
    comma = F.lit(",")
    members = (
        F.when(k == 0, "[]")
        .when(k == 1, F.concat(F.lit("["), one, F.lit("]")))
        .when(k == 2, F.concat(F.lit("["), one, comma, one, F.lit("]")))
        .when(k == 3, F.concat(F.lit("["), one, F.lit(',{"deviceId":"x"}]')))
        .when(k == 4, "5")
        .otherwise(F.concat(F.lit("["), one, comma, one, comma, one, F.lit("]")))
    )
    body = F.concat(F.lit('{"events":'), members, F.lit("}"))
    return e.select(F.col("id").alias("request_id"), F.col("ts").alias("received_at"), body.alias("body"))


def mqtt_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spread(source_events(spark, sf_dir), "id")
    metrics = F.concat(F.lit('"metrics":{"temperature":'), F.col("value").cast("string"), F.lit("}"))
    stamp = X("concat(',\"timestamp\":\"', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS\"), '+05:30\"')")
    k = F.col("id") % 20
    topic = (
        F.when(k == 0, "devices//telemetry")
        .when(k == 1, "a/b")
        .when(k == 2, "devices/x/other")
        .otherwise(F.concat(F.lit("devices/"), device(), F.lit("/telemetry")))
    )
    payload = (
        F.when(k == 3, "5")
        .when(k == 4, "[]")
        .when(k == 5, "null")
        .when(k == 6, '"x"')
        .when(k == 7, "oops{")
        .when(k == 8, '{"metrics":{"temperature":"5"}}')
        .when(k == 9, F.concat(F.lit("{"), metrics, F.lit(',"timestamp":"2024-01-01"}')))
        .when(k == 10, F.concat(F.lit("{"), metrics, F.lit(',"tags":null}')))
        .when(k == 11, F.concat(F.lit("{"), metrics, stamp, F.lit("}")))
        .otherwise(F.concat(F.lit("{"), metrics, F.lit(',"tags":{"region":"us-east"}}')))
    )
    return e.select(
        F.col("id").alias("message_id"), F.col("ts").alias("received_at"), topic.alias("topic"), payload.alias("payload")
    )


def weather_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed weather responses as text; one in nine is for a city that is not polled."""
    e = spread(source_events(spark, sf_dir), "id")
    city = X(
        "element_at(array('San Francisco','New York','London','Tokyo','Sydney','Dubai','Singapore','Berlin',"
        "'Atlantis'), cast(user_id % 9 + 1 as int))"
    )
    stamp = X(
        "case when id % 7 = 0 then '' when id % 13 = 0 then '\"time\":\"soon\",' "
        "else concat('\"time\":\"', date_format(ts, \"yyyy-MM-dd'T'HH:mm\"), '\",') end"
    )
    code = X("element_at(array('0', '3', '61', '95', '77', 'null'), cast(id % 6 + 1 as int))")
    reading = X("case when event_type = 'signup' then '' else concat('\"temperature_2m\":', cast(value as string), ',') end")
    current = F.concat(
        F.lit(',"current":{'), stamp, reading, F.lit('"relative_humidity_2m":'), F.col("k").cast("string"),
        F.lit(',"wind_speed_10m":'), X("concat(cast(k div 4 as string), '.25')"),
        F.lit(',"weather_code":'), code, F.lit("}"),
    )
    response = F.concat(
        F.lit('{"city":"'), city, F.lit('"'), F.when(X("id % 11 = 0"), "").otherwise(current), F.lit("}")
    )
    return e.select(F.col("ts").alias("received_at"), response.alias("response"))


def air_quality_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spread(source_events(spark, sf_dir), "id")
    site = X("element_at(array('2178', '8118', '155', '2473', '9999'), cast(user_id % 5 + 1 as int))")
    at = "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), 'Z')"
    sensors = F.concat(
        F.lit('{"parameter":{"name":"pm25"},"latest":{"value":'), F.col("value").cast("string"),
        X(f"concat(',\"datetime\":\"', {at}, '\"}}}}')"),
        F.lit(',{"parameter":{"name":"o3"},"latest":{"value":'), F.col("k").cast("string"), F.lit("}}"),
        F.lit(',{"parameter":{"name":""},"latest":{"value":1,"datetime":"2030-01-01T00:00:00Z"}}'),
        F.lit(',{"latest":{"value":2}},{"parameter":{"name":"no2"},"latest":{}}'),
        F.when(
            X("id % 2 = 0"),
            X("concat(',{\"parameter\":{\"name\":\"pm25\"},\"latest\":{\"value\":', cast(k as string), "
              "',\"datetime\":\"2023-12-31T23:00:00Z\"}}')"),
        ).otherwise(""),
    )
    results = (
        F.when(X("id % 11 = 0"), "[]")
        .when(X("id % 11 = 1"), "[{}]")
        .otherwise(F.concat(F.lit('[{"sensors":['), sensors, F.lit("]}]")))
    )
    response = F.concat(F.lit('{"location_id":"'), site, F.lit('","results":'), results, F.lit("}"))
    return e.select(F.col("ts").alias("received_at"), response.alias("response"))


def device_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device metadata as text, one per customer of the events table's users."""
    e = spread(source_events(spark, sf_dir), "id")
    k = F.col("id") % 6
    head = F.concat(F.lit('{"deviceId":"'), device(), F.lit('"'))
    value = (
        F.when(k == 0, F.concat(head, F.lit(',"name":"n","model":"DHT22","region":"us-east","tags":{"a":"b"}}')))
        .when(k == 1, F.concat(head, F.lit("}")))
        .when(k == 2, F.concat(head, F.lit(',"name":"n","model":"' + "m" * 65 + '"}')))
        .when(k == 3, F.concat(head, F.lit(',"name":"n","tags":{"a":1}}')))
        .when(k == 4, F.concat(head, F.lit(',"name":"n"')))
        .otherwise(F.concat(head, F.lit(',"name":"n"}')))
    )
    return e.select("id", value.alias("value"))


def subscription_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscribe and unsubscribe actions of 40 clients; purchases unsubscribe."""
    e = source_events(spark, sf_dir)
    return e.select(
        X("concat('client-', lpad(cast(user_id % 40 as string), 2, '0'))").alias("client_id"),
        F.col("id").alias("seq"),
        X("case when event_type in ('purchase', 'error') then 'unsubscribe' else 'subscribe' end").alias("action"),
        X("case when k < 70 then '*' else concat('dev-', lpad(cast(k % 20 as string), 4, '0')) end").alias("device_id"),
    )


def client_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connections and subscriptions of 40 clients, half a second after the event that they are made from."""
    e = source_events(spark, sf_dir)
    return e.select(
        X("concat('client-', lpad(cast(user_id % 40 as string), 2, '0'))").alias("client_id"),
        F.col("id").alias("seq"),
        X("timestamp_ntz'2024-01-01 00:00:00.5' + id * interval '1' second").alias("at"),
        X(
            "case when event_type = 'signup' and k < 25 then 'connect' when event_type = 'signup' and k < 40 then 'disconnect' "
            "when event_type in ('purchase', 'error') then 'unsubscribe' else 'subscribe' end"
        ).alias("action"),
        X("case when k % 3 = 0 then '*' else concat('dev-', lpad(cast(k % 20 as string), 4, '0')) end").alias("device_id"),
    )


def offsets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Committed and end offsets per log partition; one partition has no end yet."""
    e = source_events(spark, sf_dir).withColumn("partition", X("cast(id % 8 as int)"))
    topic = F.lit("telemetry.raw").alias("topic")
    committed = e.groupBy("partition").agg(
        F.max(X("case when event_type = 'error' and id % 8 <> 3 then id end")).alias("m")
    ).select(F.lit("batch").alias("group"), topic, "partition", X("coalesce(m + 1, -1)").alias("committed"))
    latest = (
        e.filter("id % 8 <> 5")
        .groupBy("partition")
        .agg((F.max("id") + 1).alias("latest"))
        .select(topic, "partition", "latest")
    )
    return committed, latest


def file_listing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Archive files, one per source hour and source kind, and the manifest of those already processed."""
    e = source_events(spark, sf_dir)
    path = X(
        "concat('raw/', date_format(ts, \"'year='yyyy'/month='MM'/day='dd'/hour='HH\"), '/batch-', "
        "cast(id % 3 as string), case when event_type = 'signup' then '.tmp' else '.parquet' end)"
    )
    files = e.groupBy(path.alias("path")).agg(F.min("ts").alias("processed_at"), F.min("id").alias("first_id"))
    return files.select("path"), files.filter("first_id % 4 = 0").select("path", "processed_at")


def newest(frame: DataFrame, column: str):
    """The as-of instant of a query: the newest value in the data."""
    return frame.agg(F.max(column)).first()[0]

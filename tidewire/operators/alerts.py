"""Threshold rules, alert rows and the views over alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.ids import uuid_v7
from tidewire.functions.numbers import to_fixed
from tidewire.operators.flatten import metrics_long
from tidewire.operators.joins import lookup_join
from tidewire.operators.spacing import keep_spaced
from tidewire.schemas import RULE

# Rules (fixed values): rule_id, device_id_pattern, metric, operator, threshold, severity, message.
ALERT_RULES = [
    ("temp-high", "*", "temperature", ">", 30.0, "warning", "Temperature above 30°C"),
    ("temp-critical", "*", "temperature", ">", 40.0, "critical", "Temperature above 40°C — CRITICAL"),
    ("humidity-low", "*", "humidity", "<", 20.0, "info", "Humidity below 20%"),
    ("pressure-drop", "*", "pressure", "<", 1000.0, "warning", "Pressure below 1000 hPa"),
]

ALERT_COLUMNS = (
    "alert_id", "device_id", "rule_id", "severity", "message", "value", "threshold", "triggered_at",
)


def rules_frame(spark: SparkSession, rules: list[tuple] = ALERT_RULES) -> DataFrame:
    rows = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(rule, RULE.fields)])
        for rule in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def breached(value: Column, operator: Column, threshold: Column) -> Column:
    return (
        F.when(operator == ">", value > threshold)
        .when(operator == "<", value < threshold)
        .when(operator == ">=", value >= threshold)
        .when(operator == "<=", value <= threshold)
        .otherwise(False)
    )


def _hits(readings: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules for all devices join on the metric. Rules for one device join on device and metric, so
    many of them do not multiply the readings."""
    general = rules.filter("device_id_pattern = '*'").drop("device_id_pattern")
    personal = rules.filter("device_id_pattern <> '*'").withColumnRenamed("device_id_pattern", "device_id")
    hits = lookup_join(readings, general, ["metric"], ["event_id"])
    if personal.isEmpty():
        return hits
    return hits.unionByName(lookup_join(readings, personal, ["device_id", "metric"], ["event_id"]))


def alerts_rules(events: DataFrame, rules: DataFrame | None = None, arrival: str = "ingested_at") -> DataFrame:
    """One alert per event and breached rule; a missing metric breaches nothing, there is no cooldown.

    Without `rules` the four built-in ones apply, which all hold for every device.
    """
    readings = metrics_long(events, "event_id", "device_id", arrival)
    if rules is None:
        built_in = rules_frame(events.sparkSession).drop("device_id_pattern")
        hits = readings.join(F.broadcast(built_in), "metric")
    else:
        hits = _hits(readings, rules)
    c = F.col
    return hits.filter(breached(c("value"), c("operator"), c("threshold"))).select(
        uuid_v7(c(arrival), c("event_id"), c("rule_id")).alias("alert_id"),
        "device_id",
        "rule_id",
        "severity",
        "message",
        "value",
        "threshold",
        c(arrival).alias("triggered_at"),
    )


def anomaly_alerts(scored: DataFrame, arrival: str = "ts") -> DataFrame:
    """Warnings of anomalous samples; the threshold is mean + 3 sd for low outliers as well."""
    c = F.col
    message = F.concat(
        F.lit("Anomaly detected in "), c("metric"),
        F.lit(": value="), to_fixed(c("value"), 2),
        F.lit(", z-score="), to_fixed(c("z_score"), 2),
    )
    rule = F.concat(F.lit("anomaly-"), c("metric"))
    return scored.filter("is_anomaly").select(
        uuid_v7(c(arrival), c("event_id"), rule).alias("alert_id"),
        "device_id",
        rule.alias("rule_id"),
        F.lit("warning").alias("severity"),
        message.alias("message"),
        "value",
        (c("mean") + 3 * c("std_dev")).alias("threshold"),
        c(arrival).alias("triggered_at"),
    )


def alerts_all(threshold_alerts: DataFrame, anomalies: DataFrame) -> DataFrame:
    return threshold_alerts.unionByName(anomalies)


def alert_log(alerts: DataFrame, n: int = 50) -> DataFrame:
    """The newest alerts."""
    return alerts.orderBy(F.col("triggered_at").desc_nulls_last(), F.col("alert_id").desc_nulls_last()).limit(n)


def to_alert_table(alerts: DataFrame) -> DataFrame:
    """Rows of the alerts table, not acknowledged yet."""
    return alerts.withColumns({"acknowledged": F.lit(False), "created_at": F.col("triggered_at")})


def alerts_open(alert_table: DataFrame) -> DataFrame:
    """Alerts nobody acknowledged, by severity, newest first."""
    return alert_table.filter(~F.col("acknowledged")).orderBy(
        F.col("severity").asc_nulls_last(), F.col("triggered_at").desc_nulls_last(), "alert_id"
    )


def alert_cooldown(alerts: DataFrame, seconds: float) -> DataFrame:
    """Suppresses alerts of a (device, rule) within `seconds` of the last one let through."""
    return keep_spaced(alerts, ["device_id", "rule_id"], "triggered_at", seconds, ties=["alert_id"])

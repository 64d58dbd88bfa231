"""DuckDB SQL that states the expected result of each query, over the same test tables."""

from __future__ import annotations

from tidewire.operators.external import AIR_QUALITY_SITES, CITIES, WEATHER_CONDITIONS

ORACLE: dict[str, str] = {}

BASE = """
ev AS (
  SELECT event_id AS id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         'dev-' || lpad(CAST(user_id % 20 AS VARCHAR), 4, '0') AS dev,
         '00000000-0000-7000-8000-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS uuid
  FROM events
), wide AS (
  SELECT id, uuid AS event_id, CASE WHEN id % 97 <> 0 THEN dev END AS device_id,
         ts AS timestamp, ts + k * INTERVAL 1 MILLISECOND AS ingested_at,
         TIMESTAMP '2024-01-01 00:00:00' + CAST(id AS INTEGER) * INTERVAL 1 SECOND AS dense_ts,
         TIMESTAMP '2024-01-01 00:00:00' + CAST(id AS INTEGER) * INTERVAL 1 SECOND
           + k * INTERVAL 1 MILLISECOND AS dense_ingested_at,
         '1.0' AS schema_version,
         CASE id % 3 WHEN 0 THEN 'http' WHEN 1 THEN 'mqtt' ELSE 'replay' END AS source,
         CASE WHEN event_type IN ('click', 'view') THEN value END AS temperature,
         CASE WHEN event_type IN ('view', 'purchase') THEN value END AS humidity,
         CASE WHEN event_type IN ('purchase', 'error') THEN 950 + value END AS pressure,
         CASE user_id % 3 WHEN 0 THEN 'us-east' WHEN 1 THEN 'us-west' ELSE 'eu-west' END AS region,
         CASE user_id % 3 WHEN 0 THEN 'DHT22' WHEN 1 THEN 'BME280' ELSE 'SHT31' END AS model,
         CASE WHEN user_id % 7 <> 0 THEN CAST((user_id * 37) % 181 - 90 AS DOUBLE) END AS lat,
         CASE WHEN user_id % 7 <> 0 THEN CAST((user_id * 53) % 361 - 180 AS DOUBLE) END AS lon
  FROM ev
), bronze AS (
  SELECT * EXCLUDE (id, dense_ts, dense_ingested_at) FROM wide
  UNION ALL
  SELECT * EXCLUDE (id, dense_ts, dense_ingested_at) REPLACE (ingested_at + INTERVAL 1 SECOND AS ingested_at)
  FROM wide WHERE id % 10 = 0
), tele AS (
  SELECT id, event_id, device_id, dense_ts AS time, dense_ingested_at AS ingested_at, source,
         temperature, humidity, pressure, id % 4 <> 3 AS tagged,
         CASE WHEN id % 4 <> 3 THEN region END AS region, CASE WHEN id % 4 <> 3 THEN model END AS model,
         CASE WHEN id % 4 <> 3 THEN lat END AS lat, CASE WHEN id % 4 <> 3 THEN lon END AS lon
  FROM wide WHERE device_id IS NOT NULL
), long AS (
  SELECT event_id, device_id, ingested_at, 'temperature' AS metric, temperature AS value FROM tele WHERE temperature IS NOT NULL
  UNION ALL
  SELECT event_id, device_id, ingested_at, 'humidity', humidity FROM tele WHERE humidity IS NOT NULL
  UNION ALL
  SELECT event_id, device_id, ingested_at, 'pressure', pressure FROM tele WHERE pressure IS NOT NULL
)"""

TAGS = """concat_ws('{sep}', CASE WHEN lat IS NOT NULL THEN 'lat=' || CAST(lat AS VARCHAR) END,
  CASE WHEN lon IS NOT NULL THEN 'lon=' || CAST(lon AS VARCHAR) END, 'model=' || model, 'region=' || region)"""


def define(name: str, select: str, *ctes: str, recursive: bool = False) -> None:
    """`ctes` are further named subqueries on top of BASE."""
    head = "WITH RECURSIVE " if recursive else "WITH "
    ORACLE[name] = head + ",\n".join([BASE.strip(), *[c.strip() for c in ctes]]) + "\n" + select.strip()


def uuid_v7(ts: str, *identity: str) -> str:
    clock = f"format('{{:012x}}', epoch_us({ts}) // 1000)"
    digest = f"md5(concat_ws('|', {', '.join(f'CAST({i} AS VARCHAR)' for i in identity)}))"
    return (
        f"substr({clock}, 1, 8) || '-' || substr({clock}, 9, 4) || '-7' || substr({digest}, 1, 3) || '-' || "
        f"translate(substr({digest}, 4, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({digest}, 5, 3) "
        f"|| '-' || substr({digest}, 8, 12)"
    )


def fixed(x: str, digits: int) -> str:
    """printf rounds the exact binary value and exact ties to even; nudge those ties up."""
    grid = 2 * 2**digits
    tie = f"({x}) * {grid} = floor(({x}) * {grid}) AND CAST(floor(({x}) * {grid}) AS BIGINT) % 2 = 1"
    return f"printf('%.{digits}f', CASE WHEN {tie} THEN ({x}) + {10.0 ** -(digits + 1)} ELSE ({x}) END)"


# --- raw edge ---------------------------------------------------------------------------------

STATUS = """status AS (
  SELECT *, CASE WHEN id % 20 < 2 THEN 'empty' WHEN id % 20 = 2 THEN 'invalid_json'
                 WHEN id % 20 < 9 THEN 'schema_invalid' ELSE 'ok' END AS status,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS stamp
  FROM ev
)"""

RAW = """raw AS (
  SELECT id, status, ts,
    CASE id % 20 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '{"eventId":' WHEN 3 THEN '5' ELSE
      '{"eventId":"' || uuid || '","deviceId":"' || CASE WHEN id % 20 = 6 THEN '' ELSE dev END
      || '","timestamp":"' || stamp || CASE WHEN id % 20 = 8 THEN '' ELSE 'Z' END
      || '","ingestedAt":"' || stamp || 'Z","schemaVersion":"' || CASE WHEN id % 20 = 7 THEN '1' ELSE '1.0' END
      || '","metrics":{"temperature":'
      || CASE WHEN id % 20 = 5 THEN '"' || CAST(value AS VARCHAR) || '"' ELSE CAST(value AS VARCHAR) END
      || '},"source":"' || CASE WHEN id % 20 = 4 THEN 'kafka' ELSE 'http' END || '"}' END AS value
  FROM status
)"""

define(
    "validate_status",
    """SELECT id, status, CASE WHEN status = 'ok' THEN uuid END AS event_id,
       CASE WHEN status = 'ok' THEN dev END AS device_id,
       CASE WHEN status = 'ok' THEN date_trunc('millisecond', ts) END AS timestamp,
       CASE WHEN status = 'ok' THEN value END AS temperature,
       CASE WHEN status = 'ok' THEN 'http' END AS source
FROM status""",
    STATUS,
)
define(
    "invalid_counts",
    "SELECT status AS reason, count(*) AS n FROM status WHERE status LIKE '%invalid%' GROUP BY status",
    STATUS,
)
define(
    "dlq_rows",
    """SELECT status AS reason,
       CASE status WHEN 'invalid_json' THEN 'value is not one JSON document'
                   ELSE 'value does not match the telemetry event schema' END AS error,
       substr(value, 1, 1000) AS raw, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS timestamp
FROM raw WHERE status LIKE '%invalid%'""",
    STATUS,
    RAW,
)
define(
    "device_validate",
    """SELECT id, CASE id % 6 WHEN 4 THEN 'invalid_json' WHEN 0 THEN 'ok' WHEN 5 THEN 'ok'
              ELSE 'schema_invalid' END AS status FROM ev""",
)
define(
    "ingest_validate",
    """SELECT id AS request_id, CASE WHEN id % 10 IN (0, 1, 8, 9) THEN 'ok' WHEN id % 10 = 2 THEN 'invalid_json'
       ELSE 'schema_invalid' END AS status FROM ev""",
)
define(
    "ingest_normalize",
    f"""SELECT id AS request_id, {uuid_v7('ts', 'id', '0')} AS event_id, dev AS device_id,
       CASE WHEN id % 10 = 1 THEN date_trunc('millisecond', ts) - INTERVAL 330 MINUTE ELSE ts END AS timestamp,
       ts AS ingested_at, '1.0' AS schema_version, 'http' AS source, value AS temperature,
       CAST(1 AS BIGINT) AS n_metrics, CASE WHEN id % 10 IN (8, 9) THEN 'us-east' END AS region
FROM ev WHERE id % 10 IN (0, 1, 8, 9)""",
)
define(
    "ingest_batch_explode",
    f"""SELECT id AS request_id, position, {uuid_v7('ts', 'id', 'position')} AS event_id, dev AS device_id,
       ts AS timestamp, ts AS ingested_at, '1.0' AS schema_version, 'http' AS source, value AS temperature,
       CAST(1 AS BIGINT) AS n_metrics, CAST(NULL AS VARCHAR) AS region
FROM ev JOIN positions ON position < CASE id % 6 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 5 THEN 3 ELSE 0 END""",
    "positions AS (SELECT CAST(unnest([0, 1, 2]) AS BIGINT) AS position)",
)
define("mqtt_topic_parse", "SELECT id AS message_id, dev AS device_id FROM ev WHERE id % 20 > 2")
define(
    "mqtt_normalize",
    f"""SELECT id AS message_id, {uuid_v7('ts', "'devices/' || dev || '/telemetry'", 'id')} AS event_id,
       dev AS device_id,
       CASE WHEN id % 20 = 11 THEN date_trunc('millisecond', ts) - INTERVAL 330 MINUTE ELSE ts END AS timestamp,
       ts AS ingested_at, '1.0' AS schema_version, 'mqtt' AS source,
       CASE WHEN id % 20 > 6 THEN value END AS temperature,
       CAST(CASE WHEN id % 20 > 6 THEN 1 ELSE 0 END AS BIGINT) AS n_metrics,
       CASE WHEN id % 20 > 11 THEN 'us-east' END AS region
FROM ev WHERE id % 20 BETWEEN 3 AND 6 OR id % 20 > 10""",
)
define("event_id_v7", f"SELECT id, {uuid_v7('ts', chr(39) + 'telemetry.raw' + chr(39), 'id % 8', 'id')} AS uuid FROM ev")
define(
    "rate_limit_audit",
    """SELECT key, start AS window_start, count(*) AS requests, CAST(greatest(0, count(*) - 12) AS BIGINT) AS rejected
FROM requests ASOF JOIN (SELECT key AS owner, start FROM windows) ON key = owner AND at_time >= start GROUP BY 1, 2""",
    """requests AS (
  SELECT CASE model WHEN 'SHT31' THEN region ELSE source END AS key, dense_ingested_at AS at_time FROM wide
), windows AS (
  SELECT key, min(at_time) AS start FROM requests GROUP BY key
  UNION ALL
  SELECT w.key, min(r.at_time) FROM windows w JOIN requests r ON r.key = w.key AND r.at_time >= w.start + INTERVAL 60 SECOND GROUP BY w.key
)""",
    recursive=True,
)
define(
    "rate_limit_by_clock",
    """SELECT CASE model WHEN 'SHT31' THEN region ELSE source END AS key, date_trunc('minute', dense_ts) AS window_start, count(*) AS requests,
       CAST(greatest(0, count(*) - 15) AS BIGINT) AS rejected
FROM wide GROUP BY ALL""",
)

# --- bronze and silver ------------------------------------------------------------------------

define(
    "bronze_flatten",
    """SELECT event_id, device_id, date_trunc('millisecond', time) AS timestamp,
       date_trunc('millisecond', ingested_at) AS ingested_at, '1.0' AS schema_version, source,
       temperature, humidity, pressure, region, model, lat, lon FROM tele""",
)
define(
    "bronze_layout",
    """SELECT 'raw/year=' || year || '/month=' || month || '/day=' || day || '/hour=' || hour AS directory,
       year, month, day, hour, count(*) AS n
FROM (SELECT strftime(timestamp, '%Y') AS year, strftime(timestamp, '%m') AS month,
             strftime(timestamp, '%d') AS day, strftime(timestamp, '%H') AS hour FROM wide)
GROUP BY ALL""",
)
define(
    "bronze_scan",
    """SELECT source, strftime(ingested_at, '%Y') AS year, strftime(ingested_at, '%m') AS month,
       strftime(ingested_at, '%d') AS day, count(*) AS n FROM bronze GROUP BY ALL""",
)

REFINED = """complete AS (
  SELECT * FROM bronze WHERE event_id IS NOT NULL AND device_id IS NOT NULL AND timestamp IS NOT NULL
), newest AS (
  SELECT event_id, max(ingested_at) AS ingested_at FROM complete GROUP BY event_id
), refined AS (
  SELECT b.event_id, device_id, timestamp, b.ingested_at,
         date_diff('millisecond', timestamp, b.ingested_at) AS ingest_latency_ms, source,
         temperature, humidity, pressure, region, model,
         CAST(hour(timestamp) AS BIGINT) AS hour_of_day, CAST(dayofweek(timestamp) AS BIGINT) AS day_of_week,
         CAST(timestamp AS DATE) AS event_date,
         CASE WHEN temperature >= 40 THEN 'critical' WHEN temperature >= 30 THEN 'high'
              WHEN temperature >= 15 THEN 'normal' WHEN temperature < 15 THEN 'low' ELSE 'unknown' END AS temp_category,
         CASE WHEN lat + lon IS NULL THEN 'unknown' WHEN lat > 60 THEN 'arctic' WHEN lat < -60 THEN 'antarctic'
              WHEN lat BETWEEN 23.5 AND 60 THEN 'northern-temperate'
              WHEN lat BETWEEN -60 AND -23.5 THEN 'southern-temperate' ELSE 'tropical' END AS climate_zone,
         CASE sign(lat) WHEN 1 THEN 'northern' WHEN -1 THEN 'southern' ELSE 'equatorial' END AS hemisphere,
         temperature >= 30 AS is_high_temp, humidity < 20 AS is_low_humidity, pressure < 1000 AS is_low_pressure
  FROM complete b JOIN newest n ON b.event_id = n.event_id AND b.ingested_at = n.ingested_at
)"""

define("silver", "SELECT * FROM refined", REFINED)
define("silver_dedup", "SELECT event_id, device_id, ingested_at FROM refined", REFINED)
define(
    "silver_by_category",
    "SELECT temp_category, climate_zone, hemisphere, count(*) AS n FROM refined GROUP BY ALL",
    REFINED,
)
define(
    "silver_increment",
    """SELECT event_id, device_id, ingested_at, temp_category FROM refined
WHERE timestamp >= TIMESTAMP '2024-01-16 00:00:00'""",
    REFINED,
)
TOTALS = """totals AS (
  SELECT (SELECT count(*) FROM bronze) AS events_in, (SELECT count(*) FROM complete) AS valid,
         (SELECT count(*) FROM refined) AS events_out
)"""
define(
    "silver_removed",
    """SELECT events_in, events_out, events_in - valid AS incomplete_removed, valid - events_out AS copies_removed,
       events_in - events_out AS duplicates_removed FROM totals""",
    REFINED,
    TOTALS,
)
FILES = """files AS (
  SELECT 'raw/year=' || strftime(ts, '%Y') || '/month=' || strftime(ts, '%m') || '/day=' || strftime(ts, '%d')
         || '/hour=' || strftime(ts, '%H') || '/batch-' || CAST(id % 3 AS VARCHAR)
         || CASE WHEN event_type = 'signup' THEN '.tmp' ELSE '.parquet' END AS path,
         min(ts) AS processed_at, min(id) AS first_id
  FROM ev GROUP BY 1
)"""
define(
    "silver_stats",
    """SELECT (SELECT least(50, count(*)) FROM files WHERE path LIKE '%.parquet' AND first_id % 4 <> 0) AS processed_files,
       (SELECT count(*) FROM files WHERE path LIKE '%.parquet' AND first_id % 4 = 0) AS skipped_files,
       events_in, events_out, events_in - events_out AS duplicates_removed FROM totals""",
    REFINED,
    TOTALS,
    FILES,
)
define(
    "pending_files",
    "SELECT path FROM files WHERE path LIKE '%.parquet' AND first_id % 4 <> 0 ORDER BY path LIMIT 50",
    FILES,
)
define(
    "manifest_compact",
    """SELECT path, processed_at FROM files WHERE first_id % 4 = 0
ORDER BY processed_at DESC NULLS LAST, path DESC LIMIT 10000""",
    FILES,
)

# --- telemetry table, rollups, history -----------------------------------------------------------

define(
    "telemetry_append",
    f"""SELECT time, device_id, event_id, source, ingested_at, {TAGS.format(sep=',')} AS tags,
       concat_ws(',', CASE WHEN humidity IS NOT NULL THEN 'humidity' END,
         CASE WHEN pressure IS NOT NULL THEN 'pressure' END,
         CASE WHEN temperature IS NOT NULL THEN 'temperature' END) AS metric_names
FROM tele""",
)


def minute(scope: str = "") -> str:
    return f"""m1 AS (
  SELECT date_trunc('minute', time) AS bucket, device_id,
         avg(temperature) AS avg_temperature, min(temperature) AS min_temperature, max(temperature) AS max_temperature,
         avg(humidity) AS avg_humidity, min(humidity) AS min_humidity, max(humidity) AS max_humidity,
         avg(pressure) AS avg_pressure, count(*) AS sample_count,
         sum(temperature) AS st, count(temperature) AS nt, sum(humidity) AS sh, count(humidity) AS nh,
         sum(pressure) AS sp, count(pressure) AS np
  FROM tele {scope} GROUP BY 1, 2
)"""


M1_COLUMNS = """bucket, device_id, round(avg_temperature + 1e-9, 6) AS avg_temperature, min_temperature, max_temperature,
       round(avg_humidity + 1e-9, 6) AS avg_humidity, min_humidity, max_humidity,
       round(avg_pressure + 1e-9, 6) AS avg_pressure, sample_count"""


def coarse(width: str) -> str:
    return f"""coarse AS (
  SELECT time_bucket(INTERVAL '{width}', bucket) AS bucket, device_id,
         round(avg(avg_temperature) + 1e-9, 6) AS avg_temperature, min(min_temperature) AS min_temperature,
         max(max_temperature) AS max_temperature, round(avg(avg_humidity) + 1e-9, 6) AS avg_humidity,
         round(avg(avg_pressure) + 1e-9, 6) AS avg_pressure, CAST(sum(sample_count) AS BIGINT) AS sample_count
  FROM m1 GROUP BY 1, 2
)"""


define("rollup_1m", f"SELECT {M1_COLUMNS} FROM m1", minute())
for _key, _width in (("5m", "5 minutes"), ("1h", "1 hour")):
    define(f"rollup_{_key}", "SELECT * FROM coarse", minute(), coarse(_width))
    define(
        f"rollup_{_key}_weighted",
        f"""SELECT time_bucket(INTERVAL '{_width}', time) AS bucket, device_id,
       round(avg(temperature) + 1e-9, 6) AS avg_temperature, round(avg(humidity) + 1e-9, 6) AS avg_humidity,
       round(avg(pressure) + 1e-9, 6) AS avg_pressure, min(temperature) AS min_temperature,
       max(temperature) AS max_temperature, count(*) AS sample_count
FROM tele GROUP BY 1, 2""",
    )
    define(
        f"history_{_key}",
        """SELECT bucket AS time, avg_temperature AS temperature, avg_humidity AS humidity,
       avg_pressure AS pressure, sample_count
FROM coarse WHERE device_id = 'dev-0001' ORDER BY bucket LIMIT 10000""",
        minute(),
        coarse(_width),
    )
define(
    "rollup_refresh",
    f"SELECT {M1_COLUMNS} FROM m1",
    "edge AS (SELECT max(time) AS t FROM tele)",
    minute(
        """, edge WHERE time < date_trunc('minute', t - INTERVAL 1 MINUTE)
        AND date_trunc('minute', time) >= t - INTERVAL 3 HOUR"""
    ),
)
LATE = f"""arrivals AS (
  SELECT id, time, epoch_us(time + CASE WHEN id % 50 = 0 THEN INTERVAL 4 HOUR WHEN id % 7 = 0 THEN INTERVAL 30 MINUTE ELSE INTERVAL 0 MINUTE END) AS x
  FROM tele
), sliced AS (SELECT *, (x - min(x) OVER ()) * 4 // (max(x) OVER () - min(x) OVER () + 1) AS slice FROM arrivals),
clocks AS (SELECT slice, max(max(x)) OVER (ORDER BY slice) AS clock FROM sliced GROUP BY slice),
entered AS (
  SELECT id FROM sliced JOIN clocks USING (slice) WHERE epoch_us(date_trunc('minute', time)) >= clock - 3 * 3600 * 1000000::BIGINT
), {minute("JOIN entered USING (id)")}"""
define("rollup_live_1m", f"SELECT {M1_COLUMNS} FROM m1", LATE)
define("rollup_live_1h", "SELECT * FROM coarse", LATE, coarse("1 hour"))
define(
    "retention_keep",
    "SELECT event_id, timestamp AS time FROM wide WHERE timestamp >= TIMESTAMP '2024-01-11 00:00:00'",
)
define(
    "history_raw",
    """SELECT time, temperature, humidity, pressure FROM tele WHERE device_id = 'dev-0001'
ORDER BY time, event_id LIMIT 10000""",
)
define(
    "history_default",
    """SELECT time, temperature, humidity, pressure FROM tele
WHERE device_id = 'dev-0001' AND time BETWEEN (SELECT max(time) FROM tele) - INTERVAL 1 HOUR
  AND (SELECT max(time) FROM tele)
ORDER BY time, event_id LIMIT 1000""",
)
define(
    "history_envelope",
    """SELECT 'dev-0001' AS device_id, 'raw' AS "interval", TIMESTAMP '2024-01-01 00:00:00' AS "from",
       TIMESTAMP '2024-01-31 00:00:00' AS "to", count(*) AS count,
       '[' || string_agg('{"time":"' || strftime(time, '%Y-%m-%dT%H:%M:%S.%gZ') || '","temperature":'
         || coalesce(CAST(temperature AS VARCHAR), 'null') || ',"humidity":' || coalesce(CAST(humidity AS VARCHAR), 'null')
         || ',"pressure":' || coalesce(CAST(pressure AS VARCHAR), 'null') || '}', ',' ORDER BY time) || ']' AS data
FROM tele WHERE device_id = 'dev-0001'""",
)
define(
    "history_1m",
    """SELECT bucket AS time, round(avg_temperature + 1e-9, 6) AS temperature, round(avg_humidity + 1e-9, 6) AS humidity,
       round(avg_pressure + 1e-9, 6) AS pressure, sample_count
FROM m1 WHERE device_id = 'dev-0001' ORDER BY bucket LIMIT 10000""",
    minute(),
)

# --- alerts and anomalies ------------------------------------------------------------------------

define("metrics_long", "SELECT event_id, device_id, metric, value FROM long")

FIRED = f"""fired AS (
  SELECT {uuid_v7('ingested_at', 'event_id', 'rule_id')} AS alert_id, device_id, rule_id, severity, message,
         value, threshold, ingested_at AS triggered_at
  FROM (
    SELECT *, 'temp-high' AS rule_id, 'warning' AS severity, 'Temperature above 30°C' AS message,
           CAST(30 AS DOUBLE) AS threshold FROM long WHERE metric = 'temperature' AND value > 30
    UNION ALL
    SELECT *, 'temp-critical', 'critical', 'Temperature above 40°C — CRITICAL', 40 FROM long
    WHERE metric = 'temperature' AND value > 40
    UNION ALL
    SELECT *, 'humidity-low', 'info', 'Humidity below 20%', 20 FROM long WHERE metric = 'humidity' AND value < 20
    UNION ALL
    SELECT *, 'pressure-drop', 'warning', 'Pressure below 1000 hPa', 1000 FROM long
    WHERE metric = 'pressure' AND value < 1000
  )
)"""

SCORED = """rolled AS (
  SELECT device_id, event_id, ingested_at AS ts, metric, value, count(*) OVER w AS n_samples,
         avg(value) OVER w AS mean, stddev_pop(value) OVER w AS std_dev
  FROM long
  WINDOW w AS (PARTITION BY device_id, metric ORDER BY ingested_at, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)
), judged AS (
  SELECT *, CASE WHEN n_samples < 20 THEN NULL WHEN std_dev = 0 THEN 0 ELSE abs((value - mean) / std_dev) END AS z_score
  FROM rolled
)"""

ODD = f"""odd AS (
  SELECT {uuid_v7('ts', 'event_id', "'anomaly-' || metric")} AS alert_id, device_id,
         'anomaly-' || metric AS rule_id, 'warning' AS severity,
         'Anomaly detected in ' || metric || ': value=' || {fixed('value', 2)} || ', z-score=' || {fixed('z_score', 2)}
           AS message,
         value, mean + 3 * std_dev AS threshold, ts AS triggered_at
  FROM judged WHERE z_score > 3
), every_alert AS (SELECT * FROM fired UNION ALL SELECT * FROM odd)"""

ALERT = "alert_id, device_id, rule_id, severity, message, value, round(threshold + 1e-9, 6) AS threshold, triggered_at"

define("alerts_rules", "SELECT * FROM fired", FIRED)
define(
    "alerts_device_rules",
    """SELECT * EXCLUDE (alert_id) FROM fired
UNION ALL
SELECT device_id, 'own-' || CAST(s_suppkey AS VARCHAR), 'info', s_name, value, 60, ingested_at
FROM long JOIN supplier ON device_id = 'dev-' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0')
WHERE metric = 'humidity' AND value >= 60""",
    FIRED,
)
define(
    "anomaly_zscore",
    """SELECT device_id, event_id, ts, metric, value, n_samples, round(mean + 1e-9, 6) AS mean, round(std_dev + 1e-9, 6) AS std_dev,
       round(z_score + 1e-9, 6) AS z_score, z_score > 3 AS is_anomaly FROM judged""",
    SCORED,
)
define("anomaly_alerts", f"SELECT {ALERT} FROM odd", FIRED, SCORED, ODD)
define("alerts_all", f"SELECT {ALERT} FROM every_alert", FIRED, SCORED, ODD)
define(
    "alert_log",
    f"SELECT {ALERT} FROM (SELECT * FROM every_alert ORDER BY triggered_at DESC NULLS LAST, alert_id DESC LIMIT 50)",
    FIRED,
    SCORED,
    ODD,
)
define(
    "alerts_open",
    "SELECT *, false AS acknowledged FROM fired WHERE value >= 45 ORDER BY severity, triggered_at DESC, alert_id",
    FIRED,
)
define(
    "alert_cooldown",
    """SELECT f.* FROM fired f JOIN chain c USING (device_id, rule_id)
WHERE f.triggered_at = c.t
QUALIFY row_number() OVER (PARTITION BY f.device_id, f.rule_id, f.triggered_at ORDER BY f.alert_id) = 1""",
    FIRED.replace("fired AS (", "fired AS MATERIALIZED (", 1),
    """chain AS (
  SELECT device_id, rule_id, min(triggered_at) AS t FROM fired GROUP BY ALL
  UNION ALL
  SELECT c.device_id, c.rule_id, min(f.triggered_at) FROM chain c
  JOIN fired f ON f.device_id = c.device_id AND f.rule_id = c.rule_id
    AND f.triggered_at >= c.t + INTERVAL 300 SECOND
  GROUP BY ALL
)""",
    recursive=True,
)
define(
    "recent_samples",
    """SELECT device_id, event_id, ingested_at AS ts, metric, value FROM long
QUALIFY row_number() OVER (PARTITION BY device_id, metric ORDER BY ingested_at DESC, event_id DESC) <= 100""",
)

# --- state, devices, live feed ---------------------------------------------------------------------

CHAIN = """copies AS MATERIALIZED (
  SELECT event_id, device_id, ingested_at + CAST(after AS INTEGER) * INTERVAL 1 SECOND AS t
  FROM (SELECT *, unnest(CASE id % 10 WHEN 0 THEN [0, 1] WHEN 1 THEN [0, 86340] WHEN 2 THEN [0, 86400]
                         WHEN 3 THEN [0, 90000, 93600, 180000] ELSE [0] END) AS after FROM tele)
), chain AS (
  SELECT event_id, device_id, min(t) AS t FROM copies GROUP BY ALL
  UNION ALL
  SELECT c.event_id, c.device_id, min(x.t) FROM chain c JOIN copies x
    ON x.event_id = c.event_id AND x.t >= c.t + INTERVAL 24 HOUR
  GROUP BY ALL
)"""
define("realtime_dedup", "SELECT event_id, device_id, t AS ingested_at FROM chain", CHAIN, recursive=True)

LATEST = """edge AS (SELECT max(ingested_at) AS t FROM tele), latest AS (
  SELECT * FROM tele, edge WHERE ingested_at > t - INTERVAL 1 HOUR
  QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY {order} DESC, event_id DESC) = 1
)"""
STATE = "device_id, time AS timestamp, ingested_at, source, temperature, humidity, pressure, region"

define("latest_state", f"SELECT event_id, {STATE} FROM latest", LATEST.format(order="ingested_at"))
define("latest_state_by_event_time", f"SELECT {STATE} FROM latest", LATEST.format(order="time"))
define("devices_list", f"SELECT {STATE} FROM latest", LATEST.format(order="ingested_at"))
define("devices_count", "SELECT count(*) AS n FROM latest", LATEST.format(order="ingested_at"))
define("device_get", f"SELECT {STATE} FROM latest WHERE device_id = 'dev-0001'", LATEST.format(order="ingested_at"))
ORACLE["device_point_read"] = ORACLE["device_get"]
define(
    "device_board",
    f"""SELECT d.device_id, d.timestamp, x.tags,
       (SELECT arg_max(value, (ingested_at, event_id)) FROM long l WHERE l.device_id = d.device_id AND metric = 'temperature') AS temperature,
       (SELECT arg_max(value, (ingested_at, event_id)) FROM long l WHERE l.device_id = d.device_id AND metric = 'humidity') AS humidity,
       (SELECT arg_max(value, (ingested_at, event_id)) FROM long l WHERE l.device_id = d.device_id AND metric = 'pressure') AS pressure
FROM (SELECT device_id, arg_max(time, (ingested_at, event_id)) AS timestamp FROM tele GROUP BY 1) d
LEFT JOIN (SELECT device_id, {TAGS.format(sep=' · ')} AS tags FROM tele WHERE tagged
           QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY ingested_at DESC, event_id DESC) = 1) x
  ON x.device_id = d.device_id
ORDER BY d.device_id""",
)
define(
    "device_registry",
    """SELECT device_id, device_id AS name,
       arg_max(model, (time, event_id)) FILTER (model IS NOT NULL) AS model,
       arg_max(region, (time, event_id)) FILTER (region IS NOT NULL) AS region,
       min(time) AS first_seen, max(time) AS last_seen
FROM tele GROUP BY device_id""",
)
define(
    "active_devices",
    """SELECT count(DISTINCT device_id) AS n FROM tele
WHERE ingested_at > (SELECT max(ingested_at) FROM tele) - INTERVAL 1 HOUR""",
)
define(
    "live_feed",
    f"""SELECT event_id, device_id, time AS timestamp, temperature, humidity, pressure,
       CASE WHEN tagged THEN {TAGS.format(sep=',')} END AS tags FROM tele""",
)

SUBSCRIPTIONS = """log AS (
  SELECT 'client-' || lpad(CAST(user_id % 40 AS VARCHAR), 2, '0') AS client_id, id AS seq,
         event_type NOT IN ('purchase', 'error') AS wants,
         CASE WHEN k < 70 THEN '*' ELSE 'dev-' || lpad(CAST(k % 20 AS VARCHAR), 4, '0') END AS device_id
  FROM ev
), subscribed AS (
  SELECT client_id, device_id FROM (
    SELECT * FROM log UNION ALL SELECT DISTINCT client_id, -1, true, '*' FROM log
  ) GROUP BY client_id, device_id HAVING arg_max(wants, seq)
), everything AS (SELECT client_id FROM subscribed WHERE device_id = '*'),
members AS (
  SELECT device_id AS audience, client_id FROM subscribed
  WHERE device_id = '*' OR client_id NOT IN (SELECT client_id FROM everything)
), messages AS (
  SELECT event_id AS message_id, device_id, 'telemetry' AS type, time AS sent FROM tele
  UNION ALL
  SELECT alert_id, device_id, 'alert', triggered_at FROM fired
)"""
define("audience_members", "SELECT audience, client_id FROM members", FIRED, SUBSCRIPTIONS)
define(
    "live_fanout",
    """SELECT message_id, device_id, type, audience, n_clients, strftime(sent, '%Y-%m-%dT%H:%M:%S.%gZ') AS received_at
FROM messages JOIN (SELECT audience, count(*) AS n_clients FROM members GROUP BY 1)
  ON audience IN ('*', device_id)""",
    FIRED,
    SUBSCRIPTIONS,
)
define(
    "live_messages_sent",
    """SELECT type, CAST(sum(clients) AS BIGINT) AS n FROM (
  SELECT m.type, (SELECT count(DISTINCT client_id) FROM subscribed s WHERE s.device_id IN ('*', m.device_id)) AS clients
  FROM messages m
) GROUP BY type""",
    FIRED,
    SUBSCRIPTIONS,
)
define(
    "live_client_feed",
    """SELECT message_id, type, device_id FROM messages m
WHERE EXISTS (SELECT 1 FROM subscribed s WHERE s.client_id = 'client-07' AND s.device_id IN ('*', m.device_id))""",
    FIRED,
    SUBSCRIPTIONS,
)
# Who listens is asked for every pair of message and client: the connection, then `*` and the device within it.
CONNECTIONS = """client_log AS (
  SELECT 'client-' || lpad(CAST(user_id % 40 AS VARCHAR), 2, '0') AS client_id, id AS seq,
         TIMESTAMP '2024-01-01 00:00:00.5' + CAST(id AS INTEGER) * INTERVAL 1 SECOND AS made,
         CASE WHEN event_type = 'signup' AND k < 25 THEN 'connect' WHEN event_type = 'signup' AND k < 40 THEN 'disconnect'
              WHEN event_type IN ('purchase', 'error') THEN 'unsubscribe' ELSE 'subscribe' END AS action,
         CASE WHEN k % 3 = 0 THEN '*' ELSE 'dev-' || lpad(CAST(k % 20 AS VARCHAR), 4, '0') END AS device_id
  FROM ev
), marks AS (SELECT client_id, made, seq AS session, action AS mark FROM client_log WHERE action IN ('connect', 'disconnect')),
every AS (SELECT client_id, made, seq, action = 'subscribe' AS wants FROM client_log WHERE action LIKE '%subscribe' AND device_id = '*'),
single AS (SELECT client_id, device_id, made, seq, action = 'subscribe' AS wants FROM client_log WHERE action LIKE '%subscribe' AND device_id <> '*'),
pairs AS (
  SELECT m.message_id, m.type, m.device_id, date_trunc('millisecond', m.sent) AS sent, c.client_id
  FROM messages m, (SELECT DISTINCT client_id FROM client_log) c
), connected AS (
  SELECT p.*, k.session FROM pairs p ASOF JOIN marks k ON p.client_id = k.client_id AND p.sent >= k.made WHERE k.mark = 'connect'
), followed AS (
  SELECT c.*, CASE WHEN e.seq > c.session THEN e.wants ELSE true END AS has_every
  FROM connected c ASOF LEFT JOIN every e ON c.client_id = e.client_id AND c.sent >= e.made
), received AS (
  SELECT f.message_id, f.type, f.device_id, f.sent, f.client_id, CASE WHEN has_every THEN '*' ELSE f.device_id END AS audience
  FROM followed f ASOF LEFT JOIN single s ON f.client_id = s.client_id AND f.device_id = s.device_id AND f.sent >= s.made
  WHERE has_every OR (s.seq > f.session AND s.wants)
)"""
define(
    "live_fanout_asof",
    """SELECT message_id, device_id, type, audience, count(*) AS n_clients, strftime(sent, '%Y-%m-%dT%H:%M:%S.%gZ') AS received_at
FROM received GROUP BY ALL""",
    FIRED,
    SUBSCRIPTIONS,
    CONNECTIONS,
)
define(
    "live_client_feed_asof",
    "SELECT message_id, type, device_id, audience FROM received WHERE client_id = 'client-07'",
    FIRED,
    SUBSCRIPTIONS,
    CONNECTIONS,
)
define(
    "live_device_filter",
    "SELECT message_id, type, device_id FROM messages WHERE device_id = 'dev-0001'",
    FIRED,
    SUBSCRIPTIONS,
)

# --- external feeds ----------------------------------------------------------------------------


def values(rows) -> str:
    def literal(v) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


WEATHER = f"""cities(city, device_id, lat, lon, region) AS (VALUES {values(CITIES)}),
conditions(code, label) AS (VALUES {values(WEATHER_CONDITIONS.items())}),
asked AS (
  SELECT *, ['San Francisco','New York','London','Tokyo','Sydney','Dubai','Singapore','Berlin','Atlantis'][user_id % 9 + 1] AS city,
         [0, 3, 61, 95, 77, NULL][id % 6 + 1] AS code
  FROM ev WHERE id % 11 <> 0 AND (id % 7 = 0 OR id % 13 <> 0)
), weather AS (
  SELECT {uuid_v7('ts', 'device_id', "strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE rtrim('.' || strftime(ts, '%f'), '0') END")} AS event_id,
         c.device_id, CASE WHEN id % 7 = 0 THEN ts ELSE date_trunc('minute', ts) END AS timestamp, ts AS ingested_at,
         'city=' || c.city || ',condition=' || coalesce(label, 'Unknown') || ',lat=' || CAST(CAST(c.lat AS DOUBLE) AS VARCHAR)
           || ',lon=' || CAST(CAST(c.lon AS DOUBLE) AS VARCHAR) || ',region=' || c.region || ',source=open-meteo' AS tags,
         CASE WHEN event_type <> 'signup' THEN value END AS temperature, CAST(k AS DOUBLE) AS humidity,
         k // 4 + 0.25 AS wind_speed, CAST(a.code AS DOUBLE) AS weather_code, c.city, c.region,
         coalesce(label, 'Unknown') AS condition
  FROM asked a JOIN cities c ON a.city = c.city LEFT JOIN conditions x ON x.code = coalesce(a.code, 0)
)"""

AIR = f"""sites(location_id, city, country, lat, lon, device_id) AS (VALUES {values(AIR_QUALITY_SITES)}),
air AS (
  SELECT {uuid_v7('ts', 'device_id', "strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE rtrim('.' || strftime(ts, '%f'), '0') END")} AS event_id,
         s.device_id,
         CASE WHEN id % 2 = 0 THEN TIMESTAMP '2023-12-31 23:00:00' ELSE date_trunc('second', ts) END AS timestamp,
         ts AS ingested_at,
         'city=' || s.city || ',country=' || s.country || ',lat=' || CAST(CAST(s.lat AS DOUBLE) AS VARCHAR) || ',lon='
           || CAST(CAST(s.lon AS DOUBLE) AS VARCHAR) || ',region=unknown,source=openaq' AS tags,
         CASE WHEN id % 2 = 0 THEN CAST(k AS DOUBLE) ELSE value END AS pm25, CAST(k AS DOUBLE) AS o3
  FROM ev JOIN sites s ON s.location_id = ['2178', '8118', '155', '2473', '9999'][user_id % 5 + 1]
  WHERE id % 11 > 1
)"""

define(
    "weather_normalize",
    """SELECT event_id, device_id, timestamp, ingested_at, '1.0' AS schema_version, 'http' AS source, tags,
       coalesce(temperature, 0) AS temperature, humidity, CAST(wind_speed AS DOUBLE) AS wind_speed,
       coalesce(weather_code, 0) AS weather_code, CAST(4 AS BIGINT) AS n_metrics FROM weather""",
    WEATHER,
)
define(
    "weather_missing_as_null",
    """SELECT event_id, temperature, humidity, weather_code,
       CAST(2 + (temperature IS NOT NULL)::INT + (weather_code IS NOT NULL)::INT AS BIGINT) AS n_metrics FROM weather""",
    WEATHER,
)
define(
    "aq_normalize",
    """SELECT event_id, device_id, timestamp, ingested_at, '1.0' AS schema_version, 'http' AS source, tags, pm25, o3,
       CAST(2 AS BIGINT) AS n_metrics FROM air""",
    AIR,
)
define(
    "external_events",
    """SELECT event_id, device_id, timestamp, ingested_at, '1.0' AS schema_version, 'http' AS source, tags,
       coalesce(temperature, 0) AS temperature, humidity, CAST(wind_speed AS DOUBLE) AS wind_speed,
       coalesce(weather_code, 0) AS weather_code, CAST(NULL AS DOUBLE) AS pm25, CAST(NULL AS DOUBLE) AS o3,
       CAST(4 AS BIGINT) AS n_metrics FROM weather
UNION ALL
SELECT event_id, device_id, timestamp, ingested_at, '1.0', 'http', tags, NULL, NULL, NULL, NULL, pm25, o3, 2 FROM air""",
    WEATHER,
    AIR,
)
define(
    "weather_board",
    f"""SELECT device_id, city, {fixed('coalesce(temperature, 0)', 1)} AS temperature, condition, humidity,
       {fixed('CAST(wind_speed AS DOUBLE)', 1)} AS wind_speed, region, timestamp
FROM weather
QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY ingested_at DESC, event_id DESC) = 1""",
    WEATHER,
)

# --- counters, histograms, lag -------------------------------------------------------------------

define(
    "pipeline_counters",
    """SELECT 'ingest_events_total' AS name, 'source=http,status=' || CASE WHEN id % 10 IN (0, 1, 8, 9) THEN 'ok' ELSE 'invalid' END
  AS labels, count(*) AS value FROM ev GROUP BY 2
UNION ALL
SELECT 'ingest_events_total', 'source=mqtt,status=' || CASE WHEN id % 20 BETWEEN 3 AND 6 OR id % 20 > 10 THEN 'ok' ELSE 'invalid' END,
  count(*) FROM ev GROUP BY 2
UNION ALL
SELECT 'processor_events_processed_total', 'status=ok', count(*) FROM chain
UNION ALL
SELECT 'processor_duplicates_total', '', (SELECT count(*) FROM copies) - (SELECT count(*) FROM chain)
UNION ALL
SELECT 'processor_dlq_total', 'reason=' || status, count(*) FROM status WHERE status LIKE '%invalid%' GROUP BY status
UNION ALL
SELECT 'batch_events_invalid_total', 'reason=' || status, count(*) FROM status WHERE status LIKE '%invalid%' GROUP BY status
UNION ALL
SELECT unnest(['batch_events_inserted_total', 'archive_events_buffered_total']), '', count(*) FROM status WHERE status = 'ok'
UNION ALL
SELECT 'silver_events_in_total', '', events_in FROM totals
UNION ALL
SELECT 'silver_events_out_total', '', events_out FROM totals
UNION ALL
SELECT 'silver_duplicates_removed_total', '', events_in - events_out FROM totals
UNION ALL
SELECT 'processor_alerts_fired_total', 'severity=' || severity, count(*) FROM fired GROUP BY severity
UNION ALL
SELECT 'processor_anomalies_detected_total', 'metric=' || metric, count(*) FROM judged WHERE z_score > 3 GROUP BY metric""",
    STATUS,
    CHAIN,
    REFINED,
    TOTALS,
    FIRED,
    SCORED,
    recursive=True,
)
define(
    "latency_histogram",
    """SELECT source, le, round(sum + 1e-9, 6) AS sum, count, n FROM (
  SELECT source, sum(s) AS sum, count(s) AS count, le, count(*) FILTER (s <= CAST(replace(le, '+Inf', 'Infinity') AS DOUBLE)) AS n
  FROM (SELECT source, date_diff('millisecond', timestamp, ingested_at) / 1000 AS s FROM wide),
       (SELECT unnest(['0.001', '0.005', '0.01', '0.025', '0.05', '0.1', '0.25', '0.5', '1', '2.5', '+Inf']) AS le)
  GROUP BY source, le
)""",
)
define(
    "consumer_lag",
    """SELECT 'batch' AS "group", 'telemetry.raw' AS topic, CAST(id % 8 AS INTEGER) AS partition,
       CAST(greatest(0, CASE WHEN id % 8 = 5 THEN 0 ELSE max(id) + 1 END
         - greatest(0, coalesce(max(id) FILTER (event_type = 'error' AND id % 8 <> 3) + 1, -1))) AS BIGINT) AS lag
FROM ev GROUP BY id % 8""",
)

# --- streams and file sinks: the same rows as the batch operators ----------------------------------

define(
    "src_event_log",
    """SELECT dev AS key, r.value, CAST(r.id % 8 AS INTEGER) AS partition, r.id AS "offset", r.ts AS timestamp
FROM raw r JOIN ev ON ev.id = r.id""",
    STATUS,
    RAW,
)
define(
    "sink_event_log",
    f"""SELECT dev AS key, 'ok' AS status, {uuid_v7('ts', 'id', '0')} AS event_id, value AS temperature, 'http' AS source
FROM ev WHERE id % 10 IN (0, 1, 8, 9)""",
)
define("sink_alerts", f"SELECT device_id AS key, {ALERT} FROM fired", FIRED)
define("realtime_alerts", f"SELECT device_id AS key, {ALERT} FROM every_alert", FIRED, SCORED, ODD)
define(
    "realtime_alert_table",
    f"SELECT {ALERT}, false AS acknowledged, CAST(triggered_at AS DATE) AS event_date FROM every_alert",
    FIRED,
    SCORED,
    ODD,
)
define(
    "realtime_alert_snapshots",
    f"""SELECT {ALERT}, false AS acknowledged, CAST(triggered_at AS DATE) AS event_date, count(*) OVER (PARTITION BY device_id) AS n_live
FROM every_alert""",
    FIRED,
    SCORED,
    ODD,
)
ORACLE["dlq_stream"] = ORACLE["dlq_rows"]
define(
    "telemetry_stream",
    """SELECT uuid AS event_id, dev AS device_id, date_trunc('millisecond', ts) AS time,
       date_trunc('millisecond', ts) AS ingested_at, CAST(ts AS DATE) AS event_date,
       'http' AS source, value AS temperature, CAST(0 AS BIGINT) AS n_tags FROM status WHERE status = 'ok'""",
    STATUS,
)
define(
    "bronze_stream",
    """SELECT uuid AS event_id, dev AS device_id, date_trunc('millisecond', ts) AS timestamp,
       date_trunc('millisecond', ts) AS ingested_at, value AS temperature,
       CAST(NULL AS DOUBLE) AS humidity, CAST(NULL AS VARCHAR) AS region,
       '2024' AS year, '02' AS month, '03' AS day, '04' AS hour FROM status WHERE status = 'ok'""",
    STATUS,
)
ORACLE["silver_write"] = ORACLE["silver"]
define(
    "silver_stream",
    "SELECT * FROM refined",
    """corrected AS (
  SELECT * EXCLUDE (id, dense_ts, dense_ingested_at) FROM wide
  UNION ALL
  SELECT * EXCLUDE (id, dense_ts, dense_ingested_at)
    REPLACE (ingested_at + INTERVAL 1 HOUR AS ingested_at, timestamp + INTERVAL 1 DAY AS timestamp, temperature + 5 AS temperature)
  FROM wide WHERE id % 10 = 0
)""",
    REFINED.replace("FROM bronze WHERE", "FROM corrected WHERE", 1),
)
ORACLE["describe_table"] = (
    "SELECT column_name, CAST(row_number() OVER (ORDER BY column_index) - 1 AS BIGINT) AS position, "
    "CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
    "ELSE lower(data_type) END AS column_type "
    "FROM duckdb_columns() WHERE table_name = 'lineitem'"
)
ORACLE["rollup_stream"] = ORACLE["rollup_1m"]
ORACLE["rollup_5m_stream"] = ORACLE["rollup_5m"]
define(
    "aggregates_stream",
    f"SELECT device_id AS key, {M1_COLUMNS} FROM m1, closed WHERE m1.bucket + INTERVAL 1 MINUTE <= mark",
    minute(),
    "closed AS (SELECT max(time) - INTERVAL 10 MINUTE AS mark FROM tele)",
)
ORACLE["telemetry_table"] = ORACLE["telemetry_stream"]
ORACLE["silver_runs"] = ORACLE["silver_stream"]
define(
    "job_counters",
    """SELECT 'processor_events_processed_total' AS name, 'status=ok' AS labels, count(*) AS value FROM status WHERE status = 'ok'
UNION ALL SELECT 'processor_duplicates_total', '', count(*) FROM status WHERE status = 'ok' AND id % 10 = 9
UNION ALL SELECT unnest(['processor_dlq_total', 'batch_events_invalid_total']), 'reason=' || status, count(*)
  FROM status WHERE status LIKE '%invalid%' GROUP BY status
UNION ALL SELECT 'batch_events_inserted_total', '', CAST(sum(CASE WHEN id % 10 = 9 THEN 2 ELSE 1 END) AS BIGINT) FROM status WHERE status = 'ok'
UNION ALL SELECT 'processor_alerts_fired_total', 'severity=' || severity, count(*)
  FROM status JOIN ev USING (id), (SELECT unnest(['warning', 'critical']) AS severity, unnest([30, 40]) AS bound)
  WHERE status = 'ok' AND ev.value > bound GROUP BY severity""",
    STATUS,
)
_BOUNDS = {
    "processor_event_duration_seconds": (100, "0.001 0.005 0.01 0.025 0.05 0.1 0.25 0.5"),
    "batch_flush_duration_seconds": (10000, "0.0001 0.0005 0.001 0.005 0.01"),
    "archive_flush_duration_seconds": (8, "0.1 0.5 1 2 5 10"),
    "silver_transform_duration_seconds": (1, "0.5 1 2 5 10 30 60"),
}
_UNITS = ", ".join(f"('{name}', {unit}, '{bounds} +Inf count sum')" for name, (unit, bounds) in _BOUNDS.items())
define(
    "duration_histograms",
    """SELECT name, le, round(sum(CASE WHEN le = 'sum' THEN s * w WHEN le IN ('+Inf', 'count') OR s <= TRY_CAST(le AS DOUBLE) THEN w ELSE 0 END) + 1e-9, 6)
  AS value
FROM (SELECT name, unnest(string_split(bounds, ' ')) AS le, k / unit::DOUBLE AS s, (id % 3 + 1)::DOUBLE AS w FROM ev, units)
GROUP BY name, le""",
    f"units(name, unit, bounds) AS (VALUES {_UNITS})",
)
ORACLE["device_board_stream"] = ORACLE["device_board"]
ORACLE["realtime_dedup_stream"] = ORACLE["realtime_dedup"]
ORACLE["alert_cooldown_stream"] = ORACLE["alert_cooldown"]
define(
    "latest_state_stream",
    f"""SELECT event_id, {STATE.replace('ingested_at', 'ingested_at + (CASE id % 5 WHEN 1 THEN 2190 WHEN 2 THEN -365 ELSE 0 END) * INTERVAL 1 DAY AS ingested_at')}
FROM latest""",
    LATEST.format(order="ingested_at"),
)
ORACLE["anomaly_stream"] = ORACLE["anomaly_zscore"]

import random
from datetime import datetime, timedelta
from decimal import Decimal, ROUND_HALF_UP

import pytest
from pyspark.sql import functions as F

from conftest import frame, values
from tidewire.functions.numbers import to_fixed
from tidewire.operators import alerts, dedup, external, fanout, history, quality, rollup, silver, state
from tidewire import session
from tidewire.operators import joins, spacing
from tidewire.operators.spacing import keep_spaced

T0 = datetime(2024, 1, 1)


def seconds(n):
    return T0 + timedelta(seconds=n)


# --- silver --------------------------------------------------------------------------------------


def test_categories_at_their_bounds(spark):
    temps = {None: "unknown", 14.99: "low", 15.0: "normal", 29.99: "normal", 30.0: "high", 39.99: "high", 40.0: "critical"}
    rows = frame(spark, [(t,) for t in temps], "t double").select("t", silver.temp_category(F.col("t")).alias("c"))
    assert {r["t"]: r["c"] for r in rows.collect()} == temps


def test_zones_at_their_bounds(spark):
    zones = [
        (66.6, "arctic"), (60.01, "arctic"), (60.0, "northern-temperate"), (23.5, "northern-temperate"),
        (23.49, "tropical"), (0.0, "tropical"), (-23.5, "southern-temperate"), (-60.0, "southern-temperate"),
        (-60.01, "antarctic"), (None, "unknown"),
    ]
    rows = frame(spark, zones, "lat double, expected string")
    assert rows.filter(silver.climate_zone(F.col("lat"), F.lit(1.0)) != F.col("expected")).collect() == []
    assert rows.select(silver.climate_zone(F.col("lat"), F.lit(None).cast("double"))).distinct().collect()[0][0] == "unknown"


def test_hemispheres(spark):
    rows = frame(spark, [(0.1, "northern"), (0.0, "equatorial"), (-0.1, "southern"), (None, "equatorial")], "lat double, e string")
    assert rows.filter(silver.hemisphere(F.col("lat")) != F.col("e")).collect() == []


BRONZE = (
    "event_id string, device_id string, timestamp timestamp, ingested_at timestamp, source string, "
    "temperature double, humidity double, pressure double, region string, model string, lat double, lon double"
)


def bronze(spark, rows):
    full = [(e, d, t, i, "http", temp, None, None, None, None, None, None) for e, d, t, i, temp in rows]
    return frame(spark, full, BRONZE)


def test_latest_ingestion_wins_and_ties_are_stable(spark):
    rows = [
        ("a", "d", T0, seconds(1), 1.0), ("a", "d", T0, seconds(2), 2.0),
        ("b", "d", T0, seconds(1), 1.0), ("b", "d", T0, seconds(1), 9.0),
        ("c", None, T0, seconds(1), 1.0), ("e", "d", None, seconds(1), 1.0), (None, "d", T0, seconds(1), 1.0),
    ]
    assert values(silver.silver(bronze(spark, rows)), "event_id", "temperature") == [("a", 2.0), ("b", 9.0)]


def test_latency_counts_millisecond_boundaries(spark):
    rows = [("a", "d", T0 + timedelta(microseconds=900), T0 + timedelta(microseconds=1100), None),
            ("b", "d", seconds(1), T0, None)]
    assert values(silver.silver(bronze(spark, rows)), "event_id", "ingest_latency_ms") == [("a", 1), ("b", -1000)]


def test_hot_event_is_cut_down_before_the_shuffle(spark):
    rows = bronze(spark, [("a", "d", T0, seconds(1), 1.0)])
    plan = silver.silver(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# --- spacing ---------------------------------------------------------------------------------------


def spaced_reference(rows, gap):
    kept, last = [], {}
    for key, t in sorted(rows):
        if key not in last or t >= last[key] + gap:
            kept.append((key, t))
            last[key] = t
    return sorted(kept)


@pytest.mark.parametrize("fold_limit", [2_000, 5])
@pytest.mark.parametrize("gap", [1, 90, 600])
def test_spacing_equals_the_sequential_rule(spark, fold_limit, gap):
    rng = random.Random(gap)
    rows = [("hot", rng.randrange(0, 4000)) for _ in range(400)]
    rows += [(f"k{rng.randrange(20)}", rng.randrange(0, 4000)) for _ in range(200)]
    rows += [("gaps", t) for t in (0, 1, 2, 1500, 1501, 3999)] + [("one", 7)]
    data = frame(spark, [(k, seconds(t), f"{i:04d}") for i, (k, t) in enumerate(rows)], "k string, t timestamp, i string")
    kept = keep_spaced(data, ["k"], "t", gap, ["i"], fold_limit=fold_limit)
    assert sorted((r["k"], int((r["t"] - T0).total_seconds())) for r in kept.collect()) == spaced_reference(rows, gap)


def test_hot_key_without_broadcasts(spark, monkeypatch):
    plans = {}

    def recording(df, name="stage"):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return session.cut_lineage(df, name)

    monkeypatch.setattr(spacing, "fits", lambda _: False)
    monkeypatch.setattr(spacing, "cut_lineage", recording)
    rng = random.Random(11)
    rows = [("hot" if i % 3 else f"k{i % 50}", rng.randrange(0, 9000)) for i in range(1500)]
    data = frame(spark, [(k, seconds(t), f"{i:04d}") for i, (k, t) in enumerate(rows)], "k string, t timestamp, i string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = keep_spaced(data, ["k"], "t", 60, ["i"], fold_limit=50).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r["k"], int((r["t"] - T0).total_seconds())) for r in kept) == spaced_reference(rows, 60)
    # AQE splits a skewed join only where nothing above it needs the key's rows together.
    assert "Join" in plans["candidates"] and "Aggregate" not in plans["candidates"]


def test_processed_mark_expires_after_a_day(spark):
    hour = 3600
    arrivals = [0, 23 * hour + 3540, 24 * hour, 25 * hour, 48 * hour]
    rows = frame(spark, [("e", "d", "http", seconds(a)) for a in arrivals], "event_id string, device_id string, source string, ingested_at timestamp")
    kept = [r[0] for r in dedup.realtime_dedup(rows).select("ingested_at").collect()]
    assert sorted(kept) == [seconds(0), seconds(24 * hour), seconds(48 * hour)]


def test_dedup_is_idempotent(spark):
    rows = frame(spark, [("e", "d", "http", seconds(a)) for a in (0, 1, 2, 90_000)], "event_id string, device_id string, source string, ingested_at timestamp")
    once = dedup.realtime_dedup(rows)
    assert values(dedup.realtime_dedup(once)) == values(once)


# --- rules and alerts --------------------------------------------------------------------------------


def readings(spark, rows):
    return frame(
        spark,
        [(f"e{i}", d, seconds(i), m) for i, (d, m) in enumerate(rows)],
        "event_id string, device_id string, ingested_at timestamp, metrics map<string,double>",
    )


def test_rules_at_their_thresholds(spark):
    rows = readings(spark, [
        ("a", {"temperature": 30.0}), ("b", {"temperature": 30.01}), ("c", {"temperature": 40.0}),
        ("d", {"temperature": 40.01}), ("e", {"humidity": 20.0}), ("f", {"humidity": 19.99}),
        ("g", {"pressure": 1000.0}), ("h", {"pressure": 999.99}), ("i", {}), ("j", {"other": 99.0}),
    ])
    assert values(alerts.alerts_rules(rows), "device_id", "rule_id") == [
        ("b", "temp-high"), ("c", "temp-high"), ("d", "temp-critical"), ("d", "temp-high"),
        ("f", "humidity-low"), ("h", "pressure-drop"),
    ]


@pytest.mark.parametrize("limit, heavy", [(joins.BROADCAST_ROWS, 1), (0, 1), (0, 100)])
def test_device_rules_with_broadcast_and_with_salt(spark, limit, heavy, monkeypatch):
    monkeypatch.setattr(joins, "fits", lambda dim, _=None: dim.count() <= limit)
    monkeypatch.setattr(joins, "HEAVY_ROWS", heavy)
    rules = alerts.rules_frame(spark, [
        ("all", "*", "t", ">=", 5.0, "info", "m"), ("mine", "a", "t", "<=", 5.0, "info", "m"),
        ("glob", "a*", "t", ">", 0.0, "info", "m"),
    ])
    rows = readings(spark, [("a", {"t": 5.0}), ("a", {"t": 4.0}), ("ab", {"t": 5.0}), ("b", {"t": 4.0})])
    fired = alerts.alerts_rules(rows, rules)
    assert values(fired, "device_id", "rule_id", "value") == [
        ("a", "all", 5.0), ("a", "mine", 4.0), ("a", "mine", 5.0), ("ab", "all", 5.0)
    ]


def test_alert_ids_repeat_on_rerun_and_are_version_7(spark):
    rows = readings(spark, [("a", {"temperature": 45.0})])
    first, second = (values(alerts.alerts_rules(rows), "alert_id") for _ in range(2))
    assert first == second and len(set(first)) == 2
    for (alert_id,) in first:
        assert alert_id[14] == "7" and alert_id[19] in "89ab" and len(alert_id) == 36


def test_fixed_point_text(spark):
    rng = random.Random(1)
    xs = [1.005, 0.125, 2.5, 1.45, -1.005, 0.995, 9.995, 99.999, 0.0, 1e9 + 0.125, 0.005, 123456.785]
    xs += [rng.uniform(-1000, 1000) for _ in range(300)] + [round(rng.uniform(0, 99), 3) for _ in range(300)]
    rows = frame(spark, [(x,) for x in xs], "x double")
    for digits in (1, 2):
        got = rows.select("x", to_fixed(F.col("x"), digits).alias("s")).collect()
        step = Decimal(1).scaleb(-digits)
        for r in got:
            exact = abs(Decimal(r["x"])).quantize(step, rounding=ROUND_HALF_UP)
            assert r["s"] == ("-" if r["x"] < 0 else "") + str(exact), r


# --- rollups and history -----------------------------------------------------------------------------


def telemetry(spark, rows):
    return frame(
        spark,
        [(t, d, f"e{i}", m) for i, (t, d, m) in enumerate(rows)],
        "time timestamp, device_id string, event_id string, metrics map<string,double>",
    )


def test_rollup_invariants(spark):
    rng = random.Random(3)
    rows = [(seconds(rng.randrange(0, 7200)), f"d{rng.randrange(3)}", {"temperature": rng.uniform(0, 50)} if rng.random() < 0.8 else {}) for _ in range(500)]
    one = rollup.rollup_1m(telemetry(spark, rows))
    frames = [one, rollup.rollup_from_1m(one, "5m"), rollup.rollup_from_1m(one, "1h")]
    assert {f.agg(F.sum("sample_count")).first()[0] for f in frames} == {500}
    for f in frames:
        bad = f.filter("avg_temperature < min_temperature - 1e-9 OR avg_temperature > max_temperature + 1e-9")
        assert bad.count() == 0


def test_plain_and_weighted_hourly_average(spark):
    rows = [(seconds(0), "d", {"temperature": 10.0})] + [(seconds(60 + i), "d", {"temperature": 20.0}) for i in range(3)]
    one = rollup.rollup_1m(telemetry(spark, rows), sums=True)
    assert rollup.rollup_from_1m(one, "1h").first()["avg_temperature"] == 15.0
    assert rollup.weighted_from_1m(one, "1h").first()["avg_temperature"] == 17.5


def test_redelivered_rows_count_unless_removed(spark):
    rows = telemetry(spark, [(T0, "d", {"temperature": 1.0})])
    twice = rows.unionByName(rows)
    assert rollup.rollup_1m(twice).first()["sample_count"] == 2
    assert rollup.rollup_1m(rollup.one_row_per_event(twice)).first()["sample_count"] == 1


def test_refresh_windows_hold_whole_buckets():
    as_of = datetime(2024, 1, 1, 12, 0, 30)
    assert rollup.POLICIES["1m"].window(as_of) == (datetime(2024, 1, 1, 9, 1), datetime(2024, 1, 1, 11, 59))
    assert rollup.POLICIES["1h"].window(as_of) == (datetime(2023, 12, 25, 13), datetime(2024, 1, 1, 11))


def test_retention_drops_whole_days(spark):
    rows = telemetry(spark, [(datetime(2024, 1, d, 12), "d", {}) for d in range(1, 11)])
    kept = rollup.retention_keep(rows, datetime(2024, 2, 4, 18), days=30)
    assert sorted(r["time"].day for r in kept.collect()) == [5, 6, 7, 8, 9, 10]


def test_history_limits():
    assert [history.history_limit(x) for x in (None, 0, 5, 20_000, "7abc", "abc", "")] == [1000, 1000, 5, 10_000, 7, 1000, 1000]
    with pytest.raises(ValueError):
        history.history_limit(-1)


def test_history_range_is_closed(spark):
    rows = telemetry(spark, [(seconds(s), "d", {"temperature": float(s)}) for s in range(5)])
    got = history.history_raw(rows, "d", seconds(1), seconds(3))
    assert [r["temperature"] for r in got.collect()] == [1.0, 2.0, 3.0]


def test_history_defaults_and_errors(spark):
    now = datetime(2024, 1, 2)
    assert history.history_range(now, end=datetime(2024, 1, 1)) == (now - timedelta(hours=1), datetime(2024, 1, 1))
    with pytest.raises(ValueError):
        history.history_range(now, start="yesterday")
    with pytest.raises(ValueError):
        history.history({}, "d", now, interval="2h")


# --- state, devices, live feed -------------------------------------------------------------------------


EVENT = (
    "event_id string, device_id string, timestamp timestamp, ingested_at timestamp, metrics map<string,double>, "
    "tags map<string,string>, source string"
)


def test_state_follows_arrival_and_expires(spark):
    rows = [
        ("1", "a", seconds(500), seconds(1000), {"t": 1.0}, None, "http"),
        ("2", "a", seconds(100), seconds(1001), {"t": 2.0}, None, "http"),
        ("3", "b", seconds(0), seconds(60), {}, None, "http"),
    ]
    events = frame(spark, rows, EVENT)
    as_of = seconds(60 + 59 * 60)
    assert values(state.latest_state(events, as_of), "device_id", "event_id") == [("a", "2"), ("b", "3")]
    assert values(state.latest_state(events, as_of, by="event_time"), "device_id", "event_id") == [("a", "1"), ("b", "3")]
    assert values(state.latest_state(events, seconds(60 + 61 * 60)), "device_id") == [("a",)]
    assert state.device_get(state.latest_state(events, as_of), "nobody").count() == 0


def test_board_merges_metrics_and_keeps_tags(spark):
    rows = [
        ("1", "a", seconds(1), seconds(1), {"t": 1.0, "h": 5.0}, {"r": "x"}, "http"),
        ("2", "a", seconds(2), seconds(2), {"t": 2.0}, None, "http"),
        ("3", "a", seconds(3), seconds(3), {}, None, "http"),
    ]
    board = state.device_board(frame(spark, rows, EVENT)).first()
    assert board["metrics"] == {"h": 5.0, "t": 2.0} and board["tags"] == {"r": "x"}
    assert board["timestamp"] == seconds(3)


@pytest.mark.parametrize("limit, heavy", [(joins.BROADCAST_ROWS, 30), (0, 30), (0, 1_000)])
def test_each_client_gets_each_message_once(spark, limit, heavy, monkeypatch):
    monkeypatch.setattr(joins, "fits", lambda dim, _=None: dim.count() <= limit)
    monkeypatch.setattr(joins, "HEAVY_ROWS", heavy)
    rng = random.Random(5)
    clients, devices = [f"c{i}" for i in range(6)], ["d1", "d2", "d3"]
    log = [(rng.choice(clients), i, rng.choice(["subscribe", "unsubscribe"]), rng.choice(["*"] * 3 + devices)) for i in range(80)]
    subs = {c: {"*"} for c in clients}
    for client, _, action, device in log:
        (subs[client].add if action == "subscribe" else subs[client].discard)(device)
    messages = [(f"m{i}", rng.choice([*devices, None]), rng.choice(["telemetry", "alert"])) for i in range(40)]
    members = fanout.audience_members(
        frame(spark, log, "client_id string, seq bigint, action string, device_id string"),
        frame(spark, [(c,) for c in clients], "client_id string"),
    )
    routed = fanout.live_fanout(frame(spark, messages, "message_id string, device_id string, type string"), members)
    expected = {c: sorted(m for m, d, _ in messages if "*" in subs[c] or (d and d in subs[c])) for c in clients}
    for c in clients:
        assert sorted(r["message_id"] for r in fanout.client_feed(routed, members, c).collect()) == expected[c]
    sent = {r["type"]: r["n"] for r in fanout.messages_sent(routed).collect()}
    assert sum(sent.values()) == sum(len(v) for v in expected.values())


# --- external feeds, lag, files ------------------------------------------------------------------------


def test_weather_conditions_and_sites():
    assert len(external.CITIES) == 8 and len(external.AIR_QUALITY_SITES) == 4
    assert len(external.WEATHER_CONDITIONS) == 21


def test_lag_is_clamped(spark):
    committed = frame(spark, [("g", "t", 0, 5), ("g", "t", 1, 9), ("g", "t", 2, -1), ("g", "t", 3, 4)], "group string, topic string, partition int, committed bigint")
    latest = frame(spark, [("t", 0, 8), ("t", 1, 7), ("t", 2, 3), ("other", 3, 99)], "topic string, partition int, latest bigint")
    assert values(quality.consumer_lag(committed, latest), "partition", "lag") == [(0, 3), (1, 0), (2, 3), (3, 0)]


def test_pending_files_and_manifest(spark):
    listing = frame(spark, [(f"f{i:02d}.parquet",) for i in range(60)] + [("x.tmp",)], "path string")
    done = frame(spark, [(f"f{i:02d}.parquet", seconds(i)) for i in range(5)], "path string, processed_at timestamp")
    assert [r["path"] for r in quality.pending_files(listing, done).collect()] == [f"f{i:02d}.parquet" for i in range(5, 55)]
    assert values(quality.manifest_compact(done, 2), "path") == [("f03.parquet",), ("f04.parquet",)]


def test_rate_limit_counts_the_excess(spark):
    rows = frame(spark, [("a", seconds(i % 60)) for i in range(1005)] + [("a", seconds(61)), ("b", T0)], "key string, t timestamp")
    assert values(quality.rate_limit_audit(rows, "key", "t"), "key", "requests", "rejected") == [("a", 1, 0), ("a", 1005, 5), ("b", 1, 0)]


def test_rate_windows_start_with_a_request(spark):
    rows = frame(spark, [("a", seconds(30 + i / 20)) for i in range(1200)], "key string, t timestamp")
    # Over the minute's edge: one window of the key, two of the clock.
    assert values(quality.rate_limit_audit(rows, "key", "t"), "requests", "rejected") == [(1200, 200)]
    assert values(quality.rate_limit_by_clock(rows, "key", "t"), "requests", "rejected") == [(600, 0), (600, 0)]


def test_rate_windows_of_a_busy_key(spark):
    rng = random.Random(6)
    rows = [("hot", seconds(rng.randrange(400_000) / 2)) for _ in range(9_000)] + [("cold", seconds(i * 59)) for i in range(7)]
    rows += [(None, seconds(1)), ("hot", None)]
    want = {}
    for key in ("hot", "cold"):
        start = None
        for t in sorted(t for k, t in rows if k == key and t):
            if start is None or t >= start + timedelta(seconds=60):
                start = t
            want[key, start] = want.get((key, start), 0) + 1
    found = quality.rate_limit_audit(frame(spark, rows, "key string, t timestamp"), "key", "t", limit=2).collect()
    assert {(r.key, r.window_start): (r.requests, r.rejected) for r in found} == {k: (n, max(0, n - 2)) for k, n in want.items()}


def test_offsets_up_to_a_day(spark):
    from tidewire.functions.checks import instant_text

    cases = {
        "2024-01-01T00:00:00+19:00": datetime(2023, 12, 31, 5), "2024-01-01T00:00:00.5-2330": datetime(2024, 1, 1, 23, 30, 0, 500_000),
        "2024-01-01T00:00:00+23:00": datetime(2023, 12, 31, 1), "2024-01-01T00:00:00+05:30": datetime(2023, 12, 31, 18, 30),
        "2024-01-01T00:00:00-18:00": datetime(2024, 1, 1, 18), "2024-01-01T00:00:00+24:00": None,
        "2024-02-30T00:00:00+19:00": None, "2024-01-01T00:00:00+19:60": None,
    }
    rows = frame(spark, [(t,) for t in cases], "t string").select("t", instant_text(F.col("t")).alias("at"))
    assert {r["t"]: r["at"] for r in rows.collect()} == cases


def test_weather_codes_and_minutes_with_offset(spark):
    from tidewire.operators import external
    from tidewire.schemas import WEATHER_RESPONSE
    from tidewire.sources import landed

    current = ('"weather_code":61.0', '"weather_code":61', '"weather_code":61.5', '"time":"2024-01-01T00:00+01:00"')
    rows = [('{"city":"London","current":{%s}}' % c, seconds(i)) for i, c in enumerate(current)]
    parsed = landed.parse_responses(frame(spark, rows, "response string, received_at timestamp"), WEATHER_RESPONSE)
    found = external.weather_normalize(parsed).orderBy("ingested_at").collect()
    assert [r["tags"]["condition"] for r in found] == ["Light Rain", "Light Rain", "Unknown", "Clear"]
    assert [r["metrics"]["weather_code"] for r in found] == [61.0, 61.0, 61.5, 0.0]
    assert found[3]["timestamp"] == datetime(2023, 12, 31, 23)


def test_scratch_tables_can_be_dropped(spark):
    from pathlib import Path

    from tidewire.session import cut_lineage, drop_scratch, shared_dir

    assert cut_lineage(spark.range(3)).count() == 3
    folder = Path(shared_dir(spark).removeprefix("file:")) / spark.sparkContext.applicationId
    assert folder.is_dir()
    drop_scratch(spark)
    assert not folder.exists()

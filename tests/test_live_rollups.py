"""Rollups of a stream: late rows, days that close, triggers that are repeated."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewire.operators import rollup
from tidewire.sources import tables
from tidewire.streaming import jobs, rollups

T0 = datetime(2024, 1, 1, 20)
ROW = "time timestamp, device_id string, event_id string, metrics map<string,double>, tags map<string,string>, source string, ingested_at timestamp"


def made(n=900, hours=14):
    """Rows in order of arrival, many of them late by up to six hours."""
    rng = random.Random(9)
    rows = []
    for i in range(n):
        arrived = T0 + timedelta(seconds=i * hours * 3600 / n)
        late = timedelta(minutes=rng.choice([0, 0, 0, 2, 40, 170, 190, 360]))
        metrics = {"temperature": rng.randrange(400) / 8, "humidity": float(rng.randrange(90))} if i % 5 else {"pressure": 1000.0 + i}
        rows.append((arrived - late, f"dev-{rng.randrange(4)}", f"e{i}", metrics, None, "http", arrived))
    return rows


def triggers(rows, size=100):
    return [rows[i : i + size] for i in range(0, len(rows), size)]


def entered(parts):
    """The rows that are in reach of the minute's refresh at their trigger."""
    out, clock = [], None
    for part in parts:
        clock = max([clock or datetime.min, *[r[-1] for r in part]])
        first, _ = rollup.POLICIES["1m"].window(clock)
        out += [r for r in part if r[0] >= first]
    return out


def same(spark, path, rows):
    telemetry = spark.createDataFrame(rows, ROW)
    minutes = rollup.rollup_1m(telemetry)
    for interval in rollups.INTERVALS:
        want = minutes if interval == "1m" else rollup.rollup_from_1m(minutes, interval)
        got = rollups.read_rollups(spark, path, interval).drop("event_date")
        key = lambda frame, like=want: sorted(
            repr(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in frame.select(*like.columns).collect()
        )
        assert key(got) == key(want)


def test_late_rows_enter_within_reach_and_days_close(spark, tmp_path):
    path, parts = str(tmp_path / "rollups"), triggers(made())
    for n, part in enumerate(parts):
        rollups.add_trigger(spark.createDataFrame(part, ROW), path, n, "ingested_at", compact_every=3)
        if n in (0, 4):
            same(spark, path, entered(parts[: n + 1]))
    kept = entered(parts)
    assert len(kept) < len(made())
    same(spark, path, kept)
    # The first day is closed and stored by day; what made it is gone.
    _, first_open = rollups.open_partials(spark, path)
    assert first_open == datetime(2024, 1, 2).date()
    assert tables.read_rollup(spark, f"{path}/closed/1m").filter(F.col("event_date") == "2024-01-01").count() > 0
    assert min(tables.numbered(spark, f"{path}/open", "version")) == 3
    late = spark.read.schema(rollups.RUN).parquet(*[f"{path}/runs/version={n}" for n in range(len(parts))]).agg(F.sum("late"), F.sum("rows")).first()
    assert tuple(late) == (len(made()) - len(kept), len(made()))


@pytest.mark.parametrize("again", [2, 3, 6])
def test_a_repeated_trigger_counts_once(spark, tmp_path, again):
    path, parts = str(tmp_path / "rollups"), triggers(made(), 120)
    for n, part in enumerate(parts):
        for _ in range(2 if n == again else 1):
            rollups.add_trigger(spark.createDataFrame(part, ROW), path, n, "ingested_at", compact_every=3)
    same(spark, path, entered(parts))


def test_a_fold_that_stopped_halfway_is_not_seen(spark, tmp_path, monkeypatch):
    path, parts = str(tmp_path / "rollups"), triggers(made(), 120)
    for n, part in enumerate(parts[:6]):
        rollups.add_trigger(spark.createDataFrame(part, ROW), path, n, "ingested_at", compact_every=3)
    # Trigger 6 closes a day, but its base is never written.
    rows, write = spark.createDataFrame(parts[6], ROW), tables.write_rollup

    def stop(done, target):
        write(done, target)
        if target.endswith("/1h"):
            raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_rollup", stop)
        with pytest.raises(OSError):
            rollups.add_trigger(rows, path, 6, "ingested_at", compact_every=3)
    assert tables.exists(spark, f"{path}/closed/1h") and tables.numbered(spark, f"{path}/open", "base") == [3]
    same(spark, path, entered(parts[:7]))
    rollups.add_trigger(rows, path, 6, "ingested_at", compact_every=3)
    assert tables.numbered(spark, f"{path}/open", "base")[-1] == 6
    same(spark, path, entered(parts[:7]))


def test_stream_shows_the_running_minute(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "rollups")
    rows = made(60, 1)
    for part in triggers(rows, 30):
        spark.createDataFrame(part, ROW).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ROW).parquet(source)
        jobs.start(rollups.live_rollup_job(stream, path), str(tmp_path / "checkpoint"), {"availableNow": True}, idle_batches=False).awaitTermination()
    last = max(r[0] for r in rows).replace(second=0)
    assert rollups.read_rollups(spark, path, "1m").filter(F.col("bucket") == last).count() >= 1
    same(spark, path, entered(triggers(rows, 30)))


def test_nothing_yet(spark, tmp_path):
    path = str(tmp_path / "rollups")
    assert rollups.read_rollups(spark, path, "5m").count() == 0
    rollups.add_trigger(spark.createDataFrame([], ROW), path, 0, "ingested_at")
    assert rollups.read_rollups(spark, path, "1h").count() == 0

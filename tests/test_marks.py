"""Idempotency by the table of marks against the batch operator and against playing the arrivals."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import values

from tidewire.operators import dedup
from tidewire.sources import tables
from tidewire.streaming import jobs, marks

T0 = datetime(2024, 1, 1)
ROW = "event_id string, device_id string, source string, arrived_at timestamp"
HOUR = timedelta(hours=1)


def frame(spark, rows):
    return spark.createDataFrame([(i, d, "http", t) for i, d, t in rows], ROW)


def made(spark, path, **kw):
    return marks.Marks(str(path), frame(spark, []).schema, **kw)


def kept(spark, m):
    return values(spark.read.parquet(f"{m.path}/accepted"), "event_id", "device_id", "arrived_at")


def played(parts, ttl=24 * HOUR):
    """What a store of marks accepts: within a trigger by time, whatever came in earlier triggers stands."""
    mark, out = {}, []
    for part in parts:
        for i, d, t in sorted(part, key=lambda r: (r[2], r[1])):
            if i not in mark or t >= mark[i] + ttl:
                mark[i] = t
                out.append((i, d, t))
    return sorted(out, key=repr)


def arrivals(seed, n=400, ids=25, hours=200):
    rng = random.Random(seed)
    rows = [(f"e{rng.randrange(ids)}", rng.choice("abc"), T0 + rng.randrange(hours * 4) * HOUR / 4) for _ in range(n)]
    return sorted(rows, key=lambda r: r[2])


@pytest.mark.parametrize("lagging", [False, True])
def test_triggers_equal_a_store_of_marks(spark, tmp_path, lagging):
    rows = arrivals(1)
    if lagging:
        behind = [r for r in rows if r[0] in ("e3", "e7", "e11")]
        rows = [r for r in rows if r not in behind] + behind
    parts = [rows[i : i + 50] for i in range(0, len(rows), 50)]
    m = made(spark, tmp_path, fold_every=2)
    for n, part in enumerate(parts):
        m.accept(frame(spark, part), n)
    assert kept(spark, m) == played(parts)
    if not lagging:
        assert kept(spark, m) == values(dedup.realtime_dedup(frame(spark, rows), arrival="arrived_at"), "event_id", "device_id", "arrived_at")


def test_repeated_triggers_and_folds_change_nothing(spark, tmp_path):
    rows = arrivals(2, 240)
    parts = [rows[i : i + 40] for i in range(0, len(rows), 40)]
    m = made(spark, tmp_path, fold_every=2)
    for n, part in enumerate(parts):
        found = [values(m.accept(frame(spark, part), n)) for _ in range(2)]
        assert found[0] == found[1]
        if n == 4:
            # A fold that stopped before its end is made again.
            tables.remove(spark, f"{m.path}/folds/version=4")
            m.accept(frame(spark, part), n)
    assert kept(spark, m) == played(parts)


def test_folds_go_when_both_clocks_have_passed(spark, tmp_path):
    now = [0.0]
    m = made(spark, tmp_path, fold_every=1, clock=lambda: now[0])
    day = 86_400
    for n, (wall, hours) in enumerate([(0, 0), (10, 1), (2 * day, 2), (4 * day, 60), (4 * day + 10, 61), (7 * day, 62)]):
        now[0] = wall
        m.accept(frame(spark, [(f"e{n}", "a", T0 + hours * HOUR)]), n)
    left = sorted(f for n in range(7) if tables.exists(spark, f"{m.path}/marks/fold={n}") for f in [n])
    # Fold 1 holds hour 0 and went with the log at hour 60; fold 5 holds hour 61, which the log has not passed by a day.
    assert 1 not in left and left[-1] == 5 and 4 in left
    # A copy of an event whose mark stands is dropped, one whose mark went by both clocks is new.
    again = m.accept(frame(spark, [("e4", "b", T0 + 63 * HOUR), ("e0", "b", T0 + 63 * HOUR)]), 6)
    assert values(again, "event_id") == [("e0",)]


def test_only_buckets_and_hours_that_can_block_are_read(spark, tmp_path):
    m = made(spark, tmp_path, fold_every=1, ttl_seconds=3600)
    for n in range(4):
        m.accept(frame(spark, [(f"e{n}-{i}", "a", T0 + n * 5 * HOUR) for i in range(60)]), n)
    low = int((T0 + 14 * HOUR).timestamp() * 1_000_000)
    plan = m.known(spark, 3, low, [1, 2])._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters")[1]
    assert "hour" in filters and "bucket" in filters and "Python" not in plan


def test_realtime_job_with_marks_over_restarts(spark, tmp_path):
    log, m = str(tmp_path / "log"), made(spark, tmp_path / "accepted", fold_every=2)
    rows = arrivals(3, 90, 12)
    parts = [rows[i : i + 30] for i in range(0, 90, 30)]
    for part in parts:
        frame(spark, part).coalesce(1).write.mode("append").parquet(log)
        stream = spark.readStream.schema(m.schema).parquet(log)
        jobs.start(marks.accepted_job(stream, m), str(tmp_path / "c"), {"availableNow": True}, False).awaitTermination()
    assert kept(spark, m) == played(parts)
    behind = marks.accepted_stream(spark, m).writeStream.format("parquet").option("path", str(tmp_path / "out"))
    jobs.start(behind, str(tmp_path / "c2"), {"availableNow": True}).awaitTermination()
    assert values(spark.read.parquet(str(tmp_path / "out")), "event_id", "device_id", "arrived_at") == played(parts)


def test_no_rows(spark, tmp_path):
    m = made(spark, tmp_path, fold_every=1)
    assert m.accept(frame(spark, []), 0).count() == 0
    assert m.accept(frame(spark, []), 1).count() == 0
    assert m.accept(frame(spark, [("e", "a", T0)]), 2).count() == 1

"""Scores of a stream against the batch operator over all samples."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewire.operators.anomaly import anomaly_zscore
from tidewire.sources import tables
from tidewire.streaming import scores

T0 = datetime(2024, 1, 1)
SAMPLE = "device_id string, metric string, event_id string, ts timestamp, value double"


def made(n, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        device = "hot" if i % 3 else rng.choice(["a", "b", "c"])
        value = rng.gauss(10, 2) + (60 if i % 131 == 0 else 0)
        rows.append((device, rng.choice(["t", "t", "h"]), f"{i:06d}", T0 + timedelta(milliseconds=250 * (i // 2)), value))
    return rows


def as_text(frame):
    rounded = [F.round(F.col(c) + 1e-9, 6).alias(c) for c in ("mean", "std_dev", "z_score")]
    return sorted(map(repr, frame.select("device_id", "metric", "event_id", "ts", "n_samples", *rounded, "is_anomaly").collect()))


@pytest.mark.parametrize("blocks", [{}, {"series_rows": 150, "block_rows": 60}])
def test_triggers_equal_the_batch(spark, tmp_path, blocks):
    rows = made(1_500)
    cuts = [0, 400, 401, 403, 900, 900, 1_400, 1_500]
    tails = scores.Tails(str(tmp_path), compact_every=2, **blocks)
    for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        part = spark.createDataFrame(rows[a:b], SAMPLE)
        first = as_text(tails.score(part, n))
        assert len(first) == b - a
        if n in (2, 4):
            assert as_text(tails.score(part, n)) == first
    found = spark.read.parquet(f"{tmp_path}/scores")
    assert as_text(found) == as_text(anomaly_zscore(spark.createDataFrame(rows, SAMPLE)))
    assert found.filter("is_anomaly").count() > 5
    held = tails.newest(spark, 99)
    assert held.agg(F.max(F.size("samples"))).first()[0] == 99 and held.count() == 8
    assert tables.numbered(spark, f"{tmp_path}/tails", "base") == [4, 6]


def test_a_trigger_that_stopped_before_its_tails_is_made_again(spark, tmp_path):
    rows = made(600)
    tails = scores.Tails(str(tmp_path))
    for n, part in enumerate((rows[:300], rows[300:])):
        tails.score(spark.createDataFrame(part, SAMPLE), n)
    tables.remove(spark, f"{tmp_path}/tails/version=1")
    tails.score(spark.createDataFrame(rows[300:], SAMPLE), 1)
    assert as_text(spark.read.parquet(f"{tmp_path}/scores")) == as_text(anomaly_zscore(spark.createDataFrame(rows, SAMPLE)))


def test_a_hot_series_spreads_over_tasks_without_python(spark, tmp_path):
    rows = spark.range(40_000).selectExpr(
        "'hot' as device_id", "'t' as metric", "lpad(cast(id as string), 9, '0') as event_id",
        "timestamp_seconds(1704067200 + id) as ts", "cast(id % 17 as double) as value",
    )
    tails = scores.Tails(str(tmp_path), series_rows=5_000, block_rows=2_000)
    tails.score(rows.filter("event_id < '000020000'"), 0)
    second = rows.filter("event_id >= '000020000'")
    plan = anomaly_zscore(second, 5_000, 2_000)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "_block" in plan
    tails.score(second, 1)
    found = spark.read.parquet(f"{tmp_path}/scores")
    assert found.count() == 40_000 and found.filter("n_samples < 100").count() == 99


def test_no_samples(spark, tmp_path):
    tails = scores.Tails(str(tmp_path), compact_every=1)
    for n in range(3):
        assert tails.score(spark.createDataFrame([], SAMPLE), n).count() == 0

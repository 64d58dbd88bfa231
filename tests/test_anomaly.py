import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import frame, values
from tidewire.operators import alerts
from tidewire.operators.anomaly import anomaly_zscore

T0 = datetime(2024, 1, 1)
SCHEMA = "device_id string, metric string, event_id string, ts timestamp, value double"


def reference(rows):
    """Two-pass mean and population deviation over the last 100 samples."""
    out, series = {}, {}
    for device, metric, event_id, ts, value in sorted(rows, key=lambda r: (r[3], r[2])):
        window = series.setdefault((device, metric), [])
        window.append(value)
        del window[:-100]
        mean = sum(window) / len(window)
        sd = (sum((v - mean) ** 2 for v in window) / len(window)) ** 0.5
        z = None if len(window) < 20 else (abs((value - mean) / sd) if sd else 0.0)
        out[event_id, metric] = (len(window), mean, sd, z)
    return out


def series(n, device="d", seed=0, step=lambda i: i):
    rng = random.Random(seed)
    return [(device, "t", f"{device}{i:06d}", T0 + timedelta(seconds=step(i)), rng.gauss(20, 3)) for i in range(n)]


def check(df, rows):
    expected = reference(rows)
    got = df.collect()
    assert len(got) == len(expected)
    for r in got:
        n, mean, sd, z = expected[r["event_id"], r["metric"]]
        assert r["n_samples"] == n
        assert r["mean"] == pytest.approx(mean) and r["std_dev"] == pytest.approx(sd, abs=1e-9)
        assert r["z_score"] == (None if z is None else pytest.approx(z, abs=1e-9))
        assert r["is_anomaly"] == (None if z is None else z > 3)


@pytest.mark.parametrize("n", [19, 20, 100, 101])
def test_series_lengths(spark, n):
    rows = series(n)
    check(anomaly_zscore(frame(spark, rows, SCHEMA)), rows)


@pytest.mark.parametrize("block_rows", [1, 7, 99, 100, 250])
@pytest.mark.parametrize("shape", ["steady", "bursts", "gaps"])
def test_long_series_in_blocks(spark, block_rows, shape):
    rng = random.Random(block_rows)
    step = {
        "steady": lambda i: i,
        "bursts": lambda i: (i // 130) * 5 + rng.randrange(2),
        "gaps": lambda i: i * (1 if i % 50 else 1) + (i // 60) * 1000,
    }[shape]
    rows = series(700, "hot", 1, step) + series(30, "cold", 2) + series(150, "warm", 3)
    check(anomaly_zscore(frame(spark, rows, SCHEMA), series_rows=120, block_rows=block_rows), rows)


def test_constant_series_and_spikes(spark):
    rows = [("d", "t", f"{i:03d}", T0 + timedelta(seconds=i), 5.0) for i in range(40)]
    assert anomaly_zscore(frame(spark, rows, SCHEMA)).filter("is_anomaly").count() == 0
    for spike in (50.0, -50.0):
        scored = anomaly_zscore(frame(spark, [*rows, ("d", "t", "999", T0 + timedelta(seconds=99), spike)], SCHEMA))
        odd = alerts.anomaly_alerts(scored).collect()
        assert len(odd) == 1 and odd[0]["value"] == spike and odd[0]["rule_id"] == "anomaly-t"
        hit = scored.filter("is_anomaly").first()
        assert odd[0]["threshold"] == pytest.approx(hit["mean"] + 3 * hit["std_dev"])
        assert odd[0]["message"].startswith(f"Anomaly detected in t: value={spike:.2f}, z-score=")


def test_no_task_holds_a_long_series(spark):
    rows = series(2000, "hot", 1)
    plan = anomaly_zscore(frame(spark, rows, SCHEMA), series_rows=500, block_rows=200)
    assert "_block" in plan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.filter(F.col("n_samples") == 100).count() == 1901


def test_samples_of_one_instant_are_cut_into_blocks(spark):
    from tidewire.operators.anomaly import _with_blocks

    rng = random.Random(12)
    rows = [("bulk", "t", f"{i:06d}", datetime(2024, 1, 1), rng.gauss(10, 2)) for i in range(6000)]
    rows += [("bulk", "t", f"{i:06d}", datetime(2024, 1, 1, 0, 0, i % 50), rng.gauss(10, 2)) for i in range(6000, 6400)]
    data = frame(spark, rows, "device_id string, metric string, event_id string, ts timestamp, value double")
    blocks = _with_blocks(data, 500, 1_000_000).filter("NOT _context").groupBy("_block").count().collect()
    assert sum(r["count"] for r in blocks) == 6400 and max(r["count"] for r in blocks) < 1500
    columns = ["event_id", "n_samples", "is_anomaly", *[F.round(F.col(c), 8).alias(c) for c in ("mean", "std_dev", "z_score")]]
    cut = anomaly_zscore(data, series_rows=1000, block_rows=500).select(*columns)
    assert values(cut) == values(anomaly_zscore(data).select(*columns))

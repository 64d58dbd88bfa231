"""As-of joins, running totals and who receives a message at its time, against plain Python."""

import random
from datetime import datetime, timedelta

import pytest

from tidewire.operators import fanout
from tidewire.operators.asof import as_of, running_total

START = datetime(2024, 1, 1)


def second(n):
    return START + timedelta(seconds=n)


def made(seed=1):
    rng = random.Random(seed)
    facts = [(i, rng.choice("aaab"), second(rng.randrange(400)), rng.randrange(50)) for i in range(400)]
    facts += [(900, None, second(3), 1), (901, "a", None, 1), (902, "none", second(5), 1)]
    seen, steps = set(), []
    for i in range(120):
        step = (rng.choice("aab"), second(rng.randrange(60, 400)), rng.randrange(50))
        if step not in seen:
            seen.add(step)
            steps.append((*step, None if i % 9 == 0 else i))
    return facts, steps


@pytest.mark.parametrize("cell_micros,cell_rows", [(60_000_000, 1_000_000), (7_000_000, 5), (10**12, 20)])
@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("ahead", [False, True])
def test_as_of_takes_the_nearest_step(spark, cell_micros, cell_rows, strict, ahead):
    facts, steps = made()
    f = spark.createDataFrame(facts, "id int, key string, at timestamp, seq int").repartition(3)
    s = spark.createDataFrame(steps, "key string, made timestamp, seq int, value int")
    found = as_of(
        f, s, ["key"], "at", "made", ["value"], salt_by=["id"], ties=("seq",), strict=strict, ahead=ahead,
        cell_micros=cell_micros, cell_rows=cell_rows,
    )

    def nearest(key, at, seq):
        if key is None or at is None:
            return None
        me = (at, seq)
        mine = [((m, q), v) for k, m, q, v in steps if k == key]
        mine = [(p, v) for p, v in mine if (p > me if ahead else p < me) or (p == me and not strict)]
        return (min(mine) if ahead else max(mine))[1] if mine else None

    assert sorted((r.id, r.value) for r in found.collect()) == [(i, nearest(k, t, q)) for i, k, t, q in sorted(facts)]


def test_running_total_over_cells(spark):
    rng = random.Random(2)
    changes = [(rng.choice("ab"), second(rng.randrange(500)), rng.choice([-1, 1])) for _ in range(600)]
    found = running_total(spark.createDataFrame(changes, "key string, at timestamp, change int"), ["key"], "at", "change", "n", 9_000_000)
    want = {(k, t): sum(c for q, u, c in changes if q == k and u <= t) for k, t, _ in changes}
    assert {(r.key, r.at): r.n for r in found.collect()} == want


LOG = "client_id string, seq bigint, at timestamp, action string, device_id string"


def receivers(log, sent, device):
    """Who receives a message, by playing the log up to its time."""
    open_ = {}
    for client, _, at, action, on in sorted(log, key=lambda r: (r[2], r[1])):
        if at > sent:
            break
        if action == "connect":
            open_[client] = {"*"}
        elif action == "disconnect":
            open_.pop(client, None)
        elif client in open_ and on is not None:
            (open_[client].add if action == "subscribe" else open_[client].discard)(on)
    everything = {c for c, follows in open_.items() if "*" in follows}
    return everything, {c for c, follows in open_.items() if c not in everything and device in follows}


def played(spark, log, messages):
    intervals = fanout.audience_intervals(spark.createDataFrame(log, LOG)).persist()
    frame = spark.createDataFrame(
        [(m, d, t.isoformat(timespec="milliseconds") + "Z") for m, d, t in messages], "message_id string, device_id string, received_at string"
    )
    routed = {(r.message_id, r.audience): r.n_clients for r in fanout.live_fanout_asof(frame, intervals).collect()}
    clients = {r[0] for r in log}
    feeds = {c: sorted(r.message_id for r in fanout.client_feed_asof(frame, intervals, c).collect()) for c in sorted(clients)[:3]}
    want, want_feeds = {}, {c: [] for c in feeds}
    for m, d, t in messages:
        everything, single = receivers(log, t, d)
        want |= {k: n for k, n in {(m, "*"): len(everything), (m, d): len(single)}.items() if n}
        for c in feeds:
            if c in everything | single:
                want_feeds[c].append(m)
    assert routed == want
    assert feeds == {c: sorted(f) for c, f in want_feeds.items()}
    return routed


def test_clients_that_leave_and_return(spark):
    log = [
        ("a", 1, second(0), "connect", None),
        ("a", 2, second(10), "unsubscribe", "*"),
        ("a", 3, second(10), "subscribe", "d1"),
        ("a", 4, second(20), "disconnect", None),
        ("a", 5, second(25), "subscribe", "d1"),
        ("a", 6, second(30), "connect", None),
        ("a", 7, second(40), "subscribe", "d1"),
        ("a", 8, second(50), "connect", None),
        ("b", 9, second(5), "subscribe", "d1"),
        ("b", 10, second(45), "connect", None),
        ("b", 11, second(45), "unsubscribe", "*"),
        ("b", 12, second(45), "subscribe", "*"),
        ("b", 13, second(46), "unsubscribe", None),
    ]
    messages = [(f"m{t}", "d1" if t % 2 else None, second(t)) for t in range(60)]
    routed = played(spark, log, messages)
    assert ("m11", "d1") in routed and ("m21", "d1") not in routed and routed["m45", "*"] == 2
    assert ("m12", "*") not in routed


def test_fanout_against_playing_the_log(spark):
    rng = random.Random(8)
    actions = ["connect", "disconnect", "subscribe", "subscribe", "unsubscribe", "unsubscribe"]
    log = [
        (f"c{rng.randrange(9)}", i, second(rng.randrange(900)), rng.choice(actions), rng.choice(["*", "*", "d1", "d2"]))
        for i in range(700)
    ]
    messages = [(f"m{i}", rng.choice(["d1", "d1", "d2", None]), second(rng.randrange(900))) for i in range(300)]
    played(spark, log, messages)


def test_a_hot_audience_spreads_over_cells_and_tasks(spark):
    facts = spark.range(3_000).selectExpr("id", "'hot' as key", "timestamp'2024-01-01 00:00:00' + id % 4 * interval '1' second as at")
    steps = spark.createDataFrame([("hot", second(n), n) for n in range(3)], "key string, made timestamp, value int")
    found = as_of(facts, steps, ["key"], "at", "made", ["value"], salt_by=["id"], cell_micros=60_000_000, cell_rows=100)
    assert "hashpartitioning(key" in (plan := found._jdf.queryExecution().toString()) and "_salt" in plan
    assert {(r.id % 4, r.value) for r in found.collect()} == {(0, 0), (1, 1), (2, 2), (3, 2)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = found.selectExpr("spark_partition_id() as p").groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 3_000

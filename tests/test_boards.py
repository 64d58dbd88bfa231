"""The streamed device board against the batch one, and reads of one device."""

import random
from datetime import datetime, timedelta

from tidewire.operators import state
from tidewire.sources import tables
from tidewire.streaming import boards

T0 = datetime(2024, 1, 1)
EVENT = "event_id string, device_id string, timestamp timestamp, ingested_at timestamp, metrics map<string,double>, tags map<string,string>"


def made(n=300):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        metrics = {m: float(rng.randrange(99)) for m in ("t", "h", "p") if rng.random() < 0.4}
        tags = {"region": rng.choice("xy")} if rng.random() < 0.3 else None
        at = T0 + timedelta(seconds=rng.randrange(900))
        rows.append((f"e{i:04d}", f"d{rng.randrange(12)}", at - timedelta(days=rng.randrange(3)), at, metrics, tags))
    return [*rows, ("x", "only", T0, T0, {}, None), ("y", "none", T0, T0, None, {"a": "b"})]


def as_text(board):
    rows = board.select("device_id", "timestamp", "tags", "metrics").collect()
    return sorted((r.device_id, r.timestamp, sorted((r.tags or {}).items()), r.tags is None, sorted(r.metrics.items())) for r in rows)


def test_triggers_in_any_order_equal_the_batch(spark, tmp_path):
    rows = made()
    random.Random(1).shuffle(rows)
    table = boards.board_table(str(tmp_path), compact_every=2)
    for n in range(7):
        for _ in range(2 if n in (2, 5) else 1):
            table.add(state.board_parts(spark.createDataFrame(rows[n::7], EVENT)), n)
    want = as_text(state.device_board(spark.createDataFrame(rows, EVENT)))
    assert as_text(boards.read_board(spark, table)) == want and len(want) == 14
    assert tables.numbered(spark, str(tmp_path), "base") == [4, 6]
    assert as_text(boards.read_board(spark, boards.board_table(str(tmp_path / "none")))) == []


def test_one_device_is_one_file(spark, tmp_path):
    path = str(tmp_path / "state")
    rows = spark.range(5_000).selectExpr("concat('dev-', id) as device_id", "cast(id as double) as value")
    tables.write_by_device(rows, path, 16)
    found = tables.read_device(spark, path, "dev-77", 16)
    assert [r.value for r in found.collect()] == [77.0]
    scan = found._jdf.queryExecution().executedPlan()
    while scan.children().size():
        scan = scan.children().head()
    assert scan.metrics().apply("numFiles").value() == 1
    assert len(list((tmp_path / "state").rglob("*.parquet"))) == 16
    assert tables.read_device(spark, path, "nobody", 16).count() == 0

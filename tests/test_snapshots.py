"""Snapshot tables: triggers, compaction beside them, readers in between, repeated and failed writes."""

import threading
from datetime import datetime, timedelta

import pytest
from conftest import values

from tidewire.schemas import DOUBLE, STRING, TIMESTAMP, record
from tidewire.sources import snapshots, tables
from tidewire.streaming import jobs

T0 = datetime(2024, 1, 1)
SCHEMA = record(device_id=STRING, time=TIMESTAMP, value=DOUBLE)


def made(path, **kw):
    return snapshots.SnapshotTable(str(path), SCHEMA, "time", ("device_id", "time"), **kw)


def rows(n, start=0):
    return [(f"dev-{i % 7}", T0 + timedelta(hours=i % 60), float(i)) for i in range(start, start + n)]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def all_values(spark, table):
    return sorted(r.value for r in table.read(spark).collect())


def test_rows_stay_while_days_are_compacted(spark, tmp_path):
    table = made(tmp_path)
    for n in range(6):
        table.append(frame(spark, rows(60, n * 60)), "telemetry", n)
    before = table.newest(spark)
    assert len(before.folders) == 18
    held = table.read(spark)
    assert table.compact(spark, most_parts=3) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert len(table.newest(spark).folders) == 3 and table.compact(spark, 3) == []
    # Who has read the old snapshot still reads it whole.
    assert held.count() == 360 and all_values(spark, table) == [float(i) for i in range(360)]
    table.vacuum(spark, keep=1)
    assert [n for n in tables.names(spark, f"{tmp_path}/snapshots") if n.endswith(".json")] == ["6.json"]
    assert all_values(spark, table) == [float(i) for i in range(360)]
    day = table.read(spark, "2024-01-02", "2024-01-02")
    assert values(day.select("event_date").distinct()) == [(datetime(2024, 1, 2).date(),)] and day.count() == 144


def test_compacted_files_let_row_groups_be_skipped(spark, tmp_path):
    table = made(tmp_path, file_rows=40)
    for n in range(4):
        table.append(frame(spark, rows(120, n * 120)), "t", n)
    table.compact(spark, 1)
    import pyarrow.parquet as pq

    holding = 0
    files = [f for part, day in table.newest(spark).folders for f in (tmp_path / f"data/part={part}/event_date={day}").glob("*.parquet")]
    for f in files:
        stats = pq.ParquetFile(f).metadata.row_group(0).column(0).statistics
        holding += stats.min <= "dev-3" <= stats.max
    assert len(files) > 8 and holding < len(files) / 2


def test_repeated_triggers_are_not_written_again(spark, tmp_path):
    table = made(tmp_path)
    for n in (0, 1, 1, 0, 2):
        table.append(frame(spark, rows(10, n * 10)), "a", n)
    table.append(frame(spark, rows(10, 100)), "b", 0)
    table.compact(spark, 1)
    for n in (0, 1, 2):
        table.append(frame(spark, rows(10, n * 10)), "a", n)
    assert all_values(spark, table) == [float(i) for i in [*range(30), *range(100, 110)]]


def test_a_change_that_came_second_is_tried_again(spark, tmp_path, monkeypatch):
    table = made(tmp_path)
    table.append(frame(spark, rows(10)), "a", 0)
    real, raced = tables.write_new, []

    def slow(s, path, text):
        if not raced:
            raced.append(path)
            # Another writer takes the number first.
            made(tmp_path).append(frame(spark, rows(10, 10)), "b", 0)
        return real(s, path, text)

    monkeypatch.setattr(tables, "write_new", slow)
    table.append(frame(spark, rows(10, 20)), "a", 1)
    assert all_values(spark, table) == [float(i) for i in range(30)]
    assert table.newest(spark).number == 2 and table.newest(spark).writers == {"a": 1, "b": 0}


def test_readers_beside_a_compaction_see_every_row(spark, tmp_path):
    table, stop, seen = made(tmp_path), threading.Event(), []

    def read():
        while not stop.is_set():
            seen.append(table.read(spark).count())

    for n in range(4):
        table.append(frame(spark, rows(50, n * 50)), "a", n)
    reader = threading.Thread(target=read)
    reader.start()
    try:
        table.compact(spark, 1)
        table.append(frame(spark, rows(50, 200)), "a", 4)
        table.compact(spark, 1)
    finally:
        stop.set()
        reader.join()
    assert seen and set(seen) <= {200, 250} and seen == sorted(seen)


def test_an_unfinished_write_is_not_seen(spark, tmp_path, monkeypatch):
    table = made(tmp_path)
    table.append(frame(spark, rows(10)), "a", 0)
    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_new", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            table.append(frame(spark, rows(10, 10)), "a", 1)
        with pytest.raises(OSError):
            table.compact(spark, 0)
    assert all_values(spark, table) == [float(i) for i in range(10)]
    table.append(frame(spark, rows(10, 10)), "a", 1)
    assert all_values(spark, table) == [float(i) for i in range(20)]


def test_stream_compacts_between_triggers(spark, tmp_path):
    source, table = str(tmp_path / "source"), made(tmp_path / "table")
    for n in range(5):
        frame(spark, rows(40, n * 40)).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    jobs.start(snapshots.snapshot_job(stream, table, "t", 2), str(tmp_path / "c"), {"availableNow": True}, False).awaitTermination()
    assert all_values(spark, table) == [float(i) for i in range(200)]
    assert made(tmp_path / "empty").read(spark).count() == 0

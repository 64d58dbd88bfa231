"""The ledger of bronze files: runs that stop, hours that close, and a cost that doesn't grow."""

from datetime import datetime, timedelta

from conftest import values
from pyspark.sql import functions as F

from tidewire.sources import tables
from tidewire.sources.ledger import Ledger
from tidewire.streaming import jobs

T0 = datetime(2024, 1, 30, 20)


def folder(hour):
    return (T0 + timedelta(hours=hour)).strftime("year=%Y/month=%m/day=%d/hour=%H")


def touch(root, hour, name):
    target = root / folder(hour)
    target.mkdir(parents=True, exist_ok=True)
    (target / name).touch()
    return f"{folder(hour)}/{name}"


def test_runs_take_each_file_once_and_close_hours(spark, tmp_path):
    root, ledger = tmp_path / "bronze", Ledger(str(tmp_path / "ledger"))
    made = [touch(root, h, f"batch-{i}.parquet") for h in range(8) for i in range(3)]
    touch(root, 1, "batch-9.tmp")
    taken, run = [], 0
    while True:
        now, files = ledger.pending(spark, str(root), 5)
        if not now:
            break
        if run == 2:
            # A run that stopped before its commit takes the same files again.
            assert ledger.pending(spark, str(root), 5)[0] == now
        ledger.commit(spark, run, now, files)
        ledger.commit(spark, run, ["other"], files)
        taken += now
        run += 1
    assert taken == made
    head = ledger.head(spark)
    assert (head.run, head.first_open, head.n_done) == (4, folder(7), 24) and head.done == made[-3:]
    late = touch(root, 7, "batch-4.parquet")
    new = touch(root, 30, "batch-0.parquet")
    assert ledger.pending(spark, str(root), 5)[0] == [late, new]


def test_two_hundred_runs_cost_the_same(spark, tmp_path, monkeypatch):
    root, ledger = tmp_path / "bronze", Ledger(str(tmp_path / "ledger"))
    calls, sizes, real_names, real_text = [], [], tables.names, tables.read_text

    def counted(s, path):
        calls.append(path)
        return real_names(s, path)

    def measured(s, path):
        text = real_text(s, path)
        sizes.append(len(text))
        return text

    monkeypatch.setattr(tables, "names", counted)
    monkeypatch.setattr(tables, "read_text", measured)
    per_run = []
    for run in range(200):
        touch(root, run, "batch-0.parquet")
        touch(root, run, "batch-1.parquet")
        calls.clear()
        sizes.clear()
        now, files = ledger.pending(spark, str(root))
        assert len(now) == 2
        ledger.commit(spark, run, now, files)
        per_run.append((len(calls), sum(sizes)))
    # The hour before, the new one and the folders above them.
    assert max(c for c, _ in per_run) <= 9 and max(s for _, s in per_run) <= max(s for _, s in per_run[2:8]) + 8


def test_silver_runs_equal_the_batch_and_repeat(spark, tmp_path):
    bronze_path, path, runs = (str(tmp_path / n) for n in ("bronze", "silver", "runs"))
    ledger = Ledger(str(tmp_path / "ledger"))
    rows = spark.range(60).selectExpr(
        "concat('e', id % 50) as event_id", "concat('d', id % 3) as device_id", "timestamp_seconds(1706644800 + id * 60) as timestamp",
        "timestamp_seconds(1706644800 + id * 600) as ingested_at", "'1.0' as schema_version", "'http' as source", "cast(id as double) as temperature",
        "cast(null as double) as humidity", "cast(null as double) as pressure", "'r' as region", "'m' as model",
        "cast(null as double) as lat", "cast(null as double) as lon", "cast(null as map<string,double>) as metrics", "cast(null as map<string,string>) as tags",
    )
    tables.write_bronze(rows, bronze_path, F.col("ingested_at"))
    n_files = len(ledger.pending(spark, bronze_path, 10_000)[1])
    done = []
    while n := jobs.silver_run(spark, bronze_path, path, runs, ledger, files=4):
        done.append(n)
        if len(done) == 2:
            # The head of a run that is not closed: it is made again.
            head = f"{tmp_path}/ledger/head.json"
            held = tables.read_text(spark, head)
            jobs.silver_run(spark, bronze_path, path, runs, ledger, files=4)
            tables.replace_text(spark, head, held)
    assert sum(done) == n_files and jobs.silver_run(spark, bronze_path, path, runs, ledger) == 0
    assert values(tables.read_silver(spark, path), "event_id", "temperature") == values(
        jobs.silver.silver(tables.read_bronze(spark, bronze_path)), "event_id", "temperature"
    )
    entries = ledger.entries(spark)
    assert entries.agg(F.sum("rows"), F.count("*"), F.countDistinct("path")).first() == (60, n_files, n_files)
    summaries = spark.read.parquet(runs).orderBy("batch_id").collect()
    assert [r.skipped_files for r in summaries] == [sum(done[:i]) for i in range(len(done))]
    assert sum(r.events_in for r in summaries) == 60

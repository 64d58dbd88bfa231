from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import frame, values
from tidewire.session import SETTINGS, cut_lineage, scratch_path, shared_dir


class FakeContext:
    def __init__(self, master, held=None):
        self.master, self.held = master, held

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return self.held

    def setCheckpointDir(self, path):
        self.held = path


def fake(master, configured=None, held=None):
    conf = {"spark.checkpoint.dir": configured}
    return SimpleNamespace(sparkContext=FakeContext(master, held), conf=conf)


def test_the_configured_folder_is_used():
    session = fake("spark://host:7077", "s3a://lake/checkpoints/")
    assert shared_dir(session) == "s3a://lake/checkpoints"
    assert session.sparkContext.held == "s3a://lake/checkpoints/"


def test_a_folder_set_on_the_context_is_kept():
    assert shared_dir(fake("yarn", held="hdfs:///c/1")) == "hdfs:///c/1"


def test_a_cluster_never_gets_a_local_folder():
    with pytest.raises(RuntimeError):
        shared_dir(fake("yarn"))


def test_settings_are_in_force(spark):
    assert {k: spark.conf.get(k) for k in SETTINGS} == SETTINGS


def test_cut_lineage_keeps_rows_and_reads_files(spark):
    rows = frame(spark, [("a", {"t": 1.0}), ("b", None)], "k string, m map<string,double>")
    cut = cut_lineage(rows.withColumn("n", F.length("k")))
    assert values(cut, "k", "n") == [("a", 1), ("b", 1)]
    assert "FileScan parquet" in cut._jdf.queryExecution().executedPlan().toString()
    assert scratch_path(spark, "x") != scratch_path(spark, "x")

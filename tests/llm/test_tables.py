"""Queries with SQL, mixing, search and the pipeline."""

import collections

import duckdb
import pytest
from llm_fixtures import messy, nothing  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from tidewire.llm import langid, mixing, queries, simhash, topk

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(name, spark):
    result = queries.QUERIES[name](spark, SF)
    columns = sorted(result.columns)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cursor = con.execute(queries.ORACLE[name])
    at = [[d[0] for d in cursor.description].index(c) for c in columns]
    expected = sorted(repr(tuple(r[i] for i in at)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in result.collect()) == expected


def test_targets_stop_at_twice_the_size(spark):
    rows = [(i, "w " * n, s) for s, n, many in (("a", 10, 30), ("b", 10, 300), ("c", 50, 100)) for i in range(many)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    planned, n = mixing.plan_copies(docs)
    got = {r.source: r for r in planned.groupBy("source").agg(F.first(n["target"]).alias("t"), F.sum(F.col(n["size"]) * F.col(n["copies"])).alias("w")).collect()}
    # 12 450 words: a stops at 600 and b at 6 000; c has the rest.
    assert (got["a"].t, got["b"].t, got["c"].t) == (600.0, 6000.0, 5850.0)
    assert all(abs(r.w - r.t) <= 50 for r in got.values())
    assert planned.agg(F.max(n["copies"])).first()[0] <= 2


def test_mixing_messy_rows(messy, nothing):
    planned, names = mixing.plan_copies(messy)
    assert planned.count() == messy.count() and set(messy.columns) <= set(planned.columns) and names["size"] == "_size"
    again, _ = mixing.plan_copies(messy.repartition(5))
    key = lambda df: sorted(map(repr, df.select("doc_id", "source", names["copies"]).collect()))
    assert key(planned) == key(again)
    assert mixing.mix(messy).columns == messy.columns
    assert mixing.mix(nothing).collect() == []


def test_search_with_few_documents_a_shard(spark, messy, nothing, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    asked = F.col("doc_id") % 50 == 0
    whole = sorted(map(repr, topk.top_k(docs, asked).collect()))
    monkeypatch.setattr(topk, "SHARD_DOCS", 40)
    monkeypatch.setattr(topk, "QUERY_TERMS", 200)
    monkeypatch.setattr(topk, "VISIT", 3)
    monkeypatch.setattr(topk, "BLOCK_DOCS", 4)
    assert sorted(map(repr, topk.top_k(docs, asked).collect())) == whole
    found = topk.top_k(messy, F.col("doc_id").isin(1, 2, 4)).collect()
    best = {r.query_id: r.doc_id for r in found if r.rank == 1}
    assert best[4] == 4 and 2 not in best
    assert topk.top_k(nothing, F.lit(True)).collect() == []


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").persist()
    by_name = dict(corpus_pipeline.STAGES)
    kept = by_name["language"](spark, docs, SF)
    trees = langid.learn(docs.filter(~langid.held_out("doc_id")), "doc_id", "text", "lang")
    rejected = {r.doc_id for r in langid.identify(docs, trees).filter("lang_pred = 'und'").collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - rejected
    groups = simhash.near_duplicates(simhash.fingerprints(docs)).collect()
    assert {r.doc_id for r in by_name["near_duplicates"](spark, docs, SF).collect()} == {r.component_id for r in groups}
    assert by_name["secrets"](spark, docs, SF).count() == docs.count()
    planned, n = mixing.plan_copies(docs)
    copies = {r.doc_id: r[n["copies"]] for r in planned.collect() if r[n["copies"]]}
    assert collections.Counter(r.doc_id for r in by_name["mixing"](spark, docs, SF).collect()) == copies


def test_pipeline_runs_to_its_end(spark, messy, nothing, tmp_path):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "n_tokens", "ids"] and found.count() > 100
    for name, rows in (("messy", messy), ("nothing", nothing)):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        assert corpus_pipeline.run(spark, f"{tmp_path}/{name}").filter("doc_id = 6").count() == 0


def test_queries_leave_the_session_as_it_was(spark, tmp_path, messy):
    messy.limit(4).write.parquet(f"{tmp_path}/documents.parquet")
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(n) for n in names]
    for name in ("op2_secret_ownership", "op6_simhash_components", "op8_bm25_block_max", "op10_sentencepiece", "op12_cuckoo_dedup"):
        queries.QUERIES[name](spark, str(tmp_path)).collect()
    queries.QUERIES["op9_chat_windows"](spark, SF).collect()
    assert [spark.conf.get(n) for n in names] == before

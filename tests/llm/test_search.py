"""Shards answer blocks of queries together, and exactly."""

import collections
import math
import pickle
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

from tidewire.llm import topk

K = 5


@pytest.fixture(scope="module")
def texts():
    """Two vocabularies, frequent and rare words, texts of all lengths, copies."""
    draw = random.Random(3)
    made = []
    for i in range(300):
        side = "ab"[i % 2]
        words = [f"{side}{int(60 * draw.random() ** 3)}" for _ in range(draw.choice((1, 5, 40, 200)))]
        made.append(" ".join([*words, f"{side}rare{draw.randrange(80)}", "all"]))
    return made + made[:40] + [made[7]] * 30


@pytest.fixture(scope="module")
def parts(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    terms = topk.term_rows(docs, "doc_id", "text")
    index = topk.build_shards(terms, 1)
    counts = {r.term: r.n for r in topk.document_counts(index).collect()}
    asked = terms.filter("key % 3 = 0").orderBy("key").collect()
    block = pa.table({"row": [r.key for r in asked], "terms": [r.terms for r in asked], "counts": [[counts[t] for t in r.terms] for r in asked]})
    row = index.toArrow().to_pylist()[0]
    return row, row["words"] / row["n_docs"], topk.Queries.of(block, len(texts))


def by_hand(texts, query):
    lists = [collections.Counter(t.split()) for t in texts]
    mean = sum(sum(x.values()) for x in lists) / len(lists)
    df = collections.Counter(w for x in lists for w in x)
    scores = {}
    for i, x in enumerate(lists):
        norm = 1.2 * (0.25 + 0.75 * sum(x.values()) / mean)
        gains = [math.log(1 + (len(texts) - df[w] + 0.5) / (df[w] + 0.5)) * x[w] * 2.2 / (x[w] + norm) for w in lists[query] if w in x]
        if gains:
            scores[i] = round(sum(gains), 6)
    return sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:K]


@pytest.mark.parametrize("sizes", [{}, {"BLOCK_DOCS": 8, "VISIT": 8}, {"BLOCK_DOCS": 4, "VISIT": 3}, {"RARE_SHARE": 1}, {"RARE_SHARE": 1000}])
def test_queries_run_through_a_shard_together(texts, parts, sizes, monkeypatch):
    for name, value in sizes.items():
        monkeypatch.setattr(topk, name, value)
    row, mean, queries = parts
    shard = topk.Shard(row, mean, queries)
    calls, opened = [], []
    search, add = shard.search, shard._add
    shard.search = lambda *a: calls.append(1) or search(*a)
    shard._add = lambda sums, wanted, open_: opened.append(open_.sum()) or add(sums, wanted, open_)
    which, floors = np.arange(len(queries.rows)), np.zeros(len(queries.rows))
    expected = {i: by_hand(texts, queries.rows[i]) for i in which}
    found = {i: list(zip(shard.keys[docs].tolist(), scores.tolist(), strict=True)) for i, docs, scores in shard.search_some(queries, which, floors, K)}
    assert found == expected
    assert len(calls) == 1
    # Floors close blocks, and lose nothing that reaches them.
    without = sum(opened)
    opened.clear()
    floors = np.array([expected[i][-1][1] for i in which])
    again = {i: list(zip(shard.keys[docs].tolist(), scores.tolist(), strict=True)) for i, docs, scores in shard.search_some(queries, which, floors, K)}
    assert again == expected
    assert sum(opened) <= without and (topk.BLOCK_DOCS == 64 or sum(opened) < 0.9 * len(which) * shard.blocks)
    assert list(shard.search_some(queries, which, floors + 1000, K)) == []


def test_broadcasts_are_read_without_the_package(spark, texts, monkeypatch):
    sent, broadcast = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda sc, value: sent.append(pickle.dumps(value)) or broadcast(sc, value))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = topk.top_k(docs, F.col("doc_id") % 50 == 0, K).collect()
    for query in range(0, len(texts), 50):
        own = sorted((r.rank, r.doc_id, r.score) for r in found if r.query_id == query)
        assert [(key, score) for _, key, score in own] == by_hand(texts, query)
    assert sent and not any(b"tidewire" in value for value in sent)

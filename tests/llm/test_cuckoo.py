"""Exact duplicates: the filter by itself, and the index against a plain grouping."""

import collections
import hashlib
import random

import numpy as np
from llm_fixtures import messy, nothing  # noqa: F401
from pyspark.sql import functions as F

from tidewire.llm import cuckoo


def entry(keys, rng):
    n = len(keys)
    return (
        np.array([np.frombuffer(hashlib.sha256(k.encode()).digest(), "<u8") for k in keys], "<u8").reshape(-1, 4),
        np.ones(n, np.int64),
        np.array([rng.randrange(9) for _ in keys], np.int64),
        np.array([rng.random() < 0.9 for _ in keys], bool),
        np.arange(n),
    )


def test_filter_grows_verifies_and_forgets():
    rng = random.Random(3)
    words = [f"w{rng.randrange(20_000)}" for _ in range(40_000)]
    keys, n, top, known, row = entry(words, rng)
    held = cuckoo.Filter(2)
    for at in range(0, len(words), 1_000):
        part = slice(at, at + 1_000)
        held.insert((keys[part], n[part], top[part], known[part], row[part]))
    counts = collections.Counter(words)
    assert held.size == len(counts) == (held.marks != 0).sum() and held.resizes >= 3
    best = {}
    for i, w in enumerate(words):
        best[w] = max(best.get(w, (False, 0, 1)), (bool(known[i]), int(top[i]) if known[i] else 0, -i))
    distinct = list(counts)
    place = held.find(entry(distinct, rng)[0])
    assert (place >= 0).all()
    at = np.unravel_index(place, held.marks.shape)
    assert held.n[at].tolist() == [counts[w] for w in distinct]
    assert held.known[at].tolist() == [best[w][0] for w in distinct]
    # A mark of 16 bits alone would let some of these pass.
    assert (held.find(entry([f"x{i}" for i in range(30_000)], rng)[0]) == -1).all()
    gone, stay = distinct[::2], distinct[1::2]
    held.remove(entry(gone, rng)[0], np.array([counts[w] for w in gone]))
    assert held.size == len(stay)
    assert (held.find(entry(gone, rng)[0]) == -1).all() and (held.find(entry(stay, rng)[0]) >= 0).all()
    held.remove(entry(stay[:1], rng)[0], np.array([counts[stay[0]] - 1]))
    assert held.n[np.unravel_index(held.find(entry(stay[:1], rng)[0]), held.marks.shape)].tolist() == [1]


def groups(rows):
    out = collections.defaultdict(list)
    for key, text in rows:
        out[text or ""].append(key)
    return out


def as_found(rows):
    same = groups(rows)
    return sorted((k, max(same[t or ""]), len(same[t or ""]), k == max(same[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for k, t in rows)


def some_rows(n=4_000):
    rng = random.Random(5)
    texts = ["", None, *[f"text {i} é🙂" for i in range(900)]]
    return [(i, "the hot text" if i % 3 == 0 else rng.choice(texts)) for i in range(n)]


def test_query_against_plain_grouping(spark, monkeypatch):
    rows = some_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    want = as_found(rows)
    assert sorted(map(tuple, cuckoo.exact_duplicates(docs).collect())) == want
    monkeypatch.setattr(cuckoo, "SHARD_KEYS", 50)
    monkeypatch.setattr(cuckoo, "TASK_KEYS", 100)
    monkeypatch.setattr(cuckoo, "HEAVY_SHARE", 4)
    assert sorted(map(tuple, cuckoo.exact_duplicates(docs).collect())) == want


def test_rows_come_and_go(spark):
    rows = some_rows(1_500)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    every = cuckoo.digested(docs)

    def state(index):
        return sorted((bytes(r.digest), r.n, r.top) for r in index.collect())

    def expected(kept):
        return sorted((hashlib.sha256(t.encode()).digest(), len(k), max(k)) for t, k in groups(kept).items())

    half, rest = every.filter(F.col("top") % 2 == 0), every.filter(F.col("top") % 2 == 1)
    index = cuckoo.build(half)
    assert state(index) == expected([r for r in rows if r[0] % 2 == 0])
    index = cuckoo.insert(index, rest)
    assert state(index) == expected(rows)
    late = F.col("top") >= 600
    index = cuckoo.remove(index, every.filter(late), every.filter(~late))
    assert state(index) == expected([r for r in rows if r[0] < 600])


def test_messy_rows(messy, nothing):
    found = cuckoo.exact_duplicates(messy).collect()
    assert len(found) == messy.count()
    same = [r for r in found if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    # Texts that are null or empty: keys 2, 3 and null.
    assert [(r.keep_id, r.group_size) for r in same] == [(3, 3)] * 3 and [r.doc_id for r in same if r.kept] == [3]
    twice = [r for r in found if r.doc_id == 1 and r.group_size == 2]
    assert len(twice) == 2 and sum(r.kept for r in twice) == 1
    assert sum(r.kept for r in found) == len({r.text_sha256 for r in found})
    assert cuckoo.exact_duplicates(nothing).collect() == []

"""Spelling variants against comparing every word with every other."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from llm_fixtures import documents, messy, nothing  # noqa: F401

from tidewire.llm import spelling


def near(a, b):
    """One inserted, deleted or replaced letter, by trying them all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows):
    counts = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_variants(words):
    by_size = collections.defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    out, form = [], {}
    for w, n in words.items():
        found = [o for size in (len(w) - 1, len(w), len(w) + 1) for o in by_size[size] if near(w, o)]
        best = min(found, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
        out.append((w, form[w], n, len(found)))

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, f or "", root(w), n, k, words[f] if f else None) for w, f, n, k in out)


def as_rows(found):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n) for r in found.collect())


def made_rows(n=700):
    """Words of few letters, so that counts clash, in texts with other alphabets between them."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abAÿ", k=rng.randint(4, 7))) for _ in range(400)]
    return [(i, " 7,日".join(rng.choices(words, k=20))) for i in range(n)]


def test_query_against_all_pairs(spark, documents):
    rows = [(r[0], r[1]) for r in documents]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = plain_variants(plain_words(rows))
    assert as_rows(spelling.variants(docs)) == want
    assert any(w[1] for w in want) and any(w[1] and w[2] != w[1] for w in want)


@pytest.mark.parametrize("node_rows", [1 << 15, 400, 1])
def test_crowded_nodes_go_down_and_crowded_leaves_are_joined(spark, monkeypatch, node_rows):
    monkeypatch.setattr(spelling, "NODE_ROWS", node_rows)
    monkeypatch.setattr(spelling, "GROUPS", 5)
    monkeypatch.setattr(spelling, "WALK", 7)
    monkeypatch.setattr(spelling, "STATES", 11)
    monkeypatch.setattr(spelling, "LETTERS", 50)
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = plain_variants(plain_words(rows))
    assert as_rows(spelling.variants(docs)) == want
    assert sum(w[4] for w in want) > 500


def test_trie_finds_what_the_budget_allows():
    rng = random.Random(2)
    words = sorted({bytes(rng.choices(b"abcd", k=6)) for _ in range(600)})
    groups = np.arange(256) % spelling.GROUPS
    own = spelling.counts(words, groups)
    trie = spelling.Trie(own)
    found = set()
    for who, leaf, _ in trie.walk(own, np.full(len(words), spelling.SAME)):
        for a, node in zip(who, leaf, strict=True):
            found |= {(words[a], words[m]) for m in trie.order[trie.begins[node] : trie.begins[node + 1]]}
    for a, b in itertools.combinations(words, 2):
        if near(a, b):
            assert ((a, b) in found) != ((b, a) in found)
    assert len(found) < len(words) ** 2 / 8


def test_messy_rows(spark, messy, nothing):
    found = {r.word: r for r in spelling.variants(messy).collect()}
    assert found["again"].n == 4 and found["again"].form is None and found["again"].root == "again"
    assert spelling.variants(nothing).collect() == []
    long = "x" * 40_000
    docs = spark.createDataFrame([(i, f"{long} {long}y été été1été") for i in range(4)], "doc_id bigint, text string")
    assert {r.word: r.n_near for r in spelling.variants(docs).collect()} == {long: 1, long + "y": 1}

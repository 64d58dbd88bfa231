"""Collocations against counting every phrase in Python, and the parts of the counting."""

import collections
import random
import re

import numpy as np
import pytest
from llm_fixtures import messy, nothing  # noqa: F401

from tidewire.llm import phrases


def plain(rows, least, top):
    total, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    around = collections.Counter()
    for (lang, p), a in candidates.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                around[lang, p[i : i + m]] = max(around[lang, p[i : i + m]], a)
    out = collections.defaultdict(list)
    for (lang, p), a in candidates.items():
        if 100 * around[lang, p] >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, total[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def made_rows(n=500):
    rng = random.Random(4)
    words = [*"abcdefghij", "École", "日本", "Ünï", "no break", "\x00nul"]
    weights = [1 / (i + 1) for i in range(len(words))]
    ends = [" ", " ", " ", "\t ", ", ", ".\n", "!? "]
    return [
        (rng.choice(["en", "en", "de", None, "und"]), "".join(w + rng.choice(ends) for w in rng.choices(words, weights, k=rng.randint(0, 60))))
        for _ in range(n)
    ]


@pytest.mark.parametrize("sizes", [{}, {"CHUNK": 500, "WAITING": 700, "TILE_ENTRIES": 300, "DENSE": 3, "SLICE": 40}])
def test_query_against_counting_every_phrase(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(phrases, name, value)
    rows = [*made_rows(), ("en", None), ("en", ""), ("xx", "one two")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    found = phrases.collocations(docs, least=8, top=300)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain(rows, 8, 300)
    assert sorted(map(tuple, found.collect())) == want
    assert {len(w[2].split(" ")) for w in want} == {2, 3, 4}


def test_numbers_travel_as_bytes():
    for numbers in ([], [0], [-1, 127, 128, -1], [2**15, 2**16], [2**62, -1], [-5, 3]):
        got = phrases.unpack(phrases.pack(np.array(numbers, np.int64)))
        assert got.tolist() == numbers


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**17
    rows = [("en", 1, ["a", "b"], [big + 7, big], [big + 1, big])]
    docs = spark.createDataFrame(rows, "lang string, number bigint, words array<string>, begins array<bigint>, ends array<bigint>")
    r = phrases.scored(docs, 2).first()
    assert r.score == 2_000_000 * big // (2 * big + 8) and (r.l, r.r) == (big + 7, big + 1)


def test_messy_rows(messy, nothing):
    found = {r.phrase: r for r in phrases.collocations(messy, least=2).collect()}
    assert found["the same words"].n == 28 and found["the same words"].a == 4
    assert phrases.collocations(nothing).collect() == []

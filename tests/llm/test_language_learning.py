"""Languages and their limits are learned from all rows, in one part or several."""

import random

import numpy as np
import pytest

from tidewire.llm import langid


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(5)
    words = {name: ["".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(3000)] for name, letters in (("x", "abcdefgh é"), ("y", "fghijklm"))}
    long = lambda name, n: " ".join(rng.choices(words[name], k=n))
    rows = [(i, long("x", 12_000), "x") for i in range(34)] + [(100 + i, long("y", 30), "y") for i in range(200)]
    return spark.createDataFrame([*rows, (999, "", "z"), (998, None, "z"), (997, "zzz", None)], "doc_id bigint, text string, lang string"), rows


def whole_trees(rows):
    languages = sorted({r[2] for r in rows})
    counted = []
    for i, name in enumerate(languages):
        data, begins = langid.padded([r[1] for r in rows if r[2] == name])
        owner = np.searchsorted(begins, np.arange(langid.ORDER, len(data)), side="right") - 1
        inside = np.arange(langid.ORDER, len(data)) >= begins[owner] + langid.ORDER
        gram, n = np.unique(langid.grams(data, langid.ORDER, len(data))[inside], return_counts=True)
        counted.append((np.full(len(gram), i), gram, n))
    return langid.Trees.of(languages, *[np.concatenate(c) for c in zip(*counted, strict=True)])


def test_all_rows_are_learned(spoken, monkeypatch):
    docs, rows = spoken
    assert sum(len(r[1]) for r in rows if r[2] == "x") > 1_700_000
    monkeypatch.setattr(langid, "COUNTED", 5_000)
    trees = langid.learn(docs, "doc_id", "text", "lang")
    asked = [r[1][-2000:] for r in rows[:34]] + [r[1] for r in rows[34:80]] + ["", "zz top", "日本"]
    assert trees.languages == ["x", "y"]
    assert trees.code_lengths(asked).tolist() == whole_trees(rows).code_lengths(asked).tolist()


def test_parts_give_what_the_whole_gives(spoken, monkeypatch):
    docs, rows = spoken
    whole = langid.learn(docs, "doc_id", "text", "lang")
    monkeypatch.setattr(langid, "MODEL_CELLS", 150_000)
    parts = langid.learn(docs, "doc_id", "text", "lang")
    held = [*parts.parts()]
    assert len(held) >= 3 and {(p.low, p.high) for p in held} == set(zip(parts.edges, parts.edges[1:], strict=False))
    assert max(len(p.bits[langid.ORDER]) for p in held) < len(whole.bits[langid.ORDER]) / 2
    asked = docs.unionByName(docs.sparkSession.createDataFrame([(-1, "né abba 日本 zz", None), (-2, "a", None)], docs.schema))
    found, expected = (
        sorted((r.doc_id, r.lang_pred, r.text, r.lang, r.score, r.bits) for r in langid.identify(asked, t, keep=("text", "lang")).fillna("-", ["text", "lang"]).collect())
        for t in (parts, whole)
    )
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    assert [r[4:] for r in found] == [pytest.approx(r[4:], rel=1e-6) for r in expected]
    assert langid.limits(docs, parts) == pytest.approx(langid.limits(docs, whole), abs=1e-3)


def test_limits_come_from_all_texts(spark, spoken):
    docs, rows = spoken
    trees = langid.learn(docs, "doc_id", "text", "lang")
    rng = random.Random(6)
    # Texts of one kind in three are unlike the others; few of them, so a draw meets another share of them.
    texts = ["".join(rng.choices("fghijklm " if i % 3 else "qrstuvw", k=rng.randint(20, 60))) for i in range(5000)]
    told = spark.createDataFrame([(i, t, "y") for i, t in enumerate(texts)], docs.schema)
    bits = trees.code_lengths(texts)[:, 1] / [len(t) for t in texts]
    middle, high = np.quantile(bits, [0.5, 0.99])
    limit = langid.limits(told, trees)
    assert limit["y"] == pytest.approx(middle + max(2 * (high - middle), langid.LEAST_MARGIN), abs=4 / langid.BIT_STEPS)
    assert limit["x"] == limit["y"]


def test_quantiles_of_counted_values():
    rng = np.random.default_rng(7)
    values, counts = rng.permutation(50) / 8, rng.integers(1, 9, 50)
    for shares in ([0.5, 0.99], [0.0, 1.0], [0.137, 0.71]):
        assert langid.quantiles(values, counts, shares) == pytest.approx(np.quantile(np.repeat(values, counts), shares).tolist())
    assert langid.quantiles(np.array([3.0]), np.array([1]), [0.5, 0.99]) == [3.0, 3.0]

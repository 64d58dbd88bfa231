"""Words are counted without making them."""

import random
import re

from pyspark.sql import functions as F

from tidewire.llm import mixing
from tidewire.llm.common import WORD


def test_words_of_odd_texts(spark):
    rng = random.Random(9)
    odd = " \t\n\v\f\r\x1c\x1f\x85\xa0  ax$\\é日🙂\x00"
    texts = ["", " ", "x", " x", "x ", "  x  x  ", "\v\f", "\x85 \xa0", "$1 \\ x$", " " * 300_000, "a" * 300_000, "a " * 100_000 + " " * 100_000]
    texts += ["".join(rng.choices(odd, k=rng.randint(0, 40))) for _ in range(2000)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, text string")
    counted = {r.i: r.n for r in rows.select("i", mixing.word_count(F.col("text")).alias("n")).collect()}
    assert counted == {i: len(re.findall(WORD, t or "")) for i, t in enumerate([*texts, None])}


def test_counting_makes_no_array_of_words(spark):
    plan = spark.createDataFrame([("a b",)], "text string").select(mixing.word_count(F.col("text")))
    assert "extract_all" not in plan._jdf.queryExecution().optimizedPlan().toString()

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, row string, key string, _text string"


@pytest.fixture(scope="session")
def documents():
    return duckdb.sql(f"SELECT doc_id, coalesce(text, ''), lang, source FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 700}x{i % 11}" for i in range(30_000))
    rows = [
        (1, "The same words again and again, the same words.", "en", "a"),
        (1, "The same words again and again, the same words.", "en", "a"),
        (1, "Other text under the same key", "en", "b"),
        (2, None, "de", "a"),
        (3, "", None, None),
        (None, "no key here but a token = abcdef123456", None, None),
        (None, None, None, None),
        (4, long, "de", "b"),
        (5, long, "de", "c"),
        (6, " \t\n ", "en", "a"),
        (7, "日本語のテキスト 🙂", None, "c"),
        (8, "12 34 %% --", "en", "a"),
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 9, "r", None, "t") for r in rows], DOCS)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.filter("false")

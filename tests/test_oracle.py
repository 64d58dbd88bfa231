"""Every query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from conftest import SF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

QUERIES = dict(entry_module.QUERIES)
ORACLE = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    yield con
    con.close()


def comparable(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    result = QUERIES[name](spark, SF)
    columns = sorted(result.columns)
    actual = sorted(tuple(comparable(r[c]) for c in columns) for r in result.collect())
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert actual == sorted(tuple(comparable(r[i]) for i in at) for r in cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLE)


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0

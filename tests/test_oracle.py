"""Every registered query against its DuckDB counterpart on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("ORDERLOOM_TEST_DATA", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value if value is None else repr(value) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=str)
    assert got, "no rows"
    if name not in ORACLE:
        return
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert {c: KINDS[t] for c, t in df.dtypes} == kinds
    want = sorted((tuple(_plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=str)
    assert got == want


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0

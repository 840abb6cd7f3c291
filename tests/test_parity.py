"""Every query with a SQL statement against DuckDB on the smallest tables, whole results."""

import datetime
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_parity(spark, duck, name):
    df = entry.queries()[name](spark, ROOT)
    got = Counter(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in sorted(names)]
    want = Counter(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
    assert got == want

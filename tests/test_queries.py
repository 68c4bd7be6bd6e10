"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from conftest import DATA
from strandlake.plans import all_queries
from strandlake.session import Tables

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{DATA}/{name}.parquet')")
    return con


def ordered(columns, data):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in places) for r in data), key=repr)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("name", sorted(n for n, q in all_queries().items() if q.sql))
def test_matches_sql(spark, duck, name):
    q = all_queries()[name]
    df = q.run(Tables(spark, DATA))
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(q.sql)
    columns = [d[0] for d in res.description]
    want = ordered(columns, res.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(same(x, y) for x, y in zip(a, b)), (a, b)


@pytest.mark.parametrize("name", sorted(n for n, q in all_queries().items() if not q.sql))
def test_runs_without_sql(spark, name):
    assert all_queries()[name].run(Tables(spark, DATA)).count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

"""Queries of the subpackage that have SQL, against DuckDB on the same tables."""

import pytest

from strandlake.llm.queries import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "pages"):
        con.execute(f"create view {table} as select * from read_parquet('{DATA}/{table}.parquet')")
    df = QUERIES[name](spark, DATA)
    cursor = con.execute(SQL[name])
    assert [c[0] for c in cursor.description] == df.columns
    assert sorted(map(tuple, df.collect())) == sorted(cursor.fetchall())

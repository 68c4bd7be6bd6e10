"""Compare registered queries with their SQL on one folder of tables.

usage: python scripts/verify.py [folder] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from strandlake.plans import all_queries
from strandlake.session import Tables, build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def same(a, b, tolerance):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= tolerance * max(1.0, abs(a), abs(b))
    return type(a) is type(b) and a == b or (not isinstance(a, (float, bool)) and a == b)


def main():
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("verify", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{root}/{name}.parquet')")
    bad = []
    for name, q in all_queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = q.run(Tables(spark, root))
            got = rows_of(df.columns, [tuple(r) for r in df.collect()])
        except Exception as error:  # report and go on with the next query
            bad.append(name)
            print(f"FAIL  {name}: spark {str(error)[:1500]}")
            continue
        took = time.time() - start
        if not q.sql:
            print(f"rows  {name}: {len(got)} rows {took:.2f}s")
            continue
        start = time.time()
        try:
            res = con.execute(q.sql)
            columns = [d[0] for d in res.description]
            want = rows_of(columns, res.fetchall())
        except Exception as error:
            bad.append(name)
            print(f"FAIL  {name}: sql {str(error)[:600]}")
            continue
        duck = time.time() - start
        verdict = "exact"
        if sorted(df.columns) != sorted(columns):
            verdict = f"FAIL columns {sorted(df.columns)} / {sorted(columns)}"
        elif len(got) != len(want):
            verdict = f"FAIL rows {len(got)} / {len(want)}"
        elif got != want or any(type(x) is not type(y) for a, b in zip(got[:50], want) for x, y in zip(a, b)):
            off = [(a, b) for a, b in zip(got, want)
                   if not all(same(x, y, 1e-9) for x, y in zip(a, b))]
            kinds = {(type(x).__name__, type(y).__name__) for a, b in zip(got, want) for x, y in zip(a, b)
                     if type(x) is not type(y)}
            verdict = f"FAIL {len(off)} rows differ, e.g. {off[:2]}" if off else f"close {kinds}"
        if verdict.startswith("FAIL"):
            bad.append(name)
        if not verdict.startswith("FAIL") and not got:
            verdict += " EMPTY"
        print(f"{verdict[:900]}  {name}: {len(got)} rows spark {took:.2f}s sql {duck:.2f}s")
    print("bad:", bad)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()

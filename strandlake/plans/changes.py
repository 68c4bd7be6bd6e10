"""Table-change queries over two versions derived from ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.operators import changes as c
from strandlake.plans.registry import query

KEY = ["o_orderkey"]

# Version 0: orders before 2000. Source batch: orders from 1999 on, with every third status set to X.
V0 = "v0 AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"
SRC = """src AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
        o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')"""


def v0(t):
    return t.orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_orderstatus", "o_totalprice")


def source(t):
    late = F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    status = F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus"))
    return t.orders.filter(late).select("o_orderkey", status.alias("o_orderstatus"),
                                        (F.col("o_totalprice") + 1).alias("o_totalprice"))


@query("merge_upsert", "DML-01", f"""
WITH {V0}, {SRC} SELECT * FROM v0 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src) UNION ALL SELECT * FROM src""")
def _(t):
    return c.merge_upsert(v0(t), source(t), KEY)


@query("merge_update_only", "DML-02", f"""
WITH {V0}, {SRC} SELECT v0.o_orderkey, CASE WHEN src.o_orderkey IS NOT NULL THEN src.o_orderstatus ELSE v0.o_orderstatus END AS o_orderstatus,
  v0.o_totalprice FROM v0 LEFT JOIN src ON v0.o_orderkey = src.o_orderkey""")
def _(t):
    return c.merge_update_only(v0(t), source(t), KEY, "o_orderstatus")


@query("upsert_columns", "DML-03", f"""
WITH {V0}, {SRC} SELECT coalesce(v0.o_orderkey, src.o_orderkey) AS o_orderkey,
  CASE WHEN v0.o_orderkey IS NOT NULL THEN v0.o_orderstatus ELSE src.o_orderstatus END AS o_orderstatus,
  CASE WHEN src.o_orderkey IS NOT NULL THEN src.o_totalprice ELSE v0.o_totalprice END AS o_totalprice
FROM v0 FULL JOIN src ON v0.o_orderkey = src.o_orderkey""")
def _(t):
    return c.upsert_columns(v0(t), source(t), KEY, ["o_totalprice"])


@query("update_where", "DML-04", f"""
WITH {V0} SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49) THEN 'R'
  WHEN o_totalprice < 20000 THEN 'S' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM v0""")
def _(t):
    keys = t.lineitem.filter(F.col("l_quantity") > 49).select(F.col("l_orderkey").alias("o_orderkey"))
    low = c.update_where(v0(t), F.col("o_totalprice") < 20000, {"o_orderstatus": F.lit("S")})
    return c.update_keys(low, keys, KEY, {"o_orderstatus": F.lit("R")})


@query("delete_keys", "DML-05", f"""
WITH {V0} SELECT * FROM v0 WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)""")
def _(t):
    keys = t.lineitem.filter(F.col("l_quantity") > 49).select(F.col("l_orderkey").alias("o_orderkey"))
    return c.delete_keys(v0(t), keys, KEY)


@query("append_schema_merge", "DML-06 DML-07", f"""
WITH {V0}, {SRC} SELECT origin, count(*) AS n FROM (SELECT o_orderkey, o_orderstatus, o_totalprice, NULL AS origin FROM v0 UNION ALL
  SELECT o_orderkey, o_orderstatus, o_totalprice, NULL FROM src UNION ALL
  SELECT o_orderkey, o_orderstatus, o_totalprice, 'new' FROM src) GROUP BY 1""")
def _(t):
    grown = c.append_enforced(v0(t), source(t))
    return c.append_merged(grown, source(t).withColumn("origin", F.lit("new"))).groupBy("origin").agg(
        F.count("*").alias("n"))


@query("version_counts", "DML-09", f"""
WITH {V0}, {SRC} SELECT 0 AS version, count(*) AS n FROM v0 UNION ALL
SELECT 1, count(*) FROM (SELECT o_orderkey FROM v0 UNION SELECT o_orderkey FROM src)""")
def _(t):
    old = v0(t)
    return c.version_counts(c.stack_versions({0: old, 1: c.merge_upsert(old, source(t), KEY)}))


@query("changed_values", "JOIN-21 DML-09 FLT-09", f"""
WITH {V0}, {SRC} SELECT o_orderkey, v0.o_orderstatus AS old_value, src.o_orderstatus AS new_value
FROM v0 JOIN src USING (o_orderkey) WHERE v0.o_orderstatus IS DISTINCT FROM src.o_orderstatus""")
def _(t):
    return c.changed_values(v0(t), c.merge_upsert(v0(t), source(t), KEY), KEY, "o_orderstatus")


@query("added_rows", "DML-09", f"WITH {V0}, {SRC} SELECT * FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM v0)")
def _(t):
    return c.added_rows(v0(t), c.merge_upsert(v0(t), source(t), KEY), KEY)


@query("as_of", "DML-10", """
WITH h AS (SELECT o_custkey, o_orderdate AS valid_from, o_orderkey, o_totalprice, o_orderstatus = 'P' AS is_deleted FROM orders),
     r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY valid_from DESC, o_orderkey DESC) AS rn FROM h
           WHERE valid_from <= TIMESTAMP '1999-06-30')
SELECT o_custkey, o_orderkey, o_totalprice FROM r WHERE rn = 1 AND NOT is_deleted""")
def _(t):
    history = t.orders.select("o_custkey", F.struct("o_orderdate", "o_orderkey").alias("valid_from"), "o_orderkey",
                              "o_totalprice", (F.col("o_orderstatus") == "P").alias("is_deleted"))
    moment = F.struct(F.lit("1999-06-30").cast("timestamp_ntz").alias("o_orderdate"),
                      F.lit(2 ** 62).cast("bigint").alias("o_orderkey"))
    return c.as_of(history, ["o_custkey"], moment).select("o_custkey", "o_orderkey", "o_totalprice")


@query("recover_deleted", "DML-10", f"""
WITH {V0} SELECT count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM v0""")
def _(t):
    before = v0(t)
    after = c.delete_keys(before, t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), KEY)
    return c.recover_deleted(before, after, KEY).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("change_audit", "DML-11", f"""
WITH {V0}, {SRC}, j AS (SELECT coalesce(v0.o_orderkey, src.o_orderkey) AS o_orderkey,
   CASE WHEN v0.o_orderkey IS NULL THEN 'INSERT' WHEN src.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
   v0.o_orderstatus AS old_value, src.o_orderstatus AS new_value FROM v0 FULL JOIN src ON v0.o_orderkey = src.o_orderkey)
SELECT o_orderkey, operation, 'o_orderstatus' AS column_name, old_value, new_value FROM j WHERE old_value IS DISTINCT FROM new_value""")
def _(t):
    return c.change_audit(v0(t), source(t), KEY, ["o_orderstatus"])


@query("backfilled_column", "DML-12", f"""
WITH {V0}, {SRC} SELECT batch, count(*) AS n FROM (SELECT 'legacy' AS batch FROM v0 UNION ALL SELECT 'b1' FROM src) GROUP BY 1""")
def _(t):
    merged = c.append_merged(v0(t), source(t).withColumn("batch", F.lit("b1")))
    return c.backfill(merged, "batch", F.lit("legacy")).groupBy("batch").agg(F.count("*").alias("n"))


@query("registry_upsert", "DML-14", """
WITH r AS (SELECT p_brand AS name, min(p_type) AS kind, 1 AS version FROM part GROUP BY 1),
     e AS (SELECT p_brand AS name, max(p_type) AS kind FROM part WHERE p_size > 48 GROUP BY 1 UNION ALL SELECT 'New', 'X')
SELECT name, kind, version FROM r WHERE name NOT IN (SELECT name FROM e) UNION ALL
SELECT e.name, e.kind, coalesce(version + 1, 1) FROM e LEFT JOIN r USING (name)""")
def _(t):
    registry = t.part.groupBy(F.col("p_brand").alias("name")).agg(F.min("p_type").alias("kind")).withColumn(
        "version", F.lit(1))
    entries = (t.part.filter(F.col("p_size") > 48).groupBy(F.col("p_brand").alias("name"))
               .agg(F.max("p_type").alias("kind")))
    entries = entries.unionByName(t.spark.range(1).select(F.lit("New").alias("name"), F.lit("X").alias("kind")))
    return c.registry_upsert(registry, entries, "name", ["kind"])

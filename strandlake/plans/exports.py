"""Files written and read back, tables made from queries, schema and quality reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strandlake.operators import changes, lookups, quality
from strandlake.plans.registry import query
from strandlake.session import scratch_path
from strandlake.sources import sinks, tabular


@query("json_array_lists", "SRC-06 ARR-01", """
SELECT p_type AS type, count(DISTINCT p_brand) AS brands FROM part GROUP BY 1""")
def _(t):
    """One JSON array with an object per brand, each with a list of its types."""
    brands = t.part.groupBy("p_brand").agg(F.collect_set("p_type").alias("types"))
    path = scratch_path(t.spark, "brands")
    sinks.write_text(brands.agg(F.to_json(F.collect_list(F.struct("p_brand", "types"))).alias("value")), path)
    back = tabular.read_json_array(t.spark, path, "p_brand string, types array<string>")
    return back.select("p_brand", F.explode("types").alias("type")).groupBy("type").agg(F.count("*").alias("brands"))


@query("expression_matrix_file", "SRC-09", """
SELECT p_brand AS "Description", count(*) AS genes, CAST(sum(CAST(p_size AS DECIMAL(18,2))) AS DOUBLE) AS s1,
  count(CASE WHEN p_size % 5 > 0 THEN 1 END) AS s2_cells FROM part GROUP BY 1""")
def _(t):
    """A matrix file with version, counts and header lines; every fifth size leaves a cell empty."""
    size = F.col("p_size").cast("string")
    rows = t.part.select(F.concat_ws("\t", F.concat(F.lit("g"), F.col("p_partkey").cast("string")), "p_brand", size,
                                     F.when(F.col("p_size") % 5 > 0, size).otherwise("")).alias("value"))
    head = t.spark.createDataFrame([("#1.2",), ("7\t2",), ("Name\tDescription\tS1\tS2",)], "value string")
    path = scratch_path(t.spark, "matrix")
    sinks.write_text(head.unionByName(rows), path)
    cells = tabular.expression_matrix(t.spark, path, ["S1", "S2"])
    return cells.groupBy("Description").agg(F.count("*").alias("genes"), F.sum("S1").alias("s1"), F.count("S2").alias("s2_cells"))


@query("created_table", "SNK-04", "SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS highest FROM orders GROUP BY 1")
def _(t):
    name = f"orders_by_status_{uuid.uuid4().hex}"
    summary = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("highest"))
    path = scratch_path(t.spark, "table")
    sinks.create_table_as(summary, name, path)
    count = t.spark.table(name).count()
    t.spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return tabular.read_parquet(t.spark, path).filter(F.lit(count) > 0)


@query("appended_batches", "DML-13", "SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_orderkey) AS keys FROM orders GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "batches")
    sinks.append_batches([t.orders.filter(F.col("o_orderkey") % 3 == k) for k in range(3)], path)
    return tabular.read_parquet(t.spark, path).groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("keys"))


@query("exported_rows_that_differ", "SNK-07 SNK-02", "SELECT 'customer' AS table_name, count(*) AS n, 0::BIGINT AS lost FROM customer")
def _(t):
    """Rows of an export that do not come back as they were."""
    path = scratch_path(t.spark, "export")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    sinks.write_delimited(rows, path)
    back = tabular.read_csv(t.spark, path, "c_custkey bigint, c_name string, c_acctbal double")
    same = sinks.round_trip_equal(rows, back)
    lost = rows.exceptAll(back).agg(F.count("*").alias("lost"))
    return back.agg(F.lit("customer").alias("table_name"), F.count("*").alias("n")).crossJoin(
        F.broadcast(lost)).filter(F.lit(same) | (F.col("lost") > 0))


@query("schema_differences", "DML-08", """
SELECT * FROM (VALUES ('o_orderstatus', 'only_left', 'string', NULL), ('batch', 'only_right', NULL, 'int'),
  ('o_totalprice', 'type_mismatch', 'double', 'string')) AS r(column_name, finding, left_type, right_type)""")
def _(t):
    other = t.orders.drop("o_orderstatus").withColumns({"batch": F.lit(1), "o_totalprice": F.col("o_totalprice").cast("string")})
    return changes.schema_differences(t.orders, other)


@query("quality_log", "DQ-15", """
SELECT 2::BIGINT AS log_id, 'orders' AS stage, true AS is_valid, '[]' AS errors, '["' || count(*) || ' open orders"]' AS warnings
  FROM orders WHERE o_orderstatus = 'O' UNION ALL
SELECT 1, 'lineitem', false, '["' || count(*) || ' rows above 45"]', '[]' FROM lineitem WHERE l_quantity > 45""")
def _(t):
    log = t.spark.createDataFrame([], "log_id bigint, stage string, is_valid boolean, errors string, warnings string, logged_at timestamp")
    many = t.lineitem.filter(F.col("l_quantity") > 45).count()
    opened = t.orders.filter(F.col("o_orderstatus") == "O").count()
    log = quality.log_entry(t.spark, log, "lineitem", many == 0, [f"{many} rows above 45"], [])
    log = quality.log_entry(t.spark, log, "orders", True, [], [f"{opened} open orders"])
    return quality.recent_log(log, 2).drop("logged_at")


@query("children_kept", "DQ-05", """
SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1""")
def _(t):
    parents = t.orders.filter(F.col("o_orderstatus") != "P")
    rows = quality.without_orphans(t.lineitem.select("l_orderkey", "l_returnflag"), parents, "l_orderkey", "o_orderkey")
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("report_overloads", "UDF-09", """
SELECT 'run' AS asked, p_brand AS run_id, count(*) AS n FROM part WHERE p_brand = 'Brand#3' GROUP BY 2 UNION ALL
SELECT 'metric', p_brand, count(*) FROM part WHERE p_size = 7 GROUP BY 2""")
def _(t):
    view = t.part.select(F.col("p_brand").alias("run_id"), F.col("p_size").alias("metric_id"))
    both = [lookups.report_by_run(view, "Brand#3").withColumn("asked", F.lit("run")),
            lookups.report_by_metric(view, 7).withColumn("asked", F.lit("metric"))]
    return both[0].unionByName(both[1]).groupBy("asked", "run_id").agg(F.count("*").alias("n"))


@query("row_function_classes", "UDF-01", """
SELECT CASE WHEN l_linenumber = 1 THEN 'unknown' WHEN l_linenumber % 3 = 0 THEN 'insertion' WHEN l_linenumber % 3 = 1 THEN 'SNV'
  ELSE 'deletion' END AS kind, count(*) AS n FROM lineitem GROUP BY 1""")
def _(t):
    line = F.col("l_linenumber")
    ref = F.when(line % 3 == 2, "AT").otherwise("A")
    alt = F.when(line == 1, F.lit(None)).when(line % 3 == 0, "AT").otherwise("G")
    pairs = t.lineitem.select(ref.alias("ref"), alt.alias("alt"))
    return pairs.select(lookups.variant_type_udf()("ref", "alt").alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))

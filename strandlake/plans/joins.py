"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions.numeric import exact_mean, exact_sum, half_up
from strandlake.operators import intervals, joins
from strandlake.plans.registry import exact_mean as MEAN
from strandlake.plans.registry import exact_sum as SUM
from strandlake.plans.registry import half_up as HU
from strandlake.plans.registry import query



def urgent(t):
    return t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")


URGENT = "(SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT')"


@query("inner_join", "JOIN-01", f"""
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN {URGENT} ON c_custkey = o_custkey""")
def _(t):
    return t.customer.select("c_custkey", "c_name").join(urgent(t), "c_custkey")


@query("left_join", "JOIN-02", f"""
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN {URGENT} ON c_custkey = o_custkey""")
def _(t):
    return t.customer.select("c_custkey", "c_name").join(urgent(t), "c_custkey", "left")


@query("right_join", "JOIN-03", """
SELECT o_orderkey, c_custkey, c_name FROM orders RIGHT JOIN
  (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON c_custkey = o_custkey""")
def _(t):
    building = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    calls = t.orders.select("o_orderkey", "o_custkey")
    return (calls.join(building, F.col("c_custkey") == F.col("o_custkey"), "right")
            .select("o_orderkey", "c_custkey", "c_name"))


@query("full_join", "JOIN-04 SRT-01", """
WITH a AS (SELECT l_partkey, count(*) AS n_r FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 HAVING max(l_quantity) = 50),
     b AS (SELECT l_partkey, count(*) AS n_a FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1 HAVING min(l_quantity) = 1)
SELECT l_partkey, n_r, n_a FROM a FULL JOIN b USING (l_partkey) ORDER BY n_r NULLS LAST""")
def _(t):
    def counts(flag, rule, name):
        return (t.lineitem.filter(F.col("l_returnflag") == flag).groupBy("l_partkey")
                .agg(F.count("*").alias(name), rule.alias("_kept")).filter("_kept").drop("_kept"))

    quantity = F.col("l_quantity")
    return (counts("R", F.max(quantity) == 50, "n_r").join(counts("A", F.min(quantity) == 1, "n_a"), "l_partkey", "full")
            .orderBy(F.asc_nulls_last("n_r")))


@query("report_grid", "JOIN-05", """
SELECT c_mktsegment, o_orderpriority, coalesce(n, 0) AS n
FROM (SELECT DISTINCT c_mktsegment FROM customer) CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders)
LEFT JOIN (SELECT c_mktsegment, o_orderpriority, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey
           WHERE o_totalprice > 499000 GROUP BY 1, 2) USING (c_mktsegment, o_orderpriority)""")
def _(t):
    facts = (t.orders.filter(F.col("o_totalprice") > 499000)
             .join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", "o_orderpriority"))
    return joins.report_grid(facts, "c_mktsegment", "o_orderpriority", t.customer, t.orders)


@query("self_pairs_gap", "JOIN-06 JOIN-11", """
SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b
ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey AND abs(a.s_acctbal - b.s_acctbal) > 2000""")
def _(t):
    a, b = t.supplier.alias("a"), t.supplier.alias("b")
    on = ((F.col("a.s_nationkey") == F.col("b.s_nationkey")) & (F.col("a.s_suppkey") < F.col("b.s_suppkey"))
          & (F.abs(F.col("a.s_acctbal") - F.col("b.s_acctbal")) > 2000))
    return a.join(b, on).select(F.col("a.s_suppkey").alias("a"), F.col("b.s_suppkey").alias("b"))


@query("four_table_chain", "JOIN-07 JOIN-08", """
SELECT n_name, c_mktsegment, count(DISTINCT o_orderkey) AS calls, count(l_orderkey) AS variants
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN orders ON o_custkey = c_custkey
LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def _(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"))
    return (t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(lines, "o_orderkey", "left")
            .join(t.customer, "c_custkey").withColumn("n_nationkey", F.col("c_nationkey"))
            .join(t.nation, "n_nationkey").groupBy("n_name", "c_mktsegment")
            .agg(F.count("*").alias("calls"), F.coalesce(F.sum("n_lines"), F.lit(0)).alias("variants")))


TIERS = [("small", 0.0, 100000.0), ("medium", 100000.0, 300000.0), ("large", 300000.0, 1e12)]


@query("tier_range_join", "JOIN-09 SRC-16", """
SELECT tier, o_orderstatus, count(*) AS n FROM orders JOIN
  (VALUES ('small', 0.0, 100000.0), ('medium', 100000.0, 300000.0), ('large', 300000.0, 1e12)) v(tier, lo, hi)
ON o_totalprice >= lo AND o_totalprice < hi GROUP BY 1, 2""")
def _(t):
    rows = t.orders.select("o_orderstatus", "o_totalprice")
    return (joins.tier_lookup(rows, "o_totalprice", joins.tiers(t.spark, TIERS))
            .groupBy("tier", "o_orderstatus").agg(F.count("*").alias("n")))


def part_intervals(t):
    return t.part.select((F.col("p_partkey") % 25).alias("chrom"), (F.col("p_partkey") * 3).alias("start"),
                         (F.col("p_partkey") * 3 + F.col("p_size")).alias("end"), F.col("p_partkey").alias("gene"))


def line_points(t):
    return t.lineitem.select((F.col("l_orderkey") % 25).alias("chrom"), (F.col("l_partkey") * 3 + 7).alias("pos"),
                             "l_orderkey", "l_linenumber")


@query("interval_annotate", "JOIN-10 JOIN-17", """
WITH g AS (SELECT p_partkey % 25 AS chrom, p_partkey * 3 AS s, p_partkey * 3 + p_size AS e, p_partkey AS gene FROM part),
     v AS (SELECT l_orderkey % 25 AS chrom, l_partkey * 3 + 7 AS pos FROM lineitem)
SELECT gene, count(*) AS n, min(pos) AS lo, max(pos) AS hi FROM v JOIN g ON g.chrom = v.chrom AND pos BETWEEN s AND e
GROUP BY 1""")
def _(t):
    hits = intervals.annotate_points(line_points(t), part_intervals(t), 64)
    return hits.groupBy("gene").agg(F.count("*").alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))


@query("interval_annotate_left", "JOIN-10", """
WITH g AS (SELECT p_partkey % 25 AS chrom, p_partkey * 3 AS s, p_partkey * 3 + p_size AS e, p_partkey AS gene FROM part),
     v AS (SELECT l_orderkey % 25 AS chrom, l_partkey * 3 + 7 AS pos FROM lineitem)
SELECT v.chrom, count(gene) AS annotated, count(*) - count(gene) AS unannotated
FROM v LEFT JOIN g ON g.chrom = v.chrom AND pos BETWEEN s AND e GROUP BY 1""")
def _(t):
    hits = intervals.annotate_points(line_points(t), part_intervals(t), 64, how="left")
    return hits.groupBy("chrom").agg(F.count("gene").alias("annotated"),
                                     (F.count("*") - F.count("gene")).alias("unannotated"))


@query("interval_overlaps", "JOIN-18", """
WITH a AS (SELECT p_partkey % 25 AS c, p_partkey * 3 AS s, p_partkey * 3 + p_size AS e, p_partkey AS gene FROM part),
     b AS (SELECT c_custkey % 25 AS c, c_custkey * 4 AS s, c_custkey * 4 + 30 AS e, c_custkey AS tgt FROM customer)
SELECT gene, tgt, greatest(a.s, b.s) AS overlap_start, least(a.e, b.e) AS overlap_end
FROM a JOIN b ON a.c = b.c AND a.s < b.e AND b.s < a.e""")
def _(t):
    key = F.col("c_custkey")
    targets = t.customer.select((key % 25).alias("chrom"), (key * 4).alias("start"), (key * 4 + 30).alias("end"),
                                key.alias("tgt"))
    hits = intervals.overlaps(part_intervals(t), targets, 64)
    return hits.select("gene", F.col("tgt_b").alias("tgt"), "overlap_start", "overlap_end")


@query("row_vs_group_avg", "JOIN-12", f"""
WITH m AS (SELECT o_custkey, {MEAN('o_totalprice', 2)} AS group_mean FROM orders GROUP BY 1)
SELECT o_orderkey, o_custkey, group_mean, o_totalprice - group_mean AS delta FROM orders JOIN m USING (o_custkey)""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.with_group_mean(rows, "o_custkey", F.col("o_totalprice"), exact_mean("o_totalprice", 2)).drop(
        "o_totalprice")


@query("anti_join", "JOIN-13", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""")
def _(t):
    big = t.orders.filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(big, "c_custkey", "left_anti")


@query("semi_join", "JOIN-14", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def _(t):
    big = t.orders.filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(big, "c_custkey", "left_semi")


@query("natural_join", "JOIN-15", """
SELECT c_nationkey, n, total FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1)
NATURAL JOIN (SELECT s_nationkey AS c_nationkey, count(*) AS total FROM supplier GROUP BY 1)""")
def _(t):
    return t.sql("""SELECT c_nationkey, n, total FROM (SELECT c_nationkey, count(*) AS n FROM {customer} GROUP BY 1)
        NATURAL JOIN (SELECT s_nationkey AS c_nationkey, count(*) AS total FROM {supplier} GROUP BY 1)""",
                 ("customer", "supplier"))


@query("prefix_join", "JOIN-16", """
WITH p AS (SELECT DISTINCT substr(c_name, 1, 16) AS case_id FROM customer)
SELECT case_id, count(*) AS n, min(c_custkey) AS lo FROM customer JOIN p ON c_name LIKE case_id || '%' GROUP BY 1""")
def _(t):
    cases = t.customer.select(F.substring("c_name", 1, 16).alias("case_id")).distinct()
    return (joins.prefix_join(t.customer, "c_name", cases, "case_id", 16).groupBy("case_id")
            .agg(F.count("*").alias("n"), F.min("c_custkey").alias("lo")))


@query("prefix_join_any_length", "JOIN-16", """
WITH p AS (SELECT DISTINCT p_brand AS stem FROM part WHERE length(p_brand) = 7 UNION
           SELECT DISTINCT substr(p_brand, 1, 8) FROM part WHERE p_brand LIKE 'Brand#2%' AND length(p_brand) = 8)
SELECT stem, count(*) AS n FROM part JOIN p ON starts_with(p_brand, stem) GROUP BY 1""")
def _(t):
    brand = F.col("p_brand")
    short = t.part.filter(F.length(brand) == 7).select(brand.alias("stem"))
    longer = t.part.filter(brand.like("Brand#2%") & (F.length(brand) == 8)).select(F.substring(brand, 1, 8).alias("stem"))
    stems = short.union(longer).distinct()
    return joins.prefix_join_any(t.part, "p_brand", stems, "stem").groupBy("stem").agg(F.count("*").alias("n"))


@query("paired_rows", "JOIN-19", """
SELECT pair_id, min(q1) AS q1, min(q2) AS q2 FROM (
  SELECT a.pair_id, a.q AS q1, b.q AS q2 FROM
   (SELECT 'r' || l_orderkey AS pair_id, l_quantity AS q FROM lineitem WHERE l_linenumber = 1) a JOIN
   (SELECT 'r' || l_orderkey AS pair_id, l_quantity AS q FROM lineitem WHERE l_linenumber = 2) b USING (pair_id))
GROUP BY 1""")
def _(t):
    def mate(n):
        return (t.lineitem.filter(F.col("l_linenumber") == n)
                .groupBy(F.concat(F.lit("r"), F.col("l_orderkey").cast("string"), F.lit(f"/{n}")).alias("read_id"))
                .agg(F.min("l_quantity").alias("q")))

    return joins.paired_reads(mate(1), mate(2), ["q"])


@query("two_nearest", "JOIN-20 GRF-01", """
WITH p AS (SELECT c_custkey AS id, c_acctbal AS x, (c_custkey * 37 % 9000)::DOUBLE AS y FROM customer),
     s AS (SELECT s_suppkey AS sid, s_acctbal AS x, (s_suppkey * 91 % 9000)::DOUBLE AS y FROM supplier),
     d AS (SELECT id, sid, sqrt((p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y)) AS d FROM p, s),
     r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, sid) AS rn FROM d)
SELECT a.id AS point_id, b.sid AS source, a.sid AS target, """ + HU("a.d", 6) + """ AS distance
FROM r a JOIN r b ON a.id = b.id AND a.rn = 1 AND b.rn = 2 WHERE a.d < 800""")
def _(t):
    key = F.col("c_custkey")
    points = t.customer.select(key.alias("point_id"), F.col("c_acctbal").alias("x"),
                               (key * 37 % 9000).cast("double").alias("y"))
    skey = F.col("s_suppkey")
    sites = t.supplier.select(skey.alias("site_id"), F.col("s_acctbal").alias("x"),
                              (skey * 91 % 9000).cast("double").alias("y"))
    return joins.two_nearest(points, sites, 800.0).withColumn("distance", half_up(F.col("distance"), 6))


@query("training_set_join", "JOIN-22 FEA-12", f"""
SELECT c_custkey, c_acctbal, n_orders, spend, c_mktsegment AS label FROM customer JOIN (
  SELECT o_custkey, count(*) AS n_orders, {SUM('o_totalprice', 2)} AS spend FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def _(t):
    features = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return joins.join_with_counts(
        t.customer.select("c_custkey", "c_acctbal", F.col("c_mktsegment").alias("label")), features, "c_custkey",
        "inner", {"n_orders": F.count("*"), "spend": exact_sum("o_totalprice", 2)})


@query("known_lookup", "JOIN-24 JOIN-23", """
WITH k AS (SELECT l_suppkey AS chrom, l_partkey AS pos, min(l_returnflag) AS significance FROM lineitem
           WHERE l_returnflag = 'R' AND l_quantity > 45 GROUP BY 1, 2)
SELECT v.chrom, count(*) AS n, count(significance) AS known FROM
  (SELECT l_suppkey AS chrom, l_partkey AS pos FROM lineitem) v LEFT JOIN k USING (chrom, pos) GROUP BY 1""")
def _(t):
    rows = t.lineitem.select(F.col("l_suppkey").alias("chrom"), F.col("l_partkey").alias("pos"), "l_returnflag",
                             "l_quantity")
    known = (rows.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).groupBy("chrom", "pos")
             .agg(F.min("l_returnflag").alias("significance")))
    return (joins.known_lookup(rows.select("chrom", "pos"), known, ["chrom", "pos"]).groupBy("chrom")
            .agg(F.count("*").alias("n"), F.count_if("is_known").alias("known")))

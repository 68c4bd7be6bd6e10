"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions import text
from strandlake.functions.numeric import exact_mean, exact_sum, fixed, half_up, percent, ratio
from strandlake.operators import aggregates as a
from strandlake.operators.quantiles import exact_quantiles, quantile_columns
from strandlake.plans.registry import exact_mean as MEAN
from strandlake.plans.registry import exact_sum as SUM
from strandlake.plans.registry import half_up as HU
from strandlake.plans.registry import query



@query("group_stats_pass_rate", "AGG-03 AGG-09 SRT-01", f"""
SELECT l_returnflag, l_linestatus, count(*) AS n, {MEAN('l_quantity', 2)} AS mean_depth,
       {SUM('l_extendedprice', 2)} AS total_price, {MEAN('l_discount', 2)} AS mean_frequency,
       count(*) FILTER (l_quantity >= 30 AND l_discount >= 0.02) AS n_pass,
       (count(*) FILTER (l_quantity >= 30 AND l_discount >= 0.02)) * 100.0::DOUBLE / count(*) AS pass_rate
FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2""")
def _(t):
    passed = F.count_if((F.col("l_quantity") >= 30) & (F.col("l_discount") >= 0.02))
    return (t.lineitem.groupBy("l_returnflag", "l_linestatus")
            .agg(F.count("*").alias("n"), exact_mean("l_quantity", 2).alias("mean_depth"),
                 exact_sum("l_extendedprice", 2).alias("total_price"), exact_mean("l_discount", 2).alias("mean_frequency"),
                 passed.alias("n_pass"), percent(passed, F.count("*")).alias("pass_rate"))
            .orderBy("l_returnflag", "l_linestatus"))


@query("global_totals", "AGG-01 UDF-07", f"""
SELECT count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi, {HU(MEAN('o_totalprice', 2))} AS mean,
       {SUM('o_totalprice', 2)} AS total FROM orders""")
def _(t):
    return t.orders.agg(F.count("*").alias("n"), F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"),
                        half_up(exact_mean("o_totalprice", 2)).alias("mean"), exact_sum("o_totalprice", 2).alias("total"))


@query("having_filter", "AGG-04 AGG-02", f"""
SELECT o_custkey, count(*) AS n, {MEAN('o_totalprice', 2)} AS mean FROM orders GROUP BY 1
HAVING count(*) > 10 AND {MEAN('o_totalprice', 2)} > 200000 ORDER BY n DESC, o_custkey""")
def _(t):
    g = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), exact_mean("o_totalprice", 2).alias("mean"))
    return g.filter((F.col("n") > 10) & (F.col("mean") > 200000)).orderBy(F.desc("n"), "o_custkey")


@query("filtered_counts", "AGG-05 AGG-16", """
SELECT p_type, count(*) AS n, count(*) FILTER (p_size > 25) AS large, count(*) FILTER (p_size <= 10) AS small,
       (count(*) FILTER (p_size > 25))::DOUBLE / nullif(count(*) FILTER (p_size <= 10), 0) AS large_to_small
FROM part GROUP BY 1""")
def _(t):
    large, small = F.count_if(F.col("p_size") > 25), F.count_if(F.col("p_size") <= 10)
    return t.part.groupBy("p_type").agg(F.count("*").alias("n"), large.alias("large"), small.alias("small"),
                                        ratio(large, F.nullif(small, F.lit(0))).alias("large_to_small"))


@query("fold_change", "AGG-06 AGG-30 MTH-01", f"""
SELECT l_suppkey, {HU('mean_treated', 12)} AS mean_treated, {HU('mean_control', 12)} AS mean_control,
       {HU('mean_treated - mean_control', 12)} AS delta, {HU('mean_treated / nullif(mean_control, 0)', 9)} AS fold_change,
       {HU('log2(mean_treated / nullif(mean_control, 0))', 9)} AS log2_fold_change
FROM (SELECT l_suppkey, avg(CASE WHEN l_returnflag = 'R' THEN l_quantity / 1000 END) AS mean_treated,
             avg(CASE WHEN l_returnflag = 'N' THEN l_quantity / 1000 END) AS mean_control FROM lineitem GROUP BY 1)
ORDER BY abs(mean_treated - mean_control) DESC""")
def _(t):
    small = t.lineitem.select("l_suppkey", "l_returnflag", (F.col("l_quantity") / 1000).alias("small"))
    out = a.fold_change(small, "l_suppkey", "small", "l_returnflag", "R", "N")
    digits = {"mean_treated": 12, "mean_control": 12, "delta": 12, "fold_change": 9, "log2_fold_change": 9}
    return out.withColumns({c: half_up(F.col(c), n) for c, n in digits.items()}).orderBy(F.desc(F.abs("delta")))


@query("distinct_counts", "AGG-07", """
SELECT o_orderpriority, count(DISTINCT o_custkey) AS samples, count(DISTINCT o_orderdate) AS days,
       count(DISTINCT o_orderstatus) AS states FROM orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy("o_orderpriority").agg(
        F.countDistinct("o_custkey").alias("samples"), F.countDistinct("o_orderdate").alias("days"),
        F.countDistinct("o_orderstatus").alias("states"))


@query("group_deviation", "AGG-08 AGG-31", f"""
SELECT l_suppkey, {HU('stddev_samp(l_quantity)', 6)} AS std,
       {HU('coalesce(stddev_samp(l_quantity) / nullif(avg(l_quantity), 0), 0)', 6)} AS cv FROM lineitem GROUP BY 1""")
def _(t):
    std = t.lineitem.groupBy("l_suppkey").agg(half_up(F.stddev_samp("l_quantity"), 6).alias("std"),
                                              half_up(F.coalesce(ratio(F.stddev_samp("l_quantity"), F.avg("l_quantity")),
                                                                 F.lit(0.0)), 6).alias("cv"))
    return std


@query("pass_rate_pairs", "AGG-09 AGG-38", f"""
SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (l_tax <= 0.04) AS n_pass,
       (count(*) FILTER (l_tax <= 0.04)) * 100.0::DOUBLE / count(*) AS pass_rate FROM lineitem GROUP BY 1, 2""")
def _(t):
    return a.group_pass_rate(t.lineitem, ["l_returnflag", "l_linestatus"], F.col("l_tax") <= 0.04)


@query("dynamic_pivot", "AGG-11", """
SELECT p_brand, count(*) FILTER (p_type = 'ECONOMY') AS "ECONOMY", count(*) FILTER (p_type = 'LARGE') AS "LARGE",
       count(*) FILTER (p_type = 'MEDIUM') AS "MEDIUM", count(*) FILTER (p_type = 'PROMO') AS "PROMO",
       count(*) FILTER (p_type = 'SMALL') AS "SMALL", count(*) FILTER (p_type = 'STANDARD') AS "STANDARD"
FROM part GROUP BY 1""")
def _(t):
    return a.pivot_counts(t.part, "p_brand", "p_type", a.distinct_values(t.part, "p_type"))


@query("ordered_list", "AGG-13", """
SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS items FROM part GROUP BY 1""")
def _(t):
    return a.ordered_list(t.part, ["p_brand"], "p_type")


@query("mode_per_group", "AGG-14", """
SELECT l_suppkey, mode, n FROM (SELECT l_suppkey, l_quantity AS mode, count(*) AS n,
  row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_quantity) AS rn FROM lineitem GROUP BY 1, 2)
WHERE rn = 1""")
def _(t):
    return a.mode_per_group(t.lineitem, ["l_suppkey"], "l_quantity")


@query("gold_centrals", "AGG-15", f"""
SELECT p_brand, count(DISTINCT l_orderkey) AS calls, count(*) AS variants, {MEAN('l_discount', 2)} AS mean_frequency,
       {MEAN('l_quantity', 2)} AS mean_depth FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def _(t):
    return (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand")
            .agg(F.countDistinct("l_orderkey").alias("calls"), F.count("*").alias("variants"),
                 exact_mean("l_discount", 2).alias("mean_frequency"), exact_mean("l_quantity", 2).alias("mean_depth")))


@query("column_quartiles", "AGG-17 AGG-19 DQ-09", f"""
SELECT o_orderstatus, count(*) AS n, {HU('quantile_cont(o_totalprice, 0.25)', 6)} AS q25, {HU('quantile_cont(o_totalprice, 0.5)', 6)} AS q50,
       {HU('quantile_cont(o_totalprice, 0.75)', 6)} AS q75, {HU('quantile_cont(o_totalprice, 0.99)', 6)} AS q99 FROM orders GROUP BY 1""")
def _(t):
    counts = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    quartiles = quantile_columns(t.orders, ["o_orderstatus"], "o_totalprice",
                                 {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q99": 0.99})
    rounded = [half_up(F.col(c), 6).alias(c) for c in ("q25", "q50", "q75", "q99")]
    return counts.join(quartiles.select("o_orderstatus", *rounded), "o_orderstatus")


@query("summarize_columns", "AGG-18 AGG-20 DQ-08", """
WITH s AS (
  SELECT 'o_orderkey' AS column_name, 'bigint' AS dtype, count(x) AS n, count(*) - count(x) AS missing, count(DISTINCT x) AS "unique", avg(x) AS mean, stddev_samp(x) AS std,
         min(x)::VARCHAR AS "min", max(x)::VARCHAR AS "max", quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q75 FROM (SELECT o_orderkey AS x FROM orders) UNION ALL
  SELECT 'o_totalprice', 'double', count(x), count(*) - count(x), count(DISTINCT x), avg(x), stddev_samp(x), NULL, NULL, quantile_cont(x, 0.25), quantile_cont(x, 0.5), quantile_cont(x, 0.75)
         FROM (SELECT o_totalprice AS x FROM orders) UNION ALL
  SELECT 'o_orderpriority', 'string', count(x), count(*) - count(x), count(DISTINCT x), NULL, NULL, min(x), max(x), NULL, NULL, NULL FROM (SELECT o_orderpriority AS x FROM orders) UNION ALL
  SELECT 'big_price', 'double', count(x), count(*) - count(x), count(DISTINCT x), avg(x), stddev_samp(x), NULL, NULL, quantile_cont(x, 0.25), quantile_cont(x, 0.5), quantile_cont(x, 0.75)
         FROM (SELECT CASE WHEN o_totalprice > 250000 THEN o_totalprice END AS x FROM orders))
SELECT column_name, dtype, n, missing, missing * 100.0::DOUBLE / (n + missing) AS missing_pct, "unique", """ + ", ".join(
    HU(c, 4) + f" AS {c}" for c in ("mean", "std", "q25", "median", "q75")) + """, "min", "max" FROM s""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority",
                           F.when(F.col("o_totalprice") > 250000, F.col("o_totalprice")).alias("big_price"))
    out = a.column_summary(rows, ["o_orderkey", "o_totalprice", "o_orderpriority", "big_price"], exact_unique=True)
    text_only = F.col("column_name").isin("o_orderkey", "o_orderpriority")  # two engines write doubles as text differently
    return out.select("column_name", "dtype", "n", "missing", "missing_pct", "unique", *[
        half_up(F.col(c), 4).alias(c) for c in ("mean", "std", "q25", "median", "q75")],
        F.when(text_only, F.col("min")).alias("min"), F.when(text_only, F.col("max")).alias("max"))


@query("above_average", "AGG-21", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)
  AND o_orderstatus = 'P'""")
def _(t):
    mean = t.orders.select(exact_mean("o_totalprice", 2)).scalar()
    return (t.orders.filter((F.col("o_totalprice") > mean) & (F.col("o_orderstatus") == "P"))
            .select("o_orderkey", "o_totalprice"))


@query("latest_per_group", "AGG-22", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def _(t):
    return a.latest_per_group(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"])


@query("mergeable_statistics", "AGG-23 AGG-24 UDF-11", """
SELECT l_returnflag, sum(l_quantity) AS "sum", count(*) AS "count", min(l_quantity) AS "min", max(l_quantity) AS "max",
       sum(l_quantity) / count(*) AS mean FROM lineitem GROUP BY 1""")
def _(t):
    late = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    parts = [a.partial_statistics(t.lineitem.filter(c), ["l_returnflag"], F.col("l_quantity")) for c in (late, ~late)]
    return a.merge_statistics(parts[0].unionByName(parts[1]), ["l_returnflag"])


@query("volume_by_period", "AGG-25 AGG-26 DAT-03", """
WITH c AS (SELECT year(o_orderdate)::INT AS y, quarter(o_orderdate)::INT AS q, o_orderstatus, count(*) AS n
           FROM orders GROUP BY 1, 2, 3)
SELECT y, q, o_orderstatus, n, n::DOUBLE / (sum(n) OVER (PARTITION BY y, q))::DOUBLE AS share FROM c""")
def _(t):
    rows = t.orders.select(F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"), "o_orderstatus")
    return a.share_within(rows, ["y", "q", "o_orderstatus"], ["y", "q"])


@query("cooccurrence_pairs", "AGG-27", """
WITH s AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
SELECT a.l_partkey AS item_a, b.l_partkey AS item_b, count(*) AS n_groups FROM s a JOIN s b
ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""")
def _(t):
    return a.top_pairs(t.lineitem, "l_orderkey", "l_partkey", 10)


@query("cohort_activity", "AGG-28 DAT-02", """
WITH f AS (SELECT o_custkey, min(o_orderdate) AS d0 FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT year(d0)::INT AS cohort_year, month(d0)::INT AS cohort_month, date_diff('month', d0, o_orderdate)::INT AS months_since_first,
       count(DISTINCT o_custkey) AS active, count(DISTINCT o_orderkey) AS events
FROM orders JOIN f USING (o_custkey) WHERE o_orderstatus = 'F' GROUP BY 1, 2, 3""")
def _(t):
    passed = t.orders.filter(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderdate", "o_orderkey")
    return a.cohort_activity(passed, "o_custkey", "o_orderdate", "o_orderkey")


@query("cohort_retention", "AGG-29 DAT-02", """
WITH c AS (SELECT o_custkey, min(o_orderdate) AS d0 FROM orders GROUP BY 1),
     j AS (SELECT c.o_custkey, d0, date_diff('month', d0, o_orderdate) AS m FROM c LEFT JOIN
           (SELECT o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F') USING (o_custkey))
SELECT year(d0)::INT AS cohort_year, month(d0)::INT AS cohort_month, count(DISTINCT o_custkey) AS cohort_size,
       count(DISTINCT CASE WHEN m = 0 THEN o_custkey END) * 100.0::DOUBLE / count(DISTINCT o_custkey) AS month_0_pct,
       count(DISTINCT CASE WHEN m = 1 THEN o_custkey END) * 100.0::DOUBLE / count(DISTINCT o_custkey) AS month_1_pct,
       count(DISTINCT CASE WHEN m = 2 THEN o_custkey END) * 100.0::DOUBLE / count(DISTINCT o_custkey) AS month_2_pct,
       count(DISTINCT CASE WHEN m = 3 THEN o_custkey END) * 100.0::DOUBLE / count(DISTINCT o_custkey) AS month_3_pct
FROM j GROUP BY 1, 2""")
def _(t):
    starts = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("d0"))
    active = t.orders.filter(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderdate")
    return a.cohort_retention(starts, active, "o_custkey", "d0", "o_orderdate")


@query("access_log_counts", "AGG-32 STR-07", """
WITH l AS (SELECT user_id, CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 201 ELSE 200 END AS status FROM events)
SELECT 'u' || user_id AS client, count(*) AS requests, count(*) FILTER (status >= 400) AS errors,
       (count(*) FILTER (status >= 400))::DOUBLE / count(*) AS error_rate
FROM l GROUP BY 1 HAVING count(*) >= 5 AND (count(*) FILTER (status >= 400))::DOUBLE / count(*) >= 0.25""")
def _(t):
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "signup", 201).otherwise(200)
    lines = t.events.select(F.format_string('u%d - - [%s] "GET /%s HTTP/1.1" %d %d', "user_id",
                                            F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), "event_type", status,
                                            F.length("props")).alias("value"))
    return suspicious_clients(text.parse_access_log(lines), 5, 0.25)


def suspicious_clients(log, least: int, rate: float):
    errors = F.count_if(F.col("status") >= 400)
    return (log.groupBy("client").agg(F.count("*").alias("requests"), errors.alias("errors"),
                                      ratio(errors, F.count("*")).alias("error_rate"))
            .filter((F.col("requests") >= least) & (F.col("error_rate") >= rate)))


@query("star_topn", "AGG-33 JOIN-07", f"""
SELECT n_name, c_mktsegment, count(*) AS variants, count(DISTINCT o_orderkey) AS calls,
       {HU(MEAN('l_quantity', 2))} AS mean_depth, {SUM('l_extendedprice', 2)} AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F' AND l_quantity >= 10
GROUP BY 1, 2 ORDER BY revenue DESC, n_name, c_mktsegment LIMIT 15""")
def _(t):
    calls = t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")
    # One row per call first: the big table is reduced on its join key and no distinct count remains.
    per_call = (t.lineitem.filter(F.col("l_quantity") >= 10).groupBy(F.col("l_orderkey").alias("o_orderkey"))
                .agg(F.count("*").alias("n"), F.sum("l_quantity").alias("depth"),
                     F.sum(fixed("l_extendedprice", 2)).alias("price")))
    places = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .select(F.col("c_custkey").alias("o_custkey"), "n_name", "c_mktsegment"))
    return (per_call.join(calls, "o_orderkey").join(places, "o_custkey").groupBy("n_name", "c_mktsegment")
            .agg(F.sum("n").alias("variants"), F.count("*").alias("calls"),
                 half_up(ratio(F.sum("depth"), F.sum("n"))).alias("mean_depth"),
                 F.sum("price").cast("double").alias("revenue"))
            .orderBy(F.desc("revenue"), "n_name", "c_mktsegment").limit(15))


@query("signal_sum", "AGG-34", """
SELECT p_brand, CAST(sum(CAST(l_quantity AS DECIMAL(12,3)) * CAST(l_discount / 1000 AS DECIMAL(12,6))) AS DOUBLE) AS signal
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
WHERE o_orderstatus = 'F' GROUP BY 1""")
def _(t):
    passed = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = (t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_discount").join(passed, "l_orderkey")
            .join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey"))
    return a.signal_sum(rows, ["p_brand"], fixed("l_quantity", 3), fixed(F.col("l_discount") / 1000, 6))


@query("conditional_distinct", "AGG-35 AGG-36", """
SELECT c_custkey, c_mktsegment, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS pathogenic_genes,
       count(DISTINCT CASE WHEN l_returnflag = 'A' THEN l_partkey END) AS uncertain_genes, count(l_partkey) AS variants
FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def _(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_returnflag")
    per_sample = (t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(lines, "o_orderkey")
                  .groupBy("c_custkey", "l_partkey")
                  .agg(F.max((F.col("l_returnflag") == "R").cast("int")).alias("r"),
                       F.max((F.col("l_returnflag") == "A").cast("int")).alias("u"), F.count("*").alias("n"))
                  .groupBy("c_custkey").agg(F.sum("r").alias("r"), F.sum("u").alias("u"), F.sum("n").alias("n")))
    return (t.customer.select("c_custkey", "c_mktsegment").join(per_sample, "c_custkey", "left")
            .select("c_custkey", "c_mktsegment", F.coalesce("r", F.lit(0)).alias("pathogenic_genes"),
                    F.coalesce("u", F.lit(0)).alias("uncertain_genes"), F.coalesce("n", F.lit(0)).alias("variants")))


@query("class_totals", "AGG-37 AGG-38", f"""
SELECT sum((l_returnflag = 'R')::BIGINT)::BIGINT AS pathogenic, sum((l_returnflag = 'A')::BIGINT)::BIGINT AS uncertain,
       sum((l_returnflag = 'N')::BIGINT)::BIGINT AS benign,
       (count(*) FILTER (l_returnflag <> 'N'))::DOUBLE / count(*) AS not_benign,
       count(DISTINCT CASE WHEN l_returnflag = 'N' THEN l_suppkey END) AS samples_with_benign,
       {MEAN('l_quantity', 2)} AS mean_depth FROM lineitem""")
def _(t):
    flag = F.col("l_returnflag")
    return t.lineitem.agg(
        F.count_if(flag == "R").alias("pathogenic"), F.count_if(flag == "A").alias("uncertain"),
        F.count_if(flag == "N").alias("benign"), ratio(F.count_if(flag != "N"), F.count("*")).alias("not_benign"),
        F.countDistinct(F.when(flag == "N", F.col("l_suppkey"))).alias("samples_with_benign"),
        exact_mean("l_quantity", 2).alias("mean_depth"))


@query("best_group_by_mean", "AGG-38", f"""
SELECT p_type, {MEAN('l_quantity', 2)} AS mean_depth FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def _(t):
    return (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type")
            .agg(exact_mean("l_quantity", 2).alias("mean_depth")).orderBy(F.desc("mean_depth"), "p_type").limit(1))


@query("status_counts", "AGG-32 AGG-37", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC")
def _(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query("global_quantiles", "AGG-19 FLT-16", f"""
SELECT 0.1::DOUBLE AS prob, {HU('quantile_cont(l_extendedprice, 0.1)', 6)} AS value FROM lineitem UNION ALL
SELECT 0.5, {HU('quantile_cont(l_extendedprice, 0.5)', 6)} FROM lineitem UNION ALL
SELECT 0.9, {HU('quantile_cont(l_extendedprice, 0.9)', 6)} FROM lineitem""")
def _(t):
    return (exact_quantiles(t.lineitem, [], "l_extendedprice", [0.1, 0.5, 0.9])
            .withColumn("value", half_up(F.col("value"), 6)))

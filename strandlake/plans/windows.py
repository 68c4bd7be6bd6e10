"""Window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions.numeric import exact_sum, half_up
from strandlake.operators import windows as w
from strandlake.plans.registry import exact_sum as SUM
from strandlake.plans.registry import half_up as HU
from strandlake.plans.registry import query



@query("top3_per_group", "WIN-01", """
SELECT l_suppkey, l_orderkey, l_partkey, l_extendedprice, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber, l_quantity) AS rn
  FROM lineitem) WHERE rn <= 3""")
def _(t):
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_partkey", "l_extendedprice", "l_linenumber", "l_quantity")
    return w.top_n(rows, ["l_suppkey"], [F.desc("l_extendedprice"), "l_orderkey", "l_partkey", "l_linenumber",
                                         "l_quantity"], 3).drop("l_linenumber", "l_quantity")


@query("rank_filter", "WIN-02", """
SELECT p_brand, p_partkey, p_size, rnk FROM (
  SELECT p_brand, p_partkey, p_size, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS rnk FROM part)
WHERE rnk <= 2""")
def _(t):
    return w.rank_at_most(t.part.select("p_brand", "p_partkey", "p_size"), ["p_brand"], [F.desc("p_size")], 2)


def sometimes_null(events, key):
    """Every seventh event without its key: NULL is a group like any other."""
    return events.withColumn(key, F.when(F.col("event_id") % 7 > 0, F.col(key)))


@query("running_stats", "WIN-03", """
SELECT event_id, count(*) OVER o AS running_n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) OVER o AS DOUBLE) / count(*) OVER o AS running_mean
FROM (SELECT *, CASE WHEN event_id % 7 > 0 THEN event_type END AS kind FROM events)
WINDOW o AS (PARTITION BY kind ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def _(t):
    rows = sometimes_null(t.events, "event_type").select("event_type", "ts", "event_id", "value")
    out = w.running(rows, ["event_type"], ["ts", "event_id"], None,
                    {"running_n": F.lit(1), "_sum": F.col("value").cast("decimal(18,2)")})
    return out.select("event_id", F.col("running_n").cast("bigint"),
                      (F.col("_sum").cast("double") / F.col("running_n")).alias("running_mean"))


@query("next_gap", "WIN-04 DAT-02", """
SELECT user_id, count(*) AS n, count(*) FILTER (gap < 3600) AS clustered, max(gap) AS widest FROM (
  SELECT user_id, date_diff('second', date_trunc('second', ts),
         date_trunc('second', lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS gap
  FROM (SELECT ts, event_id, CASE WHEN event_id % 7 > 0 THEN user_id END AS user_id FROM events))
GROUP BY 1""")
def _(t):
    rows = w.with_next(sometimes_null(t.events, "user_id").select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"], None,
                       {"next_ts": "ts"})
    gap = F.timestamp_diff("SECOND", F.date_trunc("second", "ts"), F.date_trunc("second", "next_ts"))
    return (rows.withColumn("gap", gap).groupBy("user_id")
            .agg(F.count("*").alias("n"), F.count_if(F.col("gap") < 3600).alias("clustered"),
                 F.max("gap").alias("widest")))


QUARTERLY = """q AS (SELECT l_returnflag, year(l_shipdate) AS y, quarter(l_shipdate) AS q, count(*) AS n
     FROM lineitem GROUP BY 1, 2, 3)"""


def quarterly(t):
    return (t.lineitem.groupBy("l_returnflag", F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q"))
            .agg(F.count("*").alias("n")))


@query("qoq_growth", "WIN-05 AGG-25 DAT-03", "WITH " + QUARTERLY + """
SELECT l_returnflag, y::INT AS y, q::INT AS q, n, lag(n) OVER o AS previous,
       ((n - lag(n) OVER o) * 100.0::DOUBLE) / nullif(lag(n) OVER o, 0) AS growth_pct
FROM q WINDOW o AS (PARTITION BY l_returnflag ORDER BY y, q)""")
def _(t):
    return w.growth(quarterly(t), ["l_returnflag"], ["y", "q"], "n")


@query("centred_average", "WIN-06", "WITH " + QUARTERLY + """
SELECT l_returnflag, y::INT AS y, q::INT AS q, n,
       avg(n) OVER (PARTITION BY l_returnflag ORDER BY y, q ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS centred
FROM q""")
def _(t):
    return w.moving_average(quarterly(t), ["l_returnflag"], ["y", "q"], "n", 1, 1, "centred")


@query("cumulative_rolling", "WIN-07 AGG-25 DAT-03", """
WITH m AS (SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m') AS month, count(*) AS n FROM lineitem GROUP BY 1)
SELECT month, n, (sum(n) OVER (ORDER BY month))::BIGINT AS cumulative_n,
       avg(n) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3 FROM m""")
def _(t):
    m = (t.lineitem.groupBy(F.date_format(F.date_trunc("month", "l_shipdate"), "yyyy-MM").alias("month"))
         .agg(F.count("*").alias("n")))
    return w.moving_average(w.cumulative(m, [], ["month"], "n", "cumulative_n"), [], ["month"], "n", 2, 0, "rolling_3")


BURDEN = "b AS (SELECT o_custkey, count(*) AS n, " + SUM("o_totalprice", 2) + " AS spend FROM orders GROUP BY 1)"


def burden(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), exact_sum("o_totalprice", 2).alias("spend"))


@query("burden_percentile", "WIN-08", "WITH " + BURDEN + """
SELECT o_custkey, n, spend, percent_rank() OVER (ORDER BY n) * 100.0::DOUBLE AS percentile,
       CASE WHEN percent_rank() OVER (ORDER BY n) >= 0.75 THEN 'High Burden'
            WHEN percent_rank() OVER (ORDER BY n) >= 0.25 THEN 'Medium Burden' ELSE 'Low Burden' END AS segment
FROM b""")
def _(t):
    return w.percent_ranks(burden(t), "n")


@query("burden_tercile", "WIN-09", "WITH " + BURDEN + """
, s AS (SELECT b.*, ntile(3) OVER (ORDER BY spend, o_custkey) AS tile FROM b)
SELECT tile::INT AS tile, c_mktsegment, count(*) AS customers, sum(n)::BIGINT AS orders
FROM s JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def _(t):
    tiles = w.with_tiles(burden(t), ["spend", "o_custkey"], 3)
    return (tiles.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
            .groupBy("tile", "c_mktsegment").agg(F.count("*").alias("customers"), F.sum("n").alias("orders")))


@query("surrogate_keys", "WIN-10", """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS call_key, o_orderkey FROM orders""")
def _(t):
    return w.numbered(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"],
                      "call_key").select("call_key", "o_orderkey")


@query("highly_variable", "WIN-11", """
WITH r AS (SELECT p_type, p_partkey, p_size, rank() OVER (PARTITION BY p_type ORDER BY p_size DESC)
                  + (count(*) OVER (PARTITION BY p_type, p_size) - 1) / 2.0::DOUBLE AS avg_rank
           FROM (SELECT p_partkey, p_size, nullif(p_type, 'PROMO') AS p_type FROM part)),
     q AS (SELECT p_type, quantile_cont(avg_rank, 0.2) AS lim FROM r GROUP BY 1)
SELECT r.p_type, p_partkey, p_size, avg_rank, avg_rank <= lim AS highly_variable FROM r JOIN q ON r.p_type IS NOT DISTINCT FROM q.p_type""")
def _(t):
    rows = t.part.select(F.nullif("p_type", F.lit("PROMO")).alias("p_type"), "p_partkey", "p_size")
    return w.top_share_by_rank(rows, ["p_type"], "p_size")


@query("top_brands_per_type", "WIN-12", """
SELECT p_type, p_brand, n, rn FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY n DESC, p_brand) AS rn
  FROM (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2)) WHERE rn <= 3""")
def _(t):
    counts = t.part.groupBy("p_type", "p_brand").agg(F.count("*").alias("n"))
    return w.top_n(counts, ["p_type"], [F.desc("n"), "p_brand"], 3)


@query("segments", "WIN-13", """
WITH o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
              - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS grp
           FROM (SELECT ts, event_id, event_type, CASE WHEN event_id % 7 > 0 THEN user_id END AS user_id FROM events))
SELECT user_id, event_type, min(event_id) AS "start", max(event_id) AS "end", count(*) AS length
FROM o GROUP BY user_id, event_type, grp HAVING count(*) >= 2""")
def _(t):
    rows = sometimes_null(t.events, "user_id").select("user_id", "ts", "event_id", "event_type")
    return w.segments(rows, ["user_id"], ["ts", "event_id"], None, "event_type", "event_id", 2)


@query("sliding_majority", "WIN-14", """
WITH d AS (SELECT event_id // 1000 AS sample, event_id % 1000 AS i, event_type AS label FROM events),
     z AS (SELECT sample, max(i) + 1 AS size FROM d GROUP BY 1),
     s AS (SELECT sample, unnest(range(0, size - 49, 25)) AS window_start FROM z),
     c AS (SELECT s.sample, window_start, label, count(*) AS n FROM s JOIN d
           ON d.sample = s.sample AND d.i >= window_start AND d.i < window_start + 50 GROUP BY 1, 2, 3)
SELECT sample, window_start, label AS majority FROM (SELECT *, row_number() OVER
  (PARTITION BY sample, window_start ORDER BY n DESC, label) AS rn FROM c) WHERE rn = 1""")
def _(t):
    rows = t.events.select(F.floor(F.col("event_id") / 1000).alias("sample"),
                           (F.col("event_id") % 1000).alias("i"), F.col("event_type").alias("label"))
    return w.sliding_majority(rows, "sample", "i", "label", 50, 25)


@query("duplicates_keep_best", "WIN-15", """
SELECT l_partkey, l_returnflag, l_linestatus, l_quantity, l_orderkey, copies FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_returnflag, l_linestatus ORDER BY l_quantity DESC, l_orderkey) AS rn,
         count(*) OVER (PARTITION BY l_partkey, l_returnflag, l_linestatus) AS copies FROM lineitem) WHERE rn = 1""")
def _(t):
    rows = t.lineitem.select("l_partkey", "l_returnflag", "l_linestatus", "l_quantity", "l_orderkey")
    return w.best_duplicate(rows, ["l_partkey", "l_returnflag", "l_linestatus"], "l_quantity", "l_orderkey")


@query("top_dispersion", "WIN-16", "SELECT l_suppkey, " + HU("dispersion", 6) + """ AS dispersion FROM (
SELECT l_suppkey, var_samp(l_quantity) / avg(l_quantity) AS dispersion FROM lineitem GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 20)""")
def _(t):
    top = w.top_dispersion(t.lineitem, "l_suppkey", "l_quantity", 20)
    return top.withColumn("dispersion", half_up(F.col("dispersion"), 6))


@query("half_seen_position", "WIN-17", """
WITH c AS (SELECT l_returnflag, l_partkey, count(*) OVER (PARTITION BY l_returnflag ORDER BY l_partkey) AS seen,
                  count(*) OVER (PARTITION BY l_returnflag) AS n
           FROM (SELECT l_partkey, nullif(l_returnflag, 'A') AS l_returnflag FROM lineitem))
SELECT l_returnflag, min(l_partkey) AS half_position FROM c WHERE seen * 2 >= n GROUP BY 1""")
def _(t):
    rows = t.lineitem.select(F.nullif("l_returnflag", F.lit("A")).alias("l_returnflag"), "l_partkey")
    return w.half_seen(rows, "l_returnflag", "l_partkey",
                       F.floor(F.col("l_partkey") / 64))

"""Graph queries: parts bought one after the other in an order are linked."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions.numeric import half_up
from strandlake.operators import graph as g
from strandlake.operators import joins
from strandlake.plans.registry import half_up as HU
from strandlake.plans.registry import query



def links(t):
    """Part of line n to part of line n+1 of the same order."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    after = lines.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("dst"))
    pairs = lines.withColumnRenamed("l_partkey", "src").join(after, ["l_orderkey", "l_linenumber"])
    return g.build_edges(pairs.filter(F.col("src") != F.col("dst")))


def edges_sql():
    return """e AS (SELECT a.l_partkey AS src, b.l_partkey AS dst, count(*) AS weight FROM lineitem a JOIN lineitem b
      ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 AND a.l_partkey <> b.l_partkey GROUP BY 1, 2)"""


NODES = "n AS (SELECT DISTINCT id FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e))"


@query("graph_edges", "GRF-01", f"WITH {edges_sql()} SELECT * FROM e")
def _(t):
    return links(t)


@query("edges_degree", "GRF-02", f"""
WITH {edges_sql()}, {NODES}, d AS (SELECT id, (SELECT count(*) FROM e WHERE src = id) AS o, (SELECT count(*) FROM e WHERE dst = id) AS i FROM n)
SELECT count(*) AS nodes, sum(o)::BIGINT AS edges, max(i)::BIGINT AS max_in, max(o)::BIGINT AS max_out, arg_min(id, (-i, id)) AS hub_in, arg_min(id, (-o, id)) AS hub_out,
  sum(o)::DOUBLE / (count(*) * (count(*) - 1)) AS density, sum(o)::DOUBLE / count(*) AS avg_degree FROM d""")
def _(t):
    return g.graph_summary(links(t))


def pagerank_sql(rounds):
    steps = [f"""r{i + 1} AS (SELECT n.id, 0.15::DOUBLE / s.n + 0.85::DOUBLE * (coalesce(f.x, 0) + (SELECT coalesce(sum(v), 0) FROM r{i} WHERE id NOT IN (SELECT src FROM e)) / s.n) AS v
      FROM n CROSS JOIN s LEFT JOIN (SELECT p.dst AS id, sum(r.v * p.p) AS x FROM p JOIN r{i} r ON r.id = p.src GROUP BY 1) f ON f.id = n.id)"""
             for i in range(rounds)]
    return f"""WITH {edges_sql()}, {NODES}, s AS (SELECT count(*)::DOUBLE AS n FROM n),
      p AS (SELECT src, dst, weight::DOUBLE / sum(weight) OVER (PARTITION BY src)::DOUBLE AS p FROM e),
      r0 AS (SELECT id, 1.0::DOUBLE / s.n AS v FROM n, s), {', '.join(steps)}
      SELECT id, {HU('v', 9)} AS rank FROM r{rounds}"""


@query("pagerank", "GRF-03", pagerank_sql(60))
def _(t):
    return g.pagerank(links(t), tolerance=1e-14).select("id", half_up(F.col("rank"), 9).alias("rank"))


@query("random_walk", "GRF-04", f"""
WITH {edges_sql()}, p AS (SELECT src, dst, weight::DOUBLE / sum(weight) OVER (PARTITION BY src)::DOUBLE AS p FROM e),
 w0 AS (SELECT p_partkey AS start, p_partkey AS id, 1.0::DOUBLE AS v FROM part WHERE p_size = 50 AND p_type = 'PROMO'),
 w1 AS (SELECT start, dst AS id, sum(v * p) AS v FROM w0 JOIN p ON id = src GROUP BY 1, 2),
 w2 AS (SELECT start, dst AS id, sum(v * p) AS v FROM w1 JOIN p ON id = src GROUP BY 1, 2),
 w3 AS (SELECT start, dst AS id, sum(v * p) AS v FROM w2 JOIN p ON id = src GROUP BY 1, 2)
SELECT start, id, {HU('v', 9)} AS probability FROM w3""")
def _(t):
    start = t.part.filter((F.col("p_size") == 50) & (F.col("p_type") == "PROMO")).select(F.col("p_partkey").alias("id"))
    return g.random_walk(links(t), start, 3).withColumn("probability", half_up(F.col("probability"), 9))


@query("ffl_count", "GRF-05", f"""
WITH {edges_sql()} SELECT count(*)::BIGINT AS feedforward_loops FROM e a JOIN e b ON b.src = a.dst JOIN e c ON c.src = a.src AND c.dst = b.dst
WHERE a.src <> b.dst""")
def _(t):
    return g.feedforward_loops(links(t))


@query("hub_counts", "GRF-05", f"""
WITH {edges_sql()} SELECT (SELECT count(*) FROM (SELECT src FROM e GROUP BY 1 HAVING count(*) >= 5)) AS divergence,
  (SELECT count(*) FROM (SELECT dst FROM e GROUP BY 1 HAVING count(*) >= 5)) AS convergence""")
def _(t):
    return g.hub_counts(links(t), 5)


@query("reciprocity", "GRF-05 GRF-06", f"""
WITH {edges_sql()}, m AS (SELECT count(*) AS k FROM e a JOIN e b ON a.src = b.dst AND a.dst = b.src)
SELECT k // 2 AS mutual_pairs, k AS reciprocal_edges, (SELECT count(*) FROM e) - k AS one_way_edges FROM m""")
def _(t):
    return g.reciprocity(links(t))


def components_sql(rounds=24):
    """Smallest label passed on round by round; the graph's diameter is far below the number of rounds."""
    steps = [f"""c{i + 1} AS (SELECT y.id, least(any_value(y.l), min(x.l)) AS l FROM c{i} y JOIN u ON u.a = y.id
      JOIN c{i} x ON x.id = u.b GROUP BY y.id)""" for i in range(rounds)]
    return f"""WITH {edges_sql()}, {NODES}, u AS (SELECT src AS a, dst AS b FROM e UNION SELECT dst, src FROM e),
      c0 AS (SELECT id, id AS l FROM n), {', '.join(steps)}, c AS (SELECT id, l AS component FROM c{rounds})"""


COMPONENTS = components_sql()


@query("components", "GRF-07", COMPONENTS + " SELECT id, component FROM c")
def _(t):
    return g.components(links(t))


@query("largest_component", "GRF-07", COMPONENTS + " SELECT component, count(*) AS size FROM c GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def _(t):
    return g.largest_component(g.components(links(t)))


@query("clustering", "GRF-08", f"""
WITH {edges_sql()}, {NODES}, u AS (SELECT src AS a, dst AS b FROM e UNION SELECT dst, src FROM e),
  k AS (SELECT a AS id, count(*) AS k FROM u GROUP BY 1), s AS (SELECT a, b, (SELECT count(*) FROM e WHERE (src = a AND dst = b) OR (src = b AND dst = a)) AS s FROM u),
  tt AS (SELECT x.a AS id, count(*) AS t2, sum(x.s * y.s * z.s) AS dt2 FROM s x JOIN s y ON y.a = x.b JOIN s z ON z.a = y.b AND z.b = x.a GROUP BY 1),
  d AS (SELECT a AS id, sum(s) AS total, count(*) FILTER (s = 2) AS bi FROM s GROUP BY 1)
SELECT n.id, {HU('coalesce(t2::DOUBLE / nullif(k * (k - 1), 0), 0)', 9)} AS clustering,
  {HU('coalesce((dt2 / 2)::DOUBLE / nullif(total * (total - 1) - bi * 2, 0), 0)', 9)} AS directed_clustering
FROM n LEFT JOIN k USING (id) LEFT JOIN tt USING (id) LEFT JOIN d USING (id)""")
def _(t):
    out = g.clustering(links(t))
    return out.withColumns({c: half_up(F.col(c), 9) for c in ("clustering", "directed_clustering")})


@query("bfs_layers", "GRF-09", f"""
WITH RECURSIVE {edges_sql()}, {NODES}, z AS (SELECT id FROM n WHERE id NOT IN (SELECT dst FROM e)),
  s AS (SELECT id FROM z UNION ALL SELECT src FROM (SELECT src, count(*) AS o FROM e GROUP BY 1 ORDER BY o DESC, src LIMIT 1) WHERE (SELECT count(*) FROM z) = 0),
  walk(source, id, depth) AS (SELECT id, id, 0 FROM s UNION SELECT source, e.dst, depth + 1 FROM walk JOIN e ON e.src = walk.id WHERE depth < 25),
  b AS (SELECT source, id, min(depth) AS d FROM walk GROUP BY 1, 2), l AS (SELECT id, max(d) AS layer FROM b GROUP BY 1)
SELECT n.id, coalesce(layer, 0)::INT AS layer FROM n LEFT JOIN l USING (id)""")
def _(t):
    return g.layers(links(t))


def sites(t):
    k = F.col("s_suppkey")
    truth = t.supplier.select(k.alias("id"), F.col("s_acctbal").alias("x"), (k * 91 % 9000).cast("double").alias("y"))
    found = t.supplier.filter(k % 5 != 0).select((k + 1000000).alias("id"), (F.col("s_acctbal") + (k % 7) * 30).alias("x"),
                                                 (k * 91 % 9000 + (k % 3) * 20).cast("double").alias("y"))
    return found, truth


@query("edge_scores", "GRF-10", """
WITH tr AS (SELECT s_suppkey AS id, s_acctbal AS x, (s_suppkey * 91 % 9000)::DOUBLE AS y FROM supplier),
  fo AS (SELECT s_suppkey + 1000000 AS id, s_acctbal + (s_suppkey % 7) * 30 AS x, (s_suppkey * 91 % 9000 + (s_suppkey % 3) * 20)::DOUBLE AS y FROM supplier WHERE s_suppkey % 5 <> 0),
  d AS (SELECT fo.id AS f, tr.id AS t, sqrt((fo.x - tr.x) * (fo.x - tr.x) + (fo.y - tr.y) * (fo.y - tr.y)) AS d FROM fo, tr),
  c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY f ORDER BY d, t) AS rn FROM d) WHERE rn = 1 AND d < 120),
  m AS (SELECT f, t FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY d, f) AS rk FROM c) WHERE rk = 1),
  te AS (SELECT DISTINCT a.l_suppkey AS src, b.l_suppkey AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = 1 AND b.l_linenumber = 2 WHERE a.l_quantity > 40),
  fe AS (SELECT DISTINCT a.l_suppkey + 1000000 AS src, b.l_suppkey + 1000000 AS dst FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = 1 AND b.l_linenumber = 2 WHERE a.l_quantity > 35),
  fm AS (SELECT DISTINCT x.t AS src, y.t AS dst FROM fe JOIN m x ON fe.src = x.f JOIN m y ON fe.dst = y.f),
  k AS (SELECT (SELECT count(*) FROM (SELECT * FROM fm INTERSECT SELECT * FROM te)) AS tp, (SELECT count(*) FROM (SELECT * FROM fm EXCEPT SELECT * FROM te)) AS fp,
               (SELECT count(*) FROM (SELECT * FROM te EXCEPT SELECT * FROM fm)) AS fn)
SELECT tp, fp, fn, tp::DOUBLE / (tp + fp) AS "precision", tp::DOUBLE / (tp + fn) AS recall, (tp * 2)::DOUBLE / (tp * 2 + fp + fn) AS f1 FROM k""")
def _(t):
    found, truth = sites(t)

    def pairs(least, shift):
        first = t.lineitem.filter((F.col("l_linenumber") == 1) & (F.col("l_quantity") > least)).select("l_orderkey", (F.col("l_suppkey") + shift).alias("src"))
        second = t.lineitem.filter(F.col("l_linenumber") == 2).select("l_orderkey", (F.col("l_suppkey") + shift).alias("dst"))
        return first.join(second, "l_orderkey").select("src", "dst").distinct()

    return g.edge_scores(pairs(35, 1000000), pairs(40, 0), g.match_nodes(found, truth, 120.0))


@query("threshold_sweep", "GRF-11", """
WITH b AS (SELECT l_suppkey, l_partkey, min(l_extendedprice / 1000) AS d FROM lineitem GROUP BY 1, 2)
SELECT th::DOUBLE AS threshold, count(*) FILTER (d < th) AS edges FROM b, (SELECT unnest([20, 40, 60, 80, 100]) AS th) GROUP BY 1""")
def _(t):
    assigned = t.lineitem.select(F.col("l_suppkey").alias("source"), F.col("l_partkey").alias("target"),
                                 (F.col("l_extendedprice") / 1000).alias("distance"))
    return g.threshold_sweep(assigned, [20, 40, 60, 80, 100])


@query("modularity", "GRF-12", f"""
WITH {edges_sql()}, m AS (SELECT sum(weight)::DOUBLE AS m FROM e), x AS (SELECT e.*, a.p_brand AS ca, b.p_brand AS cb FROM e JOIN part a ON a.p_partkey = src JOIN part b ON b.p_partkey = dst),
  i AS (SELECT ca AS c, sum(weight) AS i FROM x WHERE ca = cb GROUP BY 1), d AS (SELECT c, sum(w) AS d FROM (SELECT ca AS c, weight AS w FROM x UNION ALL SELECT cb, weight FROM x) GROUP BY 1)
SELECT {HU('sum(coalesce(i, 0) / m - (d / (2 * m)) * (d / (2 * m)))', 9)} AS modularity FROM d LEFT JOIN i USING (c), m""")
def _(t):
    groups = t.part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("community"))
    return g.modularity(links(t), groups).withColumn("modularity", half_up(F.col("modularity"), 9))


@query("weighted_edges_decay", "GRF-01 MTH-02", f"""
SELECT l_suppkey AS src, l_partkey AS dst, count(*) AS weight, {HU('exp(-arg_max(l_quantity, (l_shipdate, l_orderkey, l_linenumber, l_quantity)) / 80.0::DOUBLE)', 9)} AS strength FROM lineitem GROUP BY 1, 2""")
def _(t):
    assigned = t.lineitem.select(F.col("l_suppkey").alias("source"), F.col("l_partkey").alias("target"), F.col("l_quantity").alias("distance"),
                                 F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_quantity").alias("at"))
    return joins.weighted_edges(assigned, "at").withColumn("strength", half_up(F.col("strength"), 9))

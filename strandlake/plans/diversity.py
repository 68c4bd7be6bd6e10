"""Diversity queries: nations are samples, parts and users are taxa."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions.numeric import half_up
from strandlake.operators import diversity as d
from strandlake.plans.registry import half_up as HU
from strandlake.plans.registry import query


def nation_parts(t):
    calls = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    rows = (t.lineitem.select("l_orderkey", "l_partkey").join(calls, "l_orderkey")
            .join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey"))
    return d.abundance(rows, "c_nationkey", "l_partkey")


def groups(t):
    return t.nation.select(F.col("n_nationkey").alias("sample"), F.col("n_regionkey").alias("grp"))


ABUNDANCE = """t AS (SELECT c_nationkey AS sample, l_partkey AS taxon, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
   JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""
PAIRS = """tot AS (SELECT sample, sum(n) AS n, count(*) AS s FROM t GROUP BY 1),
   sh AS (SELECT x.sample AS a, y.sample AS b, sum(least(x.n, y.n)) AS low, count(*) AS shared FROM t x JOIN t y ON x.taxon = y.taxon AND x.sample < y.sample GROUP BY 1, 2),
   bd AS (SELECT p.sample AS a, q.sample AS b, 1 - (coalesce(low, 0) * 2)::DOUBLE / (p.n + q.n)::DOUBLE AS bray_curtis,
     1 - coalesce(shared, 0)::DOUBLE / (p.s + q.s - coalesce(shared, 0)) AS jaccard FROM tot p JOIN tot q ON p.sample < q.sample LEFT JOIN sh ON sh.a = p.sample AND sh.b = q.sample)"""


@query("alpha_div", "DIV-01", f"""
WITH t AS (SELECT event_type AS sample, user_id AS taxon, count(*) AS n FROM events GROUP BY 1, 2), s AS (SELECT sample, sum(n)::DOUBLE AS total FROM t GROUP BY 1)
SELECT sample, count(*) AS observed, {HU('-sum(n / total * log2(n / total))', 6)} AS shannon, {HU('1 - sum((n / total) * (n / total))', 6)} AS simpson,
  count(*) + ((count(*) FILTER (n = 1)) * ((count(*) FILTER (n = 1)) - 1))::DOUBLE / (((count(*) FILTER (n = 2)) + 1) * 2) AS chao1
FROM t JOIN s USING (sample) GROUP BY 1""")
def _(t):
    out = d.alpha_diversity(d.abundance(t.events, "event_type", "user_id"))
    return out.withColumns({c: half_up(F.col(c), 6) for c in ("shannon", "simpson")})


@query("beta_div", "DIV-02", f"""
WITH {ABUNDANCE}, {PAIRS} SELECT a, b, {HU('bray_curtis', 9)} AS bray_curtis, {HU('jaccard', 9)} AS jaccard FROM bd""")
def _(t):
    out = d.beta_diversity(nation_parts(t))
    return out.withColumns({c: half_up(F.col(c), 9) for c in ("bray_curtis", "jaccard")})


def pairs(t):
    return d.beta_diversity(nation_parts(t)).select("a", "b", F.col("bray_curtis").alias("distance"))


@query("permanova", "DIV-03", f"""
WITH {ABUNDANCE}, {PAIRS}, lab AS (SELECT n_nationkey AS sample, n_regionkey AS grp, row_number() OVER (ORDER BY n_nationkey) AS i FROM nation),
  pm AS (SELECT 0 AS perm, sample, grp FROM lab UNION ALL SELECT perm, m.sample, lab.grp FROM (
     SELECT perm, sample, row_number() OVER (PARTITION BY perm ORDER BY md5('42|' || perm || '|' || sample), sample) AS i FROM lab, range(1, 100) r(perm)) m JOIN lab USING (i)),
  sz AS (SELECT perm, grp, count(*) AS k FROM pm GROUP BY 1, 2),
  j AS (SELECT x.perm, x.grp AS ga, y.grp AS gb, bray_curtis * bray_curtis AS d2 FROM bd JOIN pm x ON x.sample = a JOIN pm y ON y.sample = b AND y.perm = x.perm),
  w AS (SELECT perm, sum(s / k) AS ssw FROM (SELECT perm, ga AS grp, sum(d2) AS s FROM j WHERE ga = gb GROUP BY 1, 2) JOIN sz USING (perm, grp) GROUP BY 1),
  f AS (SELECT perm, (sst / n - ssw) / (g - 1) / (ssw / (n - g)) AS f FROM (SELECT perm, sum(d2) AS sst FROM j GROUP BY 1) JOIN w USING (perm)
        JOIN (SELECT perm, sum(k)::DOUBLE AS n, count(*) AS g FROM sz GROUP BY 1) USING (perm))
SELECT {HU('a.f', 6)} AS pseudo_f, ((SELECT count(*) FROM f WHERE perm > 0 AND f.f >= a.f) + 1) / 100.0::DOUBLE AS p_value FROM f a WHERE perm = 0""")
def _(t):
    return d.permanova(pairs(t), groups(t), 99, 42).withColumn("pseudo_f", half_up(F.col("pseudo_f"), 6))


@query("anosim", "DIV-04", f"""
WITH {ABUNDANCE}, {PAIRS}, r AS (SELECT a, b, rank() OVER (ORDER BY bray_curtis) + (count(*) OVER (PARTITION BY bray_curtis) - 1) / 2.0::DOUBLE AS rk, count(*) OVER () AS m FROM bd)
SELECT {HU('(avg(rk) FILTER (x.n_regionkey <> y.n_regionkey) - avg(rk) FILTER (x.n_regionkey = y.n_regionkey)) / (max(m) / 2.0::DOUBLE)', 9)} AS r
FROM r JOIN nation x ON x.n_nationkey = a JOIN nation y ON y.n_nationkey = b""")
def _(t):
    return d.anosim(pairs(t), groups(t)).withColumn("r", half_up(F.col("r"), 9))

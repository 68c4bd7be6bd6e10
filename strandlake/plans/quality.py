"""Data-quality, monitoring and role-view queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions.numeric import exact_mean, half_up, percent
from strandlake.operators import quality as q
from strandlake.plans.registry import exact_mean as MEAN
from strandlake.plans.registry import half_up as HU
from strandlake.plans.registry import query


PATIENTS = """p AS (SELECT c_custkey AS patient_id, (c_custkey % 90 + 18)::INT AS age,
   ['Male','M','male','Female','F','other'][(c_custkey % 6)::INT + 1] AS sex, (c_custkey % 12)::INT AS comorbidity_count,
   c_custkey % 2 = 0 AS tp53_mutation, c_custkey % 3 = 0 AS kras_mutation, c_custkey % 5 = 0 AS egfr_mutation,
   abs(c_acctbal) / 200.0::DOUBLE AS tmb_score, CASE WHEN c_custkey % 7 <> 0 THEN floor(abs(c_acctbal) / 250.0) END AS wbc_count,
   c_mktsegment AS ethnicity, c_nationkey AS batch FROM customer)"""


def patients(t):
    """Customers read as a clinical cohort; one in seven has no white cell count."""
    k, balance = F.col("c_custkey"), F.abs("c_acctbal")
    sexes = F.array(*[F.lit(s) for s in ("Male", "M", "male", "Female", "F", "other")])
    return t.customer.select(
        k.alias("patient_id"), (k % 90 + 18).cast("int").alias("age"), sexes[(k % 6).cast("int")].alias("sex"),
        (k % 12).cast("int").alias("comorbidity_count"), (k % 2 == 0).alias("tp53_mutation"),
        (k % 3 == 0).alias("kras_mutation"), (k % 5 == 0).alias("egfr_mutation"),
        (balance / F.lit(200.0)).alias("tmb_score"),
        F.when(k % 7 != 0, F.floor(balance / F.lit(250.0)).cast("double")).alias("wbc_count"),
        F.col("c_mktsegment").alias("ethnicity"), F.col("c_nationkey").alias("batch"))


RULES = {
    "patient_id": {"type": "int", "nullable": False, "unique": True},
    "age": {"type": "int", "nullable": False, "min_value": 20, "max_value": 100},
    "sex": {"type": "string", "nullable": False, "allowed_values": ["Male", "Female", "M", "F", "male", "female"]},
    "comorbidity_count": {"type": "int", "nullable": False, "min_value": 0, "max_value": 10},
    "tmb_score": {"type": "float", "nullable": False, "min_value": 0, "max_value": 45},
    "wbc_count": {"type": "float", "nullable": True, "min_value": 0, "open_min": True, "max_value": 38},
}


@query("rule_report", "DQ-01 DQ-02 DQ-03 DQ-04", f"""
WITH {PATIENTS}, c AS (SELECT count(*) FILTER (patient_id IS NULL) AS a, count(*) FILTER (age IS NULL) AS b, count(*) FILTER (age < 20) AS c,
  count(*) FILTER (age > 100) AS d, count(*) FILTER (sex IS NULL) AS e,
  count(*) FILTER (sex NOT IN ('Male', 'Female', 'M', 'F', 'male', 'female')) AS f,
  count(*) FILTER (comorbidity_count IS NULL) AS g, count(*) FILTER (comorbidity_count < 0) AS h, count(*) FILTER (comorbidity_count > 10) AS i,
  count(*) FILTER (tmb_score IS NULL) AS j, count(*) FILTER (tmb_score < 0) AS k, count(*) FILTER (tmb_score > 45) AS l,
  count(*) FILTER (wbc_count <= 0) AS m, count(*) FILTER (wbc_count > 38) AS n, count(*) - count(DISTINCT patient_id) AS o FROM p)
SELECT 'patient_id' AS column_name, 'not_null' AS rule, a AS violations FROM c UNION ALL
SELECT 'age', 'not_null', b FROM c UNION ALL SELECT 'age', 'min_value', c FROM c UNION ALL SELECT 'age', 'max_value', d FROM c UNION ALL
SELECT 'sex', 'not_null', e FROM c UNION ALL SELECT 'sex', 'allowed_values', f FROM c UNION ALL
SELECT 'comorbidity_count', 'not_null', g FROM c UNION ALL SELECT 'comorbidity_count', 'min_value', h FROM c UNION ALL
SELECT 'comorbidity_count', 'max_value', i FROM c UNION ALL SELECT 'tmb_score', 'not_null', j FROM c UNION ALL
SELECT 'tmb_score', 'min_value', k FROM c UNION ALL SELECT 'tmb_score', 'max_value', l FROM c UNION ALL
SELECT 'wbc_count', 'min_value', m FROM c UNION ALL SELECT 'wbc_count', 'max_value', n FROM c UNION ALL
SELECT 'patient_id', 'unique', o FROM c""")
def _(t):
    return q.rule_report(patients(t), RULES)


@query("rule_violations", "DQ-01", f"""
WITH {PATIENTS} SELECT patient_id, 'age' AS column_name, 'min_value' AS rule, age::VARCHAR AS value FROM p WHERE age < 20 UNION ALL
SELECT patient_id, 'age', 'max_value', age::VARCHAR FROM p WHERE age > 100 UNION ALL
SELECT patient_id, 'sex', 'allowed_values', sex FROM p WHERE sex NOT IN ('Male', 'Female', 'M', 'F', 'male', 'female') UNION ALL
SELECT patient_id, 'comorbidity_count', 'max_value', comorbidity_count::VARCHAR FROM p WHERE comorbidity_count > 10""")
def _(t):
    return q.rule_violations(patients(t), "patient_id", {c: RULES[c] for c in ("age", "sex", "comorbidity_count")})


@query("duplicate_keys", "DQ-04", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def _(t):
    return q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("fk_orphans", "DQ-05 JOIN-23", """
SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN
  (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1""")
def _(t):
    parents = t.orders.filter(F.col("o_orderstatus") != "P")
    return (q.orphans(t.lineitem.select("l_orderkey"), parents, "l_orderkey", "o_orderkey").groupBy("l_orderkey")
            .agg(F.count("*").alias("n")))


@query("cohort_warnings", "DQ-06", f"""
WITH {PATIENTS}, s AS (SELECT avg(age) AS a, (count(*) FILTER (wbc_count > 30)) * 100.0::DOUBLE / count(wbc_count) AS w,
                     avg(tp53_mutation::INT) AS t FROM p)
SELECT 'age_mean' AS "check", a AS value, NOT a BETWEEN 40 AND 75 AS warns FROM s UNION ALL
SELECT 'wbc_outlier_pct', w, w > 5 FROM s UNION ALL SELECT 'tp53_rate', t, NOT t BETWEEN 0.3 AND 0.7 FROM s""")
def _(t):
    return q.cohort_warnings(patients(t))


@query("missing_report", "DQ-07 DQ-08 DQ-14", f"""
WITH {PATIENTS}, m AS (SELECT 'wbc_count' AS column_name, count(*) - count(wbc_count) AS missing, count(*) AS total FROM p UNION ALL
  SELECT 'age', count(*) - count(age), count(*) FROM p UNION ALL
  SELECT 'tmb_high', count(*) - count(CASE WHEN tmb_score > 20 THEN 1 END), count(*) FROM p)
SELECT *, missing * 100.0::DOUBLE / total AS missing_pct, CASE WHEN missing * 100.0 / total > 20 THEN 'HIGH'
  WHEN missing * 100.0 / total > 10 THEN 'MODERATE' ELSE 'OK' END AS level, missing * 100.0 / total > 20 AS warns FROM m""")
def _(t):
    rows = patients(t).withColumn("tmb_high", F.when(F.col("tmb_score") > 20, 1))
    return q.missing_report(rows, ["wbc_count", "age", "tmb_high"])


@query("feature_gaps", "DQ-14", f"""
WITH {PATIENTS}, m AS (SELECT 'wbc_count' AS column_name, count(*) - count(wbc_count) AS missing, count(*) AS total, false AS gone FROM p UNION ALL
  SELECT 'age', count(*) - count(age), count(*), false FROM p UNION ALL SELECT 'ldl', count(*), count(*), true FROM p)
SELECT column_name, missing, total, missing * 100.0::DOUBLE / total AS missing_pct, CASE WHEN gone THEN 'ABSENT' WHEN missing * 100.0 / total > 20 THEN 'HIGH'
  WHEN missing * 100.0 / total > 10 THEN 'MODERATE' ELSE 'OK' END AS level, gone OR missing * 100.0 / total > 20 AS warns FROM m""")
def _(t):
    return q.feature_gaps(patients(t), ["wbc_count", "age", "ldl"])


@query("distribution_metrics", "DQ-09", f"""
WITH x AS (SELECT 'price' AS column_name, l_extendedprice AS v FROM lineitem UNION ALL SELECT 'depth', l_quantity FROM lineitem)
SELECT column_name, count(v) AS n, {HU('avg(v)', 4)} AS mean, {HU('stddev_samp(v)', 4)} AS std, min(v) AS "min", max(v) AS "max",
  {HU('skewness(v)', 6)} AS skewness, {HU('kurtosis(v)', 6)} AS kurtosis, {HU('quantile_cont(v, 0.25)', 4)} AS q25,
  {HU('quantile_cont(v, 0.5)', 4)} AS median, {HU('quantile_cont(v, 0.75)', 4)} AS q75 FROM x GROUP BY 1""")
def _(t):
    rows = t.lineitem.select(F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("depth"))
    out = q.distribution_metrics(rows, ["price", "depth"])
    places = {"mean": 4, "std": 4, "skewness": 6, "kurtosis": 6, "q25": 4, "median": 4, "q75": 4}
    return out.withColumns({c: half_up(F.col(c), p) for c, p in places.items()})


@query("categorical_metrics", "DQ-10", """
WITH x AS (SELECT 'status' AS column_name, o_orderstatus AS value FROM orders UNION ALL SELECT 'priority', o_orderpriority FROM orders),
     c AS (SELECT column_name, value, count(*) AS n FROM x GROUP BY 1, 2),
     r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rn,
                  count(*) OVER (PARTITION BY column_name) AS u, sum(n) OVER (PARTITION BY column_name) AS t FROM c)
SELECT column_name, u AS unique_values, value AS most_common, n AS most_common_count, n * 100.0::DOUBLE / t::DOUBLE AS most_common_pct
FROM r WHERE rn = 1""")
def _(t):
    rows = t.orders.select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return q.categorical_metrics(rows, ["status", "priority"])


@query("corr_pairs", "DQ-11", f"""
SELECT 'l_quantity' AS feature1, 'l_extendedprice' AS feature2, {HU('corr(l_quantity, l_extendedprice)', 6)} AS correlation FROM lineitem UNION ALL
SELECT 'l_quantity', 'l_discount', {HU('corr(l_quantity, l_discount)', 6)} FROM lineitem UNION ALL
SELECT 'l_extendedprice', 'l_discount', {HU('corr(l_extendedprice, l_discount)', 6)} FROM lineitem""")
def _(t):
    out = q.correlations(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return out.withColumn("correlation", half_up(F.col("correlation"), 6))


@query("drift_two_batches", "DQ-12", f"""
WITH a AS (SELECT avg(l_quantity) AS q, stddev_samp(l_quantity) AS qs, avg(l_extendedprice) AS e, stddev_samp(l_extendedprice) AS es
           FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
     b AS (SELECT avg(l_quantity / 2) AS q, stddev_samp(l_quantity / 2) AS qs, avg(l_extendedprice) AS e, stddev_samp(l_extendedprice) AS es
           FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
     d AS (SELECT 'l_quantity' AS column_name, abs(b.q - a.q) * 100.0 / abs(a.q) AS m, abs(b.qs - a.qs) * 100.0 / a.qs AS s FROM a, b UNION ALL
           SELECT 'l_extendedprice', abs(b.e - a.e) * 100.0 / abs(a.e), abs(b.es - a.es) * 100.0 / a.es FROM a, b)
SELECT column_name, {HU('m', 6)} AS mean_change_pct, {HU('s', 6)} AS std_change_pct, m > 20 OR s > 30 AS drifted FROM d""")
def _(t):
    late = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    second = t.lineitem.filter(late).withColumn("l_quantity", F.col("l_quantity") / 2)
    out = q.drift(t.lineitem.filter(~late), second, ["l_quantity", "l_extendedprice"])
    return out.withColumns({c: half_up(F.col(c), 6) for c in ("mean_change_pct", "std_change_pct")})


@query("distribution_checks", "DQ-13", f"""
WITH m AS (SELECT 'mean' AS metric, avg(l_quantity) AS value, 20.0 AS low, 25.0 AS high FROM lineitem UNION ALL
           SELECT 'max', max(l_quantity), NULL, 49.0 FROM lineitem UNION ALL SELECT 'min', min(l_quantity), 1.0, NULL FROM lineitem)
SELECT 'l_quantity' AS column_name, metric, {HU('value', 6)} AS value, coalesce(value < low, false) OR coalesce(value > high, false) AS outside FROM m""")
def _(t):
    metrics = q.distribution_metrics(t.lineitem, ["l_quantity"])
    out = q.distribution_checks(metrics, {"l_quantity": {"mean_range": (20, 25), "min_value": 1, "max_value": 49}})
    return out.select("column_name", "metric", half_up(F.col("value"), 6).alias("value"), "outside")


SCORES = [("mean_depth", ">=", 25.0, 20.0), ("low_tax_pct", ">=", 60.0, 50.0), ("returned_pct", "<=", 30.0, 32.0)]


def score_metrics(t):
    stats = t.lineitem.agg(exact_mean("l_quantity", 2).alias("d"),
                           percent(F.count_if(F.col("l_tax") <= 0.04), F.count("*")).alias("x"),
                           percent(F.count_if(F.col("l_returnflag") == "R"), F.count("*")).alias("r"),
                           F.max("l_quantity").alias("m"))
    return stats.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(c).alias("value")) for n, c in
                                           (("mean_depth", "d"), ("low_tax_pct", "x"), ("returned_pct", "r"), ("max_depth", "m"))])))


SCORE_SQL = f"""s AS (SELECT {MEAN('l_quantity', 2)} AS d, (count(*) FILTER (l_tax <= 0.04)) * 100.0::DOUBLE / count(*) AS x,
   (count(*) FILTER (l_returnflag = 'R')) * 100.0::DOUBLE / count(*) AS r, max(l_quantity) AS m FROM lineitem),
   c AS (SELECT 'mean_depth' AS metric, d AS value, 25.0::DOUBLE AS threshold, CASE WHEN d >= 25 THEN 'PASS' WHEN d >= 20 THEN 'WARNING' ELSE 'FAIL' END AS status FROM s UNION ALL
   SELECT 'low_tax_pct', x, 60.0, CASE WHEN x >= 60 THEN 'PASS' WHEN x >= 50 THEN 'WARNING' ELSE 'FAIL' END FROM s UNION ALL
   SELECT 'returned_pct', r, 30.0, CASE WHEN r <= 30 THEN 'PASS' WHEN r <= 32 THEN 'WARNING' ELSE 'FAIL' END FROM s UNION ALL
   SELECT 'max_depth', m, NULL, 'INFO' FROM s)"""


@query("scorecard", "DQ-16", f"WITH {SCORE_SQL} SELECT metric, value, threshold, status FROM c")
def _(t):
    return q.scorecard(score_metrics(t), SCORES)


@query("overall_status", "DQ-16", f"""WITH {SCORE_SQL} SELECT CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'FAIL'
  WHEN count(*) FILTER (status = 'WARNING') > 0 THEN 'WARNING' ELSE 'PASS' END AS overall FROM c""")
def _(t):
    return q.overall_status(q.scorecard(score_metrics(t), SCORES))


@query("group_verdicts", "DQ-17", """
WITH g AS (SELECT l_suppkey, (count(*) FILTER (l_tax <= 0.04)) * 100.0::DOUBLE / count(*) AS pass_rate, sum(l_quantity) / count(*) AS quality,
                  (count(*) FILTER (l_discount = 0)) * 200.0::DOUBLE / count(*) AS adapter_pct FROM lineitem GROUP BY 1)
SELECT l_suppkey, NOT (pass_rate < 50 OR quality < 25 OR adapter_pct > 20) AS passed,
  CASE WHEN pass_rate < 50 OR quality < 25 OR adapter_pct > 20 THEN concat_ws('; ',
       CASE WHEN pass_rate < 50 THEN 'Low pass rate' END, CASE WHEN quality < 25 THEN 'Low avg quality' END,
       CASE WHEN adapter_pct > 20 THEN 'High adapter contamination' END) ELSE 'PASS' END AS reasons FROM g""")
def _(t):
    g = t.lineitem.groupBy("l_suppkey").agg(
        percent(F.count_if(F.col("l_tax") <= 0.04), F.count("*")).alias("pass_rate"),
        exact_mean("l_quantity", 2).alias("quality"),
        (percent(F.count_if(F.col("l_discount") == 0), F.count("*")) * 2).alias("adapter_pct"))
    out = q.group_verdicts(g, "pass_rate", "quality", "adapter_pct")
    return out.select("l_suppkey", "passed", F.regexp_replace("reasons", r" \([^)]*\)", "").alias("reasons"))


@query("z_outliers", "DQ-18", f"""
WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events)
SELECT event_id, value, {HU('(value - m) / s', 6)} AS z_score FROM events, s WHERE abs((value - m) / s) > 3""")
def _(t):
    out = q.outliers(t.events.select("event_id", "value"), "value")
    return out.withColumn("z_score", half_up(F.col("z_score"), 6))


@query("catalog_manifest", "DQ-19", """
SELECT 'orders' AS table_name, 'bronze' AS zone, 'orders.parquet' AS file,
  'struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>' AS table_schema,
  count(*) AS row_count, true AS updated_now FROM orders UNION ALL
SELECT 'customer', 'silver', 'customer.parquet', 'struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string>', count(*), true FROM customer""")
def _(t):
    out = q.manifest({"orders": ("bronze", f"{t.root}/orders.parquet", t.orders),
                      "customer": ("silver", f"{t.root}/customer.parquet", t.customer)})
    recent = F.col("updated_at") > F.current_timestamp() - F.expr("INTERVAL 1 HOUR")
    return out.select("table_name", "zone", F.substring_index("path", "/", -1).alias("file"), "table_schema", "row_count", recent.alias("updated_now"))


@query("role_view", "GOV-01 GOV-02", """
SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal >= 0""")
def _(t):
    policy = {"exclude": ("c_name", "c_acctbal"),
              "rows": (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") >= 0)}
    return q.role_view(t.customer, policy)

"""Feature-engineering and normalisation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions.numeric import exact_mean, half_up
from strandlake.operators import features as f
from strandlake.operators import normalise as n
from strandlake.plans.quality import PATIENTS, patients
from strandlake.plans.registry import exact_mean as MEAN
from strandlake.plans.registry import half_up as HU
from strandlake.plans.registry import query



@query("impute_scale_onehot", "FEA-01 FEA-02 FEA-03 STR-06", f"""
WITH {PATIENTS}, s AS (SELECT quantile_cont(wbc_count, 0.5) AS w, avg(age) AS am, stddev_pop(age) AS asd FROM p)
SELECT patient_id, coalesce(wbc_count, w) AS wbc_imputed, {HU('(age - am) / asd', 6)} AS age_scaled,
  coalesce((CASE WHEN sex IN ('Male', 'M', 'male') THEN 'Male' WHEN sex IN ('Female', 'F') THEN 'Female' END = 'Male')::INT, 0) AS sex_Male,
  (ethnicity = 'BUILDING')::INT AS ethnicity_BUILDING, (ethnicity = 'FURNITURE')::INT AS ethnicity_FURNITURE,
  (ethnicity = 'HOUSEHOLD')::INT AS ethnicity_HOUSEHOLD, (ethnicity = 'MACHINERY')::INT AS ethnicity_MACHINERY FROM p, s""")
def _(t):
    rows = patients(t)
    out = f.transform(rows, f.fit(rows))
    return out.select("patient_id", "wbc_imputed", half_up(F.col("age_scaled"), 6).alias("age_scaled"), "sex_Male",
                      *[f"ethnicity_{c}" for c in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")])


@query("risk_flags_bins", "FEA-04 FEA-05 FEA-06 FEA-07 FEA-08 FEA-09", f"""
WITH {PATIENTS} SELECT patient_id, (tp53_mutation::INT + kras_mutation::INT + egfr_mutation::INT) AS mutation_burden,
  age / 10.0::DOUBLE + comorbidity_count * 5 AS clinical_risk_score,
  ((age > 70)::INT + (comorbidity_count >= 3)::INT + (tmb_score > 20)::INT >= 2)::INT AS high_risk_patient,
  CASE WHEN age <= 40 THEN '18-40' WHEN age <= 60 THEN '41-60' WHEN age <= 75 THEN '61-75' WHEN age <= 120 THEN '76+' END AS age_group,
  CASE WHEN wbc_count IS NULL THEN 'Unknown' WHEN wbc_count < 4 THEN 'Low' WHEN wbc_count <= 11 THEN 'Normal' ELSE 'High' END AS wbc_category FROM p""")
def _(t):
    out = f.high_risk_flag(f.clinical_risk_score(f.mutation_burden(patients(t))))
    return f.wbc_categories(f.age_groups(out)).select("patient_id", "mutation_burden", "clinical_risk_score",
                                                      "high_risk_patient", "age_group", "wbc_category")


@query("most_frequent_fill", "FEA-01", f"""
WITH {PATIENTS}, m AS (SELECT wbc_count AS v FROM p WHERE wbc_count IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1),
     a AS (SELECT avg(wbc_count) AS v FROM p)
SELECT patient_id, coalesce(wbc_count, m.v) AS by_mode, {HU('coalesce(wbc_count, a.v)', 6)} AS by_mean FROM p, m, a""")
def _(t):
    rows = patients(t)
    by_mode = f.impute(rows, f.fit_fills(rows, {"wbc_count": "most_frequent"}), {"wbc_count": "by_mode"})
    out = f.impute(by_mode, f.fit_fills(rows, {"wbc_count": "mean"}), {"wbc_count": "by_mean"})
    return out.select("patient_id", "by_mode", half_up(F.col("by_mean"), 6).alias("by_mean"))


@query("min_max_log_scaling", "FEA-16 MTH-02", f"""
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, avg(ln(1 + o_totalprice)) AS m, stddev_pop(ln(1 + o_totalprice)) AS sd FROM orders)
SELECT o_orderkey, {HU('(o_totalprice - lo) / (hi - lo)', 6)} AS price_minmax, {HU('(ln(1 + o_totalprice) - m) / sd', 6)} AS price_log FROM orders, s""")
def _(t):
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"))
    out = f.log1p_scaled(f.min_max(rows, ["price"]), ["price"])
    return out.select("o_orderkey", half_up(F.col("price_minmax"), 6).alias("price_minmax"),
                      half_up(F.col("price_log1p_scaled"), 6).alias("price_log"))


@query("feature_versions", "FEA-10 FEA-11", f"""
WITH {PATIENTS} SELECT patient_id, mutation_burden, 2 AS feature_version FROM (
  SELECT patient_id, tp53_mutation::INT + kras_mutation::INT + egfr_mutation::INT AS mutation_burden FROM p WHERE patient_id % 2 = 0)
WHERE patient_id IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""")
def _(t):
    burden = f.mutation_burden(patients(t)).select("patient_id", "mutation_burden")
    stored = f.store_version(None, burden, "patient_id", 1)
    stored = f.store_version(stored, burden.filter(F.col("patient_id") % 2 == 0), "patient_id", 2)
    wanted = t.orders.filter(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("patient_id"))
    return f.features_of(stored, "patient_id", ["mutation_burden", "feature_version"], wanted)


@query("validated_features", "FEA-10 FEA-11", f"""
WITH {PATIENTS} SELECT patient_id, CASE WHEN patient_id % 3 = 0 THEN 3 ELSE tp53_mutation::INT + kras_mutation::INT + egfr_mutation::INT END AS mutation_burden,
  1 AS feature_version FROM p""")
def _(t):
    rows = patients(t)
    # every third patient comes again, with all mutations; the batch is validated before it replaces what is stored
    batch = rows.filter(F.col("patient_id") % 3 == 0).withColumns({c: F.lit(True) for c in ("tp53_mutation", "kras_mutation", "egfr_mutation")})
    rules = {"patient_id": {"type": "int", "nullable": False, "unique": True}, "tmb_score": {"type": "float", "nullable": False, "min_value": 0}}
    raw = f.ingest_raw(f.ingest_raw(rows.limit(0), rows, "patient_id", rules), batch, "patient_id", rules)
    stored = f.store_version(None, f.mutation_burden(raw).select("patient_id", "mutation_burden"), "patient_id", 1)
    return f.features_of(stored, "patient_id", ["mutation_burden", "feature_version"])


@query("training_set", "FEA-12 JOIN-22", f"""
WITH {PATIENTS} SELECT p.patient_id, age / 10.0::DOUBLE + comorbidity_count * 5 AS clinical_risk_score, label FROM p JOIN
  (SELECT o_custkey AS patient_id, max((o_orderstatus = 'F')::INT) AS label FROM orders GROUP BY 1) USING (patient_id)""")
def _(t):
    scores = f.clinical_risk_score(patients(t)).select("patient_id", "clinical_risk_score",
                                                       F.lit(1).alias("feature_version"))
    labels = t.orders.groupBy(F.col("o_custkey").alias("patient_id")).agg(
        F.max((F.col("o_orderstatus") == "F").cast("int")).alias("label"))
    return f.training_set(scores, labels, "patient_id", "label")


@query("feature_lineage", "FEA-13 ARR-01", """
SELECT p_brand AS feature_name, p_type AS source_column, 'derived' AS category, 1 AS version FROM part GROUP BY 1, 2""")
def _(t):
    registry = t.part.groupBy(F.col("p_brand").alias("feature_name")).agg(
        F.collect_set("p_type").alias("source_columns")).withColumns(
        {"category": F.lit("derived"), "version": F.lit(1)})
    return f.lineage(registry)


@query("class_metrics", "FEA-23", """
WITH c AS (SELECT l_returnflag AS t, CASE WHEN l_quantity > 34 THEN 'A' WHEN l_quantity > 17 THEN 'N' ELSE 'R' END AS p FROM lineitem),
     k AS (SELECT x AS class, count(*) FILTER (t = x AND p = x) AS tp, count(*) FILTER (t <> x AND p = x) AS fp,
                  count(*) FILTER (t = x AND p <> x) AS fn FROM c, (VALUES ('A'), ('N'), ('R')) v(x) GROUP BY 1)
SELECT class, tp, fp, fn, tp::DOUBLE / (tp + fp) AS "precision", tp::DOUBLE / (tp + fn) AS recall,
       (2 * tp)::DOUBLE / (2 * tp + fp + fn) AS f1 FROM k""")
def _(t):
    depth = F.col("l_quantity")
    guess = F.when(depth > 34, "A").when(depth > 17, "N").otherwise("R")
    rows = t.lineitem.select(F.col("l_returnflag").alias("t"), guess.alias("p"))
    return f.classification_metrics(rows, "t", "p", ["A", "N", "R"])


def matrix(t):
    """Embeddings as a long matrix; the vector component is the sample, the vector the feature."""
    return t.embeddings.select("vec_id", "label", F.posexplode("embedding").alias("dim", "v")).select(
        "vec_id", "label", F.col("dim").cast("bigint").alias("dim"), F.col("v").cast("double").alias("v"))


MATRIX = """x AS (SELECT vec_id, label, unnest(range(0, len(embedding))) AS dim, unnest(embedding)::DOUBLE AS v FROM embeddings)"""


@query("batch_center", "FEA-14", f"""
WITH {MATRIX} SELECT vec_id, dim, {HU('v - avg(v) OVER (PARTITION BY label, dim)', 6)} AS corrected FROM x""")
def _(t):
    out = n.batch_centred(matrix(t), "label", "dim", "v")
    return out.select("vec_id", "dim", half_up(F.col("corrected"), 6).alias("corrected"))


@query("batch_factors", "FEA-14", f"""
WITH b AS (SELECT l_suppkey, {MEAN('l_quantity', 2)} AS batch_mean FROM lineitem GROUP BY 1),
     o AS (SELECT avg(batch_mean) AS m, stddev_samp(batch_mean) AS s FROM b)
SELECT l_suppkey, batch_mean, {HU('(batch_mean - m) / s', 6)} AS z_score, {HU('m - batch_mean', 6)} AS normalization_factor FROM b, o""")
def _(t):
    out = n.batch_factors(t.lineitem, "l_suppkey", exact_mean("l_quantity", 2))
    return out.withColumns({c: half_up(F.col(c), 6) for c in ("z_score", "normalization_factor")})


@query("quantile_norm", "FEA-15", f"""
WITH {MATRIX}, r AS (SELECT dim, vec_id, v, row_number() OVER (PARTITION BY dim ORDER BY v) AS rn, rank() OVER (PARTITION BY dim ORDER BY v) AS mr FROM x),
     m AS (SELECT rn, avg(v) AS nv FROM r GROUP BY 1)
SELECT r.dim, r.vec_id, {HU('nv', 6)} AS normalised FROM r JOIN m ON r.mr = m.rn""")
def _(t):
    out = n.quantile_normalised(matrix(t), "dim", "v")
    return out.select("dim", "vec_id", half_up(F.col("normalised"), 6).alias("normalised"))


@query("median_norm", "FEA-17", f"""
WITH {MATRIX}, m AS (SELECT vec_id, quantile_cont(v, 0.5) AS med FROM x GROUP BY 1)
SELECT vec_id, dim, {HU('v / CASE WHEN med = 0 THEN 1 ELSE med END', 4)} AS normalised FROM x JOIN m USING (vec_id)""")
def _(t):
    out = n.median_normalised(matrix(t), "vec_id", "v")
    return out.select("vec_id", "dim", half_up(F.col("normalised"), 4).alias("normalised"))


@query("gc_correction", "FEA-18", f"""
WITH {MATRIX}, y AS (SELECT vec_id, dim, v + 1 AS v, (dim % 17) / 17.0::DOUBLE AS gc FROM x),
     s AS (SELECT vec_id, regr_slope(v, gc) AS a, regr_intercept(v, gc) AS b, avg(v) AS m FROM y GROUP BY 1)
SELECT vec_id, dim, {HU('greatest(v - (a * gc + b) + m, 0.0::DOUBLE)', 6)} AS corrected FROM y JOIN s USING (vec_id)""")
def _(t):
    rows = matrix(t).withColumns({"v": F.col("v") + 1, "gc": (F.col("dim") % 17) / F.lit(17.0)})
    out = n.gc_corrected(rows, "vec_id", "gc", "v")
    return out.select("vec_id", "dim", half_up(F.col("corrected"), 6).alias("corrected"))


@query("mappability_correction", "FEA-19", f"""
WITH {MATRIX}, k AS (SELECT DISTINCT dim, (dim * 7 % 10) / 10.0::DOUBLE AS mp FROM x),
     g AS (SELECT dim, mp, last_value(CASE WHEN mp >= 0.2 THEN dim END IGNORE NULLS) OVER (ORDER BY dim ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b,
                  first_value(CASE WHEN mp >= 0.2 THEN dim END IGNORE NULLS) OVER (ORDER BY dim ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM k),
     n AS (SELECT dim, mp, coalesce(b, a) AS b, coalesce(a, b) AS a FROM g),
     f AS (SELECT vec_id, dim, v / mp AS c FROM x JOIN n USING (dim) WHERE mp >= 0.2)
SELECT vec_id, dim, {HU('c', 6)} AS corrected FROM f UNION ALL
SELECT x.vec_id, x.dim, {HU('fb.c + CASE WHEN n.a > n.b THEN (fa.c - fb.c) * (x.dim - n.b) / (n.a - n.b) ELSE 0 END', 6)}
FROM x JOIN n ON x.dim = n.dim JOIN f fb ON fb.vec_id = x.vec_id AND fb.dim = n.b JOIN f fa ON fa.vec_id = x.vec_id AND fa.dim = n.a WHERE mp < 0.2""")
def _(t):
    rows = matrix(t)
    track = rows.select("dim").distinct().withColumn("mappability", (F.col("dim") * 7 % 10) / F.lit(10.0))
    out = n.mappability_corrected(rows, track, "vec_id", "dim", "v")
    return out.select("vec_id", "dim", half_up(F.col("corrected"), 6).alias("corrected"))


@query("bin_zscores", "FEA-20", f"""
WITH {MATRIX}, s AS (SELECT dim, avg(v) AS m, stddev_pop(v) + 1e-8 AS s FROM x GROUP BY 1)
SELECT vec_id, dim, {HU('(v - m) / s', 6)} AS z_score FROM x JOIN s USING (dim)""")
def _(t):
    out = n.bin_zscores(matrix(t), "dim", "v")
    return out.select("vec_id", "dim", half_up(F.col("z_score"), 6).alias("z_score"))


@query("tpm", "FEA-21", f"""
WITH c AS (SELECT l_suppkey, l_partkey, sum(l_quantity) AS n FROM lineitem GROUP BY 1, 2),
     r AS (SELECT l_suppkey, l_partkey, n / coalesce(CASE WHEN p_size > 5 THEN p_size END, 1.0::DOUBLE) AS rate FROM c LEFT JOIN part ON l_partkey = p_partkey)
SELECT l_suppkey, l_partkey, {HU('rate / sum(rate) OVER (PARTITION BY l_suppkey) * 1000000.0::DOUBLE', 4)} AS tpm FROM r""")
def _(t):
    counts = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("n"))
    lengths = t.part.select(F.col("p_partkey").alias("l_partkey"),
                            F.when(F.col("p_size") > 5, F.col("p_size").cast("double")).alias("length_kb"))
    out = n.tpm(counts, lengths, "l_suppkey", "l_partkey", "n", "length_kb")
    return out.select("l_suppkey", "l_partkey", half_up(F.col("tpm"), 4).alias("tpm"))


@query("tpm_totals", "FEA-21 AGG-31", """
SELECT l_suppkey, true AS sums_to_million FROM lineitem GROUP BY 1""")
def _(t):
    counts = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("n"))
    lengths = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").cast("double").alias("length_kb"))
    out = n.tpm(counts, lengths, "l_suppkey", "l_partkey", "n", "length_kb")
    return out.groupBy("l_suppkey").agg((F.abs(F.sum("tpm") - 1e6) < 1e-3).alias("sums_to_million"))

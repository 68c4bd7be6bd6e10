"""Clinical features, rules, monitoring, changes."""

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from strandlake.operators import changes, diversity, features, filters, normalise, quality, windows

SCHEMA = ("patient_id string, age int, sex string, ethnicity string, comorbidity_count int, tp53_mutation boolean, kras_mutation boolean, "
          "egfr_mutation boolean, tmb_score double, wbc_count double")


@pytest.fixture(scope="module")
def cohort(spark):
    data = [("p1", 30, "M", "Asian", 1, True, False, True, 5.0, 3.9), ("p2", 71, "female", "Other", 3, False, False, False, 1.0, 4.0),
            ("p3", 75, "Male", "Asian", 0, True, True, True, 21.0, None), ("p4", 50, "F", "Hispanic", 5, False, True, False, 25.0, 11.0),
            ("p5", 60, "x", None, 2, False, False, False, 2.0, 11.1)]
    return spark.createDataFrame(data, SCHEMA)


def test_fit_and_apply(spark, cohort):
    params = features.fit(cohort)
    assert params.fills["wbc_count"] == pytest.approx(7.5)
    out = {r["patient_id"]: r for r in features.transform(cohort, params).collect()}
    assert out["p3"]["wbc_imputed"] == pytest.approx(7.5) and out["p3"]["wbc_count"] is None
    assert out["p2"]["high_risk_patient"] == 1 and out["p1"]["high_risk_patient"] == 0 and out["p4"]["high_risk_patient"] == 1
    assert out["p1"]["mutation_burden"] == 2 and out["p1"]["clinical_risk_score"] == pytest.approx(8.0)
    assert out["p5"]["sex"] is None and out["p5"]["sex_Male"] == 0 and out["p1"]["sex_Male"] == 1
    assert "ethnicity_Asian" not in out["p1"].asDict() and out["p4"]["ethnicity_Hispanic"] == 1
    assert sum(r["age_scaled"] for r in out.values()) == pytest.approx(0)
    new = cohort.filter("patient_id = 'p1'").withColumn("ethnicity", F.lit("Unseen"))
    fresh = features.transform(new, params).first()
    assert fresh["ethnicity_Hispanic"] == 0 and fresh["ethnicity_Other"] == 0
    stored = params.to_rows(spark, 3)
    assert features.Parameters.from_rows(stored, 3) == params


def test_errors(cohort):
    with pytest.raises(ValueError, match="fit"):
        features.transform(cohort, None)
    with pytest.raises(ValueError, match="kras"):
        features.mutation_burden(cohort.drop("kras_mutation"))


def test_bins_at_their_edges(spark):
    ages = spark.createDataFrame([(a,) for a in (0, 40, 41, 60, 61, 75, 76, 120, 121, -1)], "age int")
    assert [r[1] for r in features.age_groups(ages).collect()] == [
        "18-40", "18-40", "41-60", "41-60", "61-75", "61-75", "76+", "76+", None, None]
    wbc = spark.createDataFrame([(x,) for x in (None, 3.9, 4.0, 11.0, 11.1)], "wbc_count double")
    assert [r[1] for r in features.wbc_categories(wbc).collect()] == ["Unknown", "Low", "Normal", "Normal", "High"]


def test_versions_are_kept(spark):
    v = spark.createDataFrame([("a", 1), ("b", 2)], "id string, x int")
    stored = features.store_version(None, v, "id", 1)
    stored = features.store_version(stored, v.filter("id = 'a'").withColumn("x", F.lit(9)), "id", 2)
    stored = features.store_version(stored, v.withColumn("x", F.lit(5)), "id", 1)
    assert rows(features.features_of(stored, "id", ["x"], version=1), "id") == [("a", 5), ("b", 5)]
    assert rows(features.features_of(stored, "id", ["x"])) == [("a", 9)]


def test_constant_column_is_divided_by_one(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r["x_scaled"] for r in features.scale(df, features.fit_scales(df, ["x"])).collect()] == [0.0, 0.0]


RULES = {"age": {"type": "int", "nullable": False, "min_value": 40, "max_value": 120}, "patient_id": {"type": "string", "unique": True},
         "sex": {"allowed_values": ["M", "F"]}, "weight": {"type": "float"}, "wbc_count": {"type": "float", "min_value": 0, "open_min": True}}


def test_rules_all_run(spark, cohort):
    doubled = cohort.unionByName(cohort.filter("patient_id = 'p1'"))
    report = {(r["column_name"], r["rule"]): r["violations"] for r in quality.rule_report(doubled, RULES).collect()}
    assert report["age", "min_value"] == 2 and report["patient_id", "unique"] == 1 and report["sex", "allowed_values"] == 3
    assert report["weight", "absent"] == 6 and report["age", "not_null"] == 0 and report["wbc_count", "min_value"] == 0
    assert not quality.is_valid(quality.rule_report(cohort, RULES))
    with pytest.raises(ValueError, match="refused"):
        features.ingest_raw(cohort, cohort, "patient_id", RULES)
    assert features.ingest_raw(cohort, cohort, "patient_id", None).count() == 5
    assert quality.load_rules('{"age": {"min_value": 1}}') == {"age": {"min_value": 1}}


def test_moments_match_pandas(spark):
    values = [1.0, 2.0, 2.5, 7.0, 11.0, 3.0]
    got = quality.distribution_metrics(spark.createDataFrame([(v,) for v in values], "x double"), ["x"]).first()
    s = pd.Series(values)
    assert got["skewness"] == pytest.approx(s.skew()) and got["kurtosis"] == pytest.approx(s.kurtosis())
    assert got["std"] == pytest.approx(s.std()) and got["median"] == pytest.approx(s.median())
    short = quality.distribution_metrics(spark.createDataFrame([(1.0,), (2.0,)], "x double"), ["x"]).first()
    assert short["skewness"] is None and short["kurtosis"] is None


def test_drift_of_a_negative_mean(spark):
    a = spark.createDataFrame([(-10.0,), (-12.0,)], "x double")
    b = spark.createDataFrame([(-20.0,), (-22.0,)], "x double")
    assert quality.drift(a, b, ["x"]).first()["drifted"]


def test_scorecard_levels(spark):
    metrics = spark.createDataFrame([("a", 80.0), ("b", 31.0), ("c", 40.0), ("d", 1.0)], "metric string, value double")
    card = quality.scorecard(metrics, [("a", ">=", 80.0, None), ("b", "<=", 30.0, 35.0), ("c", "<=", 30.0, 35.0)])
    assert dict(rows(card.select("metric", "status"))) == {"a": "PASS", "b": "WARNING", "c": "FAIL", "d": "INFO"}
    assert quality.overall_status(card).first()[0] == "FAIL"


def test_quality_log(spark):
    log = spark.createDataFrame([], "log_id bigint, stage string, is_valid boolean, errors string, warnings string, logged_at timestamp")
    for n in range(3):
        log = quality.log_entry(spark, log, f"s{n}", True, [], ["w"])
    assert [r["stage"] for r in quality.recent_log(log, 2).collect()] == ["s2", "s1"]


def test_batch_factors_and_variance(spark):
    df = spark.createDataFrame([("1", 30.0), ("2", 32.0), ("3", 37.0)], "batch string, q double")
    factors = normalise.batch_factors(df, "batch", F.avg("q"))
    got = {r["batch"]: r for r in factors.collect()}
    assert got["1"]["normalization_factor"] == pytest.approx(3.0) and got["3"]["z_score"] == pytest.approx(4 / 13 ** 0.5)
    assert normalise.variance_reduction(factors).first()["variance_reduction"] == pytest.approx(100)


def test_schema_enforcement_and_merge(spark):
    t = spark.createDataFrame([(1, "a")], "id int, x string")
    with pytest.raises(ValueError, match="only_right"):
        changes.append_enforced(t, spark.createDataFrame([(1, "a", 2)], "id int, x string, y int"))
    with pytest.raises(ValueError, match="type_mismatch"):
        changes.append_enforced(t, spark.createDataFrame([(1, 2)], "id int, x int"))
    grown = changes.append_merged(t, spark.createDataFrame([(2, "b", 5)], "id int, x string, y int"))
    assert rows(grown, "id") == [(1, "a", None), (2, "b", 5)]
    assert rows(changes.schema_differences(t, grown)) == [("y", "only_right", None, "int")]
    with pytest.raises(PySparkException, match="still missing"):
        changes.backfill(grown, "y", F.lit(None).cast("int")).collect()


def test_merge_with_null_updates(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    s = spark.createDataFrame([(2, None), (3, "c")], "id int, x string")
    assert rows(changes.merge_upsert(t, s, ["id"]), "id") == [(1, "a"), (2, None), (3, "c")]
    assert rows(changes.merge_update_only(t, s, ["id"], "x"), "id") == [(1, "a"), (2, None)]
    audit = changes.change_audit(t, changes.merge_upsert(t, s, ["id"]), ["id"], ["x"])
    assert rows(audit.select("id", "operation", "old_value", "new_value"), "id") == [(2, "UPDATE", "b", None), (3, "INSERT", None, "c")]


def test_as_of_drops_tombstones(spark):
    h = spark.createDataFrame([(1, 1, "a", False), (1, 5, None, True), (2, 2, "b", False), (2, 9, "c", False)],
                              "id int, valid_from int, x string, is_deleted boolean")
    assert rows(changes.as_of(h, ["id"], F.lit(4)).select("id", "x"), "id") == [(1, "a"), (2, "b")]
    assert rows(changes.as_of(h, ["id"], F.lit(9)).select("id", "x"), "id") == [(2, "c")]


def test_segments_and_regions(spark):
    df = spark.createDataFrame([("s", i, c) for i, c in enumerate("AAABBAAAAAC")], "k string, pos int, c string")
    got = rows(windows.segments(df, ["k"], ["pos"], F.floor(F.col("pos") / 3), "c", "pos", 2).select("c", "start", "end"), "start")
    assert got == [("A", 0, 2), ("B", 3, 4), ("A", 5, 9)]
    here = spark.createDataFrame([("1", 5), ("1", 9), ("X", 1)], "chrom string, pos int")
    assert filters.in_regions(here, ["1:5-8", "X"]).count() == 2
    with pytest.raises(ValueError):
        filters.in_regions(here, ["1:5"])
    assert rows(filters.regions(spark, ["1:5-8", "X"])) == [("1", 5, 8), ("X", None, None)]


def test_diversity_by_hand(spark):
    t = spark.createDataFrame([("a", "x", 1), ("a", "y", 1), ("a", "z", 2), ("b", "x", 3), ("c", "w", 4)], "sample string, taxon string, count bigint")
    a = {r["sample"]: r for r in diversity.alpha_diversity(t).collect()}
    assert a["a"]["shannon"] == pytest.approx(1.5) and a["a"]["simpson"] == pytest.approx(0.625) and a["a"]["chao1"] == pytest.approx(3.5)
    d = {(r["a"], r["b"]): r for r in diversity.beta_diversity(t).collect()}
    assert d["a", "b"]["bray_curtis"] == pytest.approx(5 / 7) and d["a", "b"]["jaccard"] == pytest.approx(2 / 3)
    assert d["a", "c"]["bray_curtis"] == 1.0

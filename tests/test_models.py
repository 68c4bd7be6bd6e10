"""Cross-validation."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from strandlake.operators import models


def test_cross_validation_fits_only_its_folds(spark, monkeypatch):
    data = spark.range(0, 600, 1, 4).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("kind"), (F.col("id") * 37 % 101).cast("double").alias("x"),
        ((F.col("id") * 37 % 101 + F.col("id") * 13 % 40) > 70).cast("double").alias("label"))
    fits, fit = [], LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, df: fits.append(df.count()) or fit(self, df))
    found = {r["model"]: r["auc"] for r in models.cross_validated_auc(data, ["kind"], ["x"], "label", ["logistic", "forest"], folds=3).collect()}
    assert len(fits) == 3 and sum(fits) == 2 * 600  # each row is in all training sets but one; no fit on all rows
    stages, _ = models._stages(["kind"], ["x"])
    ready = models.Pipeline(stages=stages).fit(data).transform(data).select("features", "label").persist()
    for kind in ("logistic", "forest"):
        whole = CrossValidator(estimator=models.classifier(kind, "label"), estimatorParamMaps=ParamGridBuilder().build(), numFolds=3,
                               evaluator=BinaryClassificationEvaluator(labelCol="label"), seed=models.SEED).fit(ready)
        assert found[kind] == pytest.approx(whole.avgMetrics[0], abs=1e-9)
    ready.unpersist()


def test_trees_grown_on_cells_equal_trees_grown_on_rows(spark, monkeypatch):
    def some(n, salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("double")

    data = spark.range(0, 4000, 1, 4).select(F.when(some(2, 1) > 0, "a").otherwise("b").alias("kind"), some(13, 2).alias("x"), some(3, 3).alias("y"),
                                             (some(13, 2) + 3 * some(3, 3) + some(9, 4) > 13).cast("double").alias("label"))
    fits, fit = [], models.GBTClassifier._fit
    monkeypatch.setattr(models.GBTClassifier, "_fit", lambda self, df: fits.append(df.count()) or fit(self, df))
    rows, cells = ({r["model"]: r["auc"] for r in models.cross_validated_auc(
        data, ["kind"], ["x", "y"], "label", ["logistic", "forest", "boosted"], folds=2, least_rows=least).collect()} for least in (10_000, 1))
    assert sum(fits[:2]) == 4000 and max(fits[2:]) <= 2 * 13 * 3 * 2
    assert cells["boosted"] == pytest.approx(rows["boosted"], abs=1e-9) and cells["logistic"] == pytest.approx(rows["logistic"], abs=1e-9)
    assert cells["forest"] == pytest.approx(rows["forest"], abs=0.01) and cells["forest"] > 0.8  # other draws of the same chances


def test_cells_hold_all_rows_and_draw_each(spark):
    data = spark.range(0, 20_000, 1, 4).select((F.col("id") * 7 % 1000).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("y"),
                                              F.lit(0.0).alias("k"), (F.col("id") % 2).cast("double").alias("label"))
    x, y = models._bounds(data, ["x", "y"])
    assert y == [0.5, 1.5, 2.5, 3.5] and len(x) == models.BINS - 1 and all(abs(b - 1000 * (i + 1) / 32) < 4 for i, b in enumerate(x))
    values = spark.createDataFrame([(float(v),) for v in (-1, 0.5, 0.6, 9)], "v double")
    assert [r[0] for r in values.select(models._bin(F.col("v"), y)).collect()] == [0, 0, 1, 4]  # a value at a bound is below it
    found = models._cells(data, ["x", "y"], ["k"], "label", F.lit(0)).toPandas()
    assert found["_n"].sum() == 20_000 and len(found) <= 32 * 5 * 2
    for i in range(models.TREES):
        assert abs(found[f"_w{i}"].sum() - 20_000) < 5 * 20_000 ** 0.5  # Poisson(1) for each row
    spread = sum(((found[f"_w{i}"] - found["_n"]) ** 2 / found["_n"]).mean() for i in range(models.TREES)) / models.TREES
    assert 0.85 < spread < 1.15

"""Model training and evaluation with Spark ML pipelines."""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.numeric import log2_plus_one

# Settings of the reference models.
TREES, DEPTH, SEED, FOLDS = 20, 5, 42, 5


def _stages(categorical: list[str], numeric: list[str]):
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep") for c in categorical]
    inputs = [*numeric, *[f"{c}_index" for c in categorical]]
    return [*indexers, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="skip")], inputs


def classifier(kind: str, label: str):
    """Logistic regression, random forest or boosted trees."""
    if kind == "logistic":
        return LogisticRegression(labelCol=label, maxIter=100)
    if kind == "forest":
        return RandomForestClassifier(labelCol=label, numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    if kind == "boosted":
        return GBTClassifier(labelCol=label, maxIter=20, maxDepth=3, seed=SEED)
    raise ValueError(f"unknown model {kind}")


def fit_pipeline(train: DataFrame, categorical: list[str], numeric: list[str], label: str, kind: str = "forest"):
    """ML-01: index categories (unknown kept), assemble, fit."""
    stages, _ = _stages(categorical, numeric)
    return Pipeline(stages=[*stages, classifier(kind, label)]).fit(train)


def area_under_curve(predictions: DataFrame, label: str) -> float:
    """ML-02."""
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC").evaluate(predictions)


def confusion(predictions: DataFrame, label: str) -> DataFrame:
    """ML-02: counts per (label, prediction)."""
    return predictions.groupBy(label, "prediction").agg(F.count("*").alias("n"))


def importances(model, categorical: list[str], numeric: list[str], spark) -> DataFrame:
    """ML-02: importance per input column."""
    _, inputs = _stages(categorical, numeric)
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(inputs, values)], "feature string, importance double")


#: Bins of a numeric column in trees: Spark's default. Tables below so many rows, or with fewer rows a cell, are fitted by rows.
BINS, LEAST_ROWS, LEAST_ROWS_A_CELL = 32, 1_000_000, 8
#: Error of the rank of a bin's bound, as a share of the rows.
RANK_ERROR = 0.001
#: Fits to cells that run at once for each fit to rows.
CELL_FITS = 4
#: Chances that a row is drawn at most 0, 1, 2.. times for a tree, as far as a double tells them from 1.
_DRAWN = [math.exp(-1) * sum(1 / math.factorial(i) for i in range(k + 1)) for k in range(17)]


def _bounds(rows: DataFrame, columns: list[str]) -> list[list[float]]:
    """Bounds of at most ``BINS`` bins per column: between all values where they are few, else at equal shares of all rows."""
    few = {c: sorted(r[0] for r in rows.select(c).distinct().limit(BINS + 1).collect()) for c in columns}
    many = [c for c in columns if len(few[c]) > BINS]
    shares = rows.approxQuantile(many, [i / BINS for i in range(1, BINS)], RANK_ERROR) if many else []
    found = dict(zip(many, (sorted(set(x)) for x in shares)))
    return [found[c] if c in found else [(a + b) / 2 for a, b in zip(few[c], few[c][1:])] for c in columns]


def _bin(column: Column, bounds: list[float], first: int = 0) -> Column:
    """Number of the bin; a value at a bound is below it, as in trees."""
    if not bounds:
        return F.lit(float(first))
    half = len(bounds) // 2
    return F.when(column <= bounds[half], _bin(column, bounds[:half], first)).otherwise(
        _bin(column, bounds[half + 1:], first + half + 1))


def _times_drawn(uniform: Column) -> Column:
    """Poisson(1) from a number in [0, 1): how often a tree's bootstrap draws a row."""
    out = F.when(uniform < _DRAWN[0], F.lit(0))
    for k, chance in enumerate(_DRAWN[1:], 1):
        out = out.when(uniform < chance, F.lit(k))
    return out.otherwise(F.lit(len(_DRAWN)))


def _cells(ready: DataFrame, numeric: list[str], indexed: list[str], label: str, fold: Column) -> DataFrame:
    """What trees see of all rows: per bins, indexes, label and fold the rows ``_n`` and how often tree i draws them, ``_w{i}``.

    Trees look at rows by their bins only, so rows of a cell are one row with a weight. There are at most ``BINS`` to the
    power of the columns, however many rows there are. Each row is drawn by itself for each tree.
    """
    bins = [_bin(F.col(c), b).alias(c) for c, b in zip(numeric, _bounds(ready, numeric))]
    drawn = ready.select(*bins, *indexed, label, fold.alias("_fold"), *[F.rand(SEED + 1 + i).alias(f"_u{i}") for i in range(TREES)])
    return drawn.groupBy(*numeric, *indexed, label, "_fold").agg(
        F.count("*").alias("_n"), *[F.sum(_times_drawn(F.col(f"_u{i}"))).alias(f"_w{i}") for i in range(TREES)])


def _areas_by_cells(cells: DataFrame, inputs: list[str], features: Column, label: str, kinds: list[str], fold: int, fits: int) -> list[float]:
    """AUC of each kind of trees, fitted to the cells outside the fold, on those in it; ``fits`` fits run at once."""
    drawn, tasks = [f"_w{i}" for i in range(TREES)], cells.sparkSession.sparkContext.defaultParallelism
    train = cells.filter(F.col("_fold") != fold).groupBy(*inputs, label).agg(*[F.sum(c).alias(c) for c in ("_n", *drawn)]).select(
        features, label, "_n", *drawn).coalesce(tasks).persist()
    test = cells.filter(F.col("_fold") == fold).select(features, label, "_n")
    # With so many bins Spark takes the values of all cells, which are bins already, and not those of some.
    bins = max(BINS, math.isqrt(train.count()) + 1)

    def fit(part: tuple[str, int]):
        kind, i = part
        if kind != "forest":
            return classifier(kind, label).setWeightCol("_n").setMaxBins(bins).fit(train)
        # One tree of the forest: its bootstrap is in the weights, and a row that is not drawn is not there.
        tree = RandomForestClassifier(labelCol=label, numTrees=1, maxDepth=DEPTH, seed=SEED + i, bootstrap=False, featureSubsetStrategy="sqrt",
                                      weightCol=drawn[i], maxBins=bins, probabilityCol=f"_p{i}", rawPredictionCol="", predictionCol="")
        return tree.fit(train.filter(F.col(drawn[i]) > 0))

    parts = [(kind, i) for kind in sorted(kinds) for i in range(TREES if kind == "forest" else 1)]  # boosted, the longest, first
    with ThreadPool(fits) as pool:
        fitted = dict(zip(parts, pool.map(inheritable_thread_target(cells.sparkSession)(fit), parts, chunksize=1)))
    train.unpersist()
    judge = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", weightCol="_n")
    areas = []
    for kind in kinds:
        found = test
        for i in range(TREES if kind == "forest" else 1):
            found = fitted[kind, i].transform(found)
        if kind == "forest":  # the share of votes for class 1
            votes = sum((F.get(vector_to_array(f"_p{i}"), F.lit(1)) for i in range(TREES)), F.lit(0.0))
            found = found.select(label, "_n", (votes / TREES).alias("rawPrediction"))
        areas.append(judge.evaluate(found))
    return areas


def cross_validated_auc(train: DataFrame, categorical: list[str], numeric: list[str], label: str, kinds: list[str],
                        folds: int = FOLDS, parallelism: int = 2, least_rows: int = LEAST_ROWS) -> DataFrame:
    """ML-03: mean AUC over folds per model kind; each fold is fitted on all rows outside it and judged on all rows in it.

    The folds are those of ``CrossValidator`` with this seed. Its last step, a fit of the best setting on all rows, is left
    out: there is one setting and nothing reads that model. ``parallelism`` fits run at once over one stored table, so that
    one uses the cores that another's longest task leaves idle; the rows that trees keep in memory grow with it.

    From ``least_rows`` on, if cells are few, trees are grown on the cells of ``_cells`` in place of rows: the same boosted
    trees for the same bins, and as many trees in the forest, whose bootstrap draws each row by the same chances.
    """
    stages, inputs = _stages(categorical, numeric)
    indexed = inputs[len(numeric):]
    # Indexing and assembling do not look at the label, so they are done once for all folds.
    ready = Pipeline(stages=stages).fit(train).transform(train).select(
        F.col("features"), *[F.col(c).cast("double").alias(c) for c in numeric], *indexed, F.col(label), F.rand(SEED).alias("_draw")).persist()
    judge = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    share = 1.0 / folds

    def held_out(fold: int) -> Column:
        return (F.col("_draw") >= fold * share) & (F.col("_draw") < (fold + 1) * share)

    def score(kind: str, fold: int) -> float:
        model = classifier(kind, label).fit(ready.filter(~held_out(fold)))
        return judge.evaluate(model.transform(ready.filter(held_out(fold))))

    rows = ready.count()  # stored once, before fits run side by side
    trees = [kind for kind in kinds if kind != "logistic"]
    areas: dict[str, list[float]] = {}
    if trees and rows >= least_rows:
        cells = _cells(ready, numeric, indexed, label, F.coalesce(*[F.when(held_out(k), F.lit(k)) for k in range(folds)], F.lit(-1))).coalesce(
            train.sparkSession.sparkContext.defaultParallelism).persist()
        if cells.select(*inputs, label).distinct().count() * LEAST_ROWS_A_CELL <= rows:
            features = array_to_vector(F.array(*inputs)).alias("features", metadata=ready.schema["features"].metadata)
            found = [_areas_by_cells(cells, inputs, features, label, trees, fold, CELL_FITS * parallelism) for fold in range(folds)]
            areas = dict(zip(trees, zip(*found)))
        cells.unpersist()
    by_rows = [kind for kind in kinds if kind not in areas]
    with ThreadPool(parallelism) as pool:
        run = inheritable_thread_target(train.sparkSession)(lambda x: score(*x))
        found = pool.map(run, [(kind, fold) for kind in by_rows for fold in range(folds)], chunksize=1)
    ready.unpersist()
    areas |= {kind: found[i * folds:(i + 1) * folds] for i, kind in enumerate(by_rows)}
    means = [(kind, sum(areas[kind]) / folds) for kind in kinds]
    return train.sparkSession.createDataFrame(means, "model string, auc double")


def principal_components(long: DataFrame, row: str, column: str, value: str, top: int, k: int) -> tuple[DataFrame, DataFrame]:
    """ML-04: log2(x+1), the ``top`` most variable columns, z-score, then k components.

    Returns (row, components) and (component, explained share). The sign of a component is free.
    """
    logged = long.withColumn("_x", log2_plus_one(F.col(value)))
    stats = logged.groupBy(column).agg(F.var_samp("_x").alias("_var"), F.avg("_x").alias("_m"), F.stddev_pop("_x").alias("_s"))
    chosen = stats.orderBy(F.desc("_var"), column).limit(top)
    scaled = logged.join(chosen, column).withColumn("_z", F.when(F.col("_s") > 0, (F.col("_x") - F.col("_m")) / F.col("_s")).otherwise(0.0))
    # One vector of ``top`` places per row, a place for each chosen column: a cell that a row lacks is at its mean.
    names = sorted(r[0] for r in chosen.select(column).collect())  # at most ``top``
    cells = [F.coalesce(F.max(F.when(F.col(column) == F.lit(n), F.col("_z"))), F.lit(0.0)) for n in names]
    rows = scaled.groupBy(row).agg(F.array(*cells).alias("_c")).select(row, array_to_vector("_c").alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="_pca").fit(rows)
    scores = model.transform(rows).select(row, vector_to_array("_pca").alias("components"))
    explained = long.sparkSession.createDataFrame(
        [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance.toArray())], "component int, explained double")
    return scores, explained

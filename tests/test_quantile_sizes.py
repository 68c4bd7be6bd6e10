"""Exact quantiles over many group sizes, from one row to far above the sketch size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.operators import quantiles
from strandlake.operators.performance import plan_text
from strandlake.operators.quantiles import exact_quantiles, quantile_columns


def test_every_small_group_size(spark):
    rng = np.random.default_rng(1)
    groups = {n: rng.integers(0, max(2, n // 2), n).astype(float) for n in range(1, 120)}
    df = spark.createDataFrame([(n, float(v)) for n, vs in groups.items() for v in vs], "k int, v double")
    probs = [0.1, 0.25, 0.5, 0.75, 0.97]
    for accuracy in (20, 10000):
        for r in exact_quantiles(df, ["k"], "v", probs, accuracy).collect():
            assert r["value"] == pytest.approx(np.quantile(groups[r["k"]], r["prob"]), abs=1e-9)


def test_large_skewed_group(spark):
    df = spark.range(200000).select((F.pow(F.pmod(F.xxhash64("id"), F.lit(100003)) / 1000.0, 3)).alias("v"))
    df = df.withColumn("v", F.when(F.col("v") < 300, 7.0).otherwise(F.col("v")))
    values = np.array([r[0] for r in df.collect()])
    got = quantile_columns(df, [], "v", {"a": 0.01, "b": 0.5, "c": 0.999}).first()
    for name, p in (("a", 0.01), ("b", 0.5), ("c", 0.999)):
        assert got[name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_rows_of_a_hot_group_are_not_brought_together(spark, monkeypatch):
    """Brackets go to the rows: even when Spark may broadcast nothing by itself, no shuffled join gathers a group."""
    seen = []
    plain = quantiles.running_sums
    monkeypatch.setattr(quantiles, "running_sums", lambda df, *a, **k: seen.append(plan_text(df)) or plain(df, *a, **k))
    df = spark.range(3000).selectExpr("if(id < 2900, 'hot', string(id % 7)) as k", "cast(id * 37 % 1000 as double) as v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = sorted(map(tuple, exact_quantiles(df, ["k"], "v", [0.25, 0.5], 50).collect()))
        monkeypatch.setattr(quantiles, "FEW_GROUPS", 3)
        many = sorted(map(tuple, exact_quantiles(df, ["k"], "v", [0.25, 0.5], 50).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert few == many and len(few) == 16
    assert "SortMergeJoin" not in seen[0] and "SortMergeJoin" in seen[1]

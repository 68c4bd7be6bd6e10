"""A NULL key is a group like any other, and ranks keep every digit."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strandlake.operators import aggregates, normalise, quantiles, sampling, windows


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame([(None if i % 2 else "k", i, float(i % 5)) for i in range(20)], "k string, i bigint, v double")


def test_windows_keep_null_keys(data):
    block = F.floor(F.col("i") / 4)
    ran = windows.running(data, ["k"], ["i"], block, {"n": F.lit(1)}).collect()
    assert sorted(r["n"] for r in ran if r["k"] is None) == list(range(1, 11)) and len(ran) == 20
    near = windows.with_next(data, ["k"], ["i"], block, {"then": "i"}).collect()
    assert {(r["i"], r["then"]) for r in near} == {(i, i + 2 if i < 18 else None) for i in range(20)}
    assert windows.top_share_by_rank(data, ["k"], "v").count() == 20
    assert {r["k"] for r in windows.half_seen(data, "k", "i", block).collect()} == {None, "k"}


def test_null_values_rank_first(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7), (4, 5)], "id int, v int")
    got = {r["id"]: r["percentile"] for r in windows.percent_ranks(df, "v").collect()}
    assert got == pytest.approx({1: 0.0, 2: 100 / 3, 4: 100 / 3, 3: 100.0})


def test_ranks_beyond_doubles(spark):
    big = spark.createDataFrame([(2 ** 53 + i,) for i in range(3)], "v bigint")
    assert {r["v"] - 2 ** 53: r["n_before"] for r in windows.value_ranks(big, [], "v").collect()} == {0: 0, 1: 1, 2: 2}
    assert {r["v"] - 2 ** 53: r["n_before"] for r in windows.value_ranks(big, [], "v", True).collect()} == {0: 2, 1: 1, 2: 0}
    long = spark.createDataFrame([(Decimal("12345678901234567890.%d" % i),) for i in (1, 2, 3)], "v decimal(30,1)")
    assert sorted(r["n_before"] for r in windows.value_ranks(long, [], "v").collect()) == [0, 1, 2]


def test_groups_keep_null_keys(data):
    assert {r["k"] for r in aggregates.mode_per_group(data, ["k"], "v").collect()} == {None, "k"}
    assert {(r["k"], r["value"]) for r in quantiles.exact_quantiles(data, ["k"], "i", [0.5]).collect()} == {("k", 9.0), (None, 10.0)}
    split = sampling.stratified_split(data, ["i"], ["k"], {"a": 0.6, "b": 0.4}, 1).groupBy("k", "part").count().collect()
    assert {(r["k"], r["part"]): r["count"] for r in split} == {("k", "a"): 6, ("k", "b"): 4, (None, "a"): 6, (None, "b"): 4}


def test_normalisation_keeps_null_keys(data):
    assert normalise.bin_zscores(data, "k", "v").count() == 20
    assert normalise.median_normalised(data, "k", "v").count() == 20
    assert normalise.batch_centred(data, "k", "v", "i").count() == 20
    assert normalise.gc_corrected(data, "k", "v", "i").count() == 20
    lengths = data.select("i", F.lit(2.0).alias("kb")).distinct()
    total = normalise.tpm(data, lengths, "k", "i", "v", "kb").groupBy("k").agg(F.sum("tpm").alias("s")).collect()
    assert {r["k"]: round(r["s"]) for r in total} == {None: 1_000_000, "k": 1_000_000}


def test_small_values_are_not_rounded(spark):
    df = spark.createDataFrame([("g", "t", 0.003), ("g", "c", 0.001)], "g string, c string, v double")
    row = aggregates.fold_change(df, "g", "v", "c", "t", "c").first()
    assert (row["mean_treated"], row["mean_control"]) == (0.003, 0.001) and row["fold_change"] == pytest.approx(3.0)

"""Scans dealt by range: one key with most rows spreads over tasks, results stay those of a plain window."""

import decimal
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strandlake.operators import ordered, quantiles, sampling, windows


@pytest.fixture(scope="module")
def hot(spark):
    r = random.Random(5)
    data = [("hot", i, r.randrange(100)) for i in range(4000)] + [(f"k{i % 7}", i, r.randrange(9)) for i in range(900)] + [
        (None, i, 1) for i in range(50)]
    r.shuffle(data)
    return spark.createDataFrame(data, "k string, i int, v int").repartition(6).cache()


@pytest.fixture
def parts(spark):
    """Ranges that adaptive execution does not merge again."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_sums_equal_a_window(hot, parts, keys):
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("k", "i")
    want = hot.withColumn("s", F.sum("v").over(w)).withColumn("n", F.row_number().over(w)).collect()
    got = windows.running(hot, keys, ["k", "i"], None, {"s": F.col("v"), "n": F.lit(1)}).collect()
    assert sorted(map(str, got)) == sorted(map(str, [r for r in want])) and len(got) == 4950


def test_neighbours_equal_a_window(hot, parts):
    w = Window.partitionBy("k").orderBy("i")
    for forward, step in ((True, F.lead), (False, F.lag)):
        want = hot.withColumns({"a": step("v").over(w), "b": step("i").over(w)}).collect()
        got = ordered.neighbours(hot, ["k"], ["i"], {"a": "v", "b": "i"}, forward).collect()
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_a_hot_key_spreads_with_the_parts(hot, parts):
    largest = []
    for n in (4, 16, 64):
        dealt = ordered.dealt_by_range(hot, ["k"], ["i"], n)
        assert dealt.count() == hot.count()
        largest.append(dealt.groupBy("_part").count().agg(F.max("count")).first()[0])
    assert largest[0] > 2 * largest[1] > 2 * largest[2]


def test_carried_rows_are_bounded_by_the_parts(spark, parts):
    many = spark.range(20000).select((F.col("id") % 5000).cast("string").alias("k"), "id")
    rows = ordered.dealt_by_range(many, ["k"], ["id"], 8)
    per_part = rows.groupBy("_part", "k").count()
    assert per_part.count() >= 5000 and ordered._of_split_keys(per_part, ["k"]).count() <= 16


def test_ranks_equal_a_window(hot, parts):
    for descending, order in ((False, F.asc("v")), (True, F.desc("v"))):
        w = Window.partitionBy("k").orderBy(order)
        want = {(r.k, r.v): r.x for r in hot.withColumn("x", F.rank().over(w) - 1).collect()}
        assert {(r.k, r.v): r.n_before for r in windows.value_ranks(hot, ["k"], "v", descending).collect()} == want


@pytest.mark.parametrize("kind, make", [
    ("decimal(38,10)", lambda x: decimal.Decimal(12345678901234567890123456) + decimal.Decimal(x) / 10 ** 10),
    ("bigint", lambda x: 2 ** 62 + x), ("double", float)])
def test_ranks_keep_every_digit(spark, kind, make):
    r = random.Random(3)
    values = sorted(make(r.randrange(400)) for _ in range(1501))
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    for accuracy in (20, 10000):
        for row in quantiles.exact_ranks(df, [], "v", [0.0, 0.1, 0.25, 0.5, 0.9, 1.0], accuracy).collect():
            at = (len(values) - 1) * row.prob
            assert (row.low, row.high) == (values[int(at)], values[min(int(at) + (at > int(at)), len(values) - 1)]), row


def test_one_scan_for_several_columns(hot):
    got = {(r.column_name, r.prob): r.value for r in quantiles.quantiles_of_columns(hot, ["i", "v"], [0.25, 0.5]).collect()}
    want = {(c, p): hot.select(F.percentile(c, p)).first()[0] for c in ("i", "v") for p in (0.25, 0.5)}
    assert got == want


def test_split_shares_hold_in_a_hot_stratum(hot, parts):
    out = sampling.stratified_split(hot, ["k", "i"], ["k"], {"a": 0.6, "b": 0.2, "c": 0.2}, 3)
    counts = {(r.k, r.part): r["count"] for r in out.groupBy("k", "part").count().collect()}
    assert (counts["hot", "a"], counts["hot", "b"], counts["hot", "c"]) == (2400, 800, 800)
    assert sum(counts.values()) == hot.count()


def test_nearest_known(spark, parts):
    r = random.Random(8)
    data = [(i, None if r.random() < 0.7 or 40 < i < 90 else i * 10) for i in range(200)]
    df = spark.createDataFrame(data, "i int, v int").repartition(5)
    got = {x.i: (x.b, x.a) for x in ordered.nearest_known(df, "i", F.col("v"), "b", "a").collect()}
    for i, _ in data:
        assert got[i] == (max((v for j, v in data if j <= i and v is not None), default=None),
                          min((v for j, v in data if j >= i and v is not None), default=None))

"""Interval joins with intervals of all lengths, crowded bins and deep targets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from strandlake.operators import coverage, intervals
from strandlake.operators.performance import plan_text


def spans(seed, n, longest):
    r = random.Random(seed)
    out = []
    for j in range(n):
        length = int(2 ** r.uniform(0, np.log2(longest)))
        s = r.randrange(0, 2_000_000)
        out.append((r.choice(["1", "1", "1", "2"]), s, s + length, f"g{seed}_{j}"))
    return out + [("1", 0, 10 ** 9, f"whole{seed}"), ("1", 5, 5, f"empty{seed}"), ("2", 9, 3, f"turned{seed}")]


@pytest.fixture
def crowded(monkeypatch, spark):
    """Bins count as crowded from a few rows on."""
    monkeypatch.setattr(intervals, "HOT_SHARE", 0.0)
    monkeypatch.setattr(intervals, "HOT_ROWS", 10)
    monkeypatch.setattr(intervals, "ONE_IN", 1)


def frame(spark, data):
    return spark.createDataFrame(data, "chrom string, start bigint, end bigint, gene string")


def want_pairs(a, b):
    return sorted((m, n, max(s, u), min(e, v)) for c, s, e, m in a for d, u, v, n in b
                  if c == d and s < e and u < v and s < v and u < e)


def got_pairs(df):
    return sorted((r["gene"], r["gene_b"], r["overlap_start"], r["overlap_end"]) for r in df.collect())


def test_overlaps_of_all_lengths(spark):
    a, b = spans(1, 150, 500_000), spans(2, 120, 900)
    for x, y in ((a, b), (b, a), (a, a)):
        assert got_pairs(intervals.overlaps(frame(spark, x), frame(spark, y), 64)) == want_pairs(x, y)


def test_overlaps_in_crowded_bins(spark, crowded):
    a = [("1", 1000 + i % 3, 1040, f"a{i}") for i in range(90)] + spans(3, 30, 100_000)
    b = [("1", 990, 1010 + i % 40, f"b{i}") for i in range(70)] + spans(4, 30, 5000)
    assert got_pairs(intervals.overlaps(frame(spark, a), frame(spark, b), 64)) == want_pairs(a, b)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [False, True])
def test_points_and_intervals_of_all_lengths(spark, request, how, hot):
    if hot:
        request.getfixturevalue("crowded")
    r = random.Random(7)
    g = spans(5, 120, 400_000)[:-3] + [("1", 700_000, 1_500_000, "long")]
    points = [(r.choice(["1", "2", "3", None]), 900_000 if r.random() < 0.4 else r.randrange(2_000_000), i) for i in range(500)]
    out = intervals.annotate_points(spark.createDataFrame(points, "chrom string, pos bigint, id int"), frame(spark, g), 64, how=how)
    want = [(i, n, s, e) for c, x, i in points for d, s, e, n in g if c == d and s <= x <= e]
    if how == "left":
        hit = {w[0] for w in want}
        want += [(i, None, None, None) for _, _, i in points if i not in hit]
    assert sorted(((r.id, r.gene, r.start, r.end) for r in out.collect()), key=str) == sorted(want, key=str)


def test_nothing_to_meet(spark):
    none, some = frame(spark, []), frame(spark, spans(6, 5, 50))
    points = spark.createDataFrame([("1", 7)], "chrom string, pos bigint")
    assert intervals.overlaps(none, some, 64).count() == intervals.overlaps(some, none, 64).count() == 0
    assert intervals.annotate_points(points, none, 64).count() == 0
    assert intervals.annotate_points(points, none, 64, how="left").count() == 1


def test_an_interval_has_two_rows_at_most(spark):
    long = frame(spark, [("1", 3, 2 ** 40, "a"), ("1", 0, 1, "b"), ("1", 63, 65, "c")])
    rows_ = intervals._in_bins(long.withColumn("_level", intervals._level(F.col("end") - F.col("start"), 64)), F.col("start"), F.col("end") - 1, 64)
    assert max(r["count"] for r in rows_.groupBy("gene").count().collect()) == 2


def test_coverage_from_runs(spark, monkeypatch):
    monkeypatch.setattr(coverage, "DEPTH_BLOCK", 50)
    r = random.Random(3)
    targets = [(f"t{i}", "1", i * 400, i * 400 + r.randrange(1, 390)) for i in range(8)] + [("bare", "2", 0, 10), ("none", "1", 5, 5)]
    align = [("1", s, s + r.randrange(1, 200)) for s in (r.randrange(3400) for _ in range(300))] + [("1", 100, 3000)] * 40
    t = spark.createDataFrame(targets, "target string, chrom string, start int, end int")
    a = spark.createDataFrame(align, "chrom string, start int, end int")
    runs = coverage.depth_runs(t, a, 16)
    got = {x["target"]: x for x in coverage.coverage_statistics(runs).collect()}
    assert set(got) == {x[0] for x in targets} - {"none"}
    for name, chrom, s, e in targets[:-1]:
        depth = np.array([sum(c == chrom and u <= p < v for c, u, v in align) for p in range(s, e)])
        x = got[name]
        assert (x["positions"], x["min_coverage"], x["max_coverage"], x["median_coverage"]) == (len(depth), depth.min(), depth.max(), np.median(depth))
        assert x["mean_coverage"] == pytest.approx(depth.mean()) and x["pct_20x"] == pytest.approx((depth >= 20).mean() * 100)
        assert x["cv_pct"] == pytest.approx(depth.std() / depth.mean() * 100 if depth.any() else 0.0)
    wide = spark.createDataFrame([("w", "1", 0, 10 ** 9)], "target string, chrom string, start int, end int")
    assert coverage.depth_runs(wide, a, 16).count() < 2 * len(align) + 2
    assert rows(coverage.depth_runs(wide, a, 16).agg(F.sum("length"))) == [(10 ** 9,)]


def test_depth_steps_by_tasks_that_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(intervals, "STEP_ROWS", 40)
    r = random.Random(4)
    spans_ = [(c, s, s + r.randrange(1, 60)) for c, s in ((r.choice(["1", "1", None]), r.randrange(0, 400)) for _ in range(700))]
    got = intervals.covered_depth(spark.createDataFrame(spans_, "chrom string, start int, end int"), 16)
    assert "REPARTITION_BY_NUM" in plan_text(got) and " 35)" in plan_text(got)  # ceil(1400 / 40) tasks, not merged by bytes
    want = {(c, p) for c, s, e in spans_ for p in (s, e)}
    assert {(c, p): d for c, p, d in rows(got)} == {(c, p): sum(c == x and s <= p < e for x, s, e in spans_) for c, p in want}

"""Ordered operators against brute force on tables where one key holds most rows."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from strandlake.operators import aggregates, changes, graph, intervals, joins, normalise, sampling, windows
from strandlake.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.7 else rng.choice("abc")
        value = 5 if rng.random() < 0.4 else rng.randrange(200)
        data.append((i, key, value))
    return data, spark.createDataFrame(data, "id bigint, key string, value bigint").repartition(7).cache()


def by_key(data):
    out = {}
    for i, k, v in sorted(data):
        out.setdefault(k, []).append((i, v))
    return out


def test_running(skewed):
    data, df = skewed
    got = {r[0]: (r[3], r[4]) for r in windows.running(
        df, ["key"], ["id"], F.floor(F.col("id") / 100), {"s": F.col("value"), "n": F.lit(1)}).collect()}
    for _, items in by_key(data).items():
        total = 0
        for n, (i, v) in enumerate(items, 1):
            total += v
            assert got[i] == (total, n)


@pytest.mark.parametrize("forward", [True, False])
def test_neighbours(skewed, forward):
    data, df = skewed
    fn = windows.with_next if forward else windows.with_previous
    got = {r[0]: r[3] for r in fn(df, ["key"], ["id"], F.floor(F.col("id") / 50), {"other": "value"}).collect()}
    for _, items in by_key(data).items():
        values = [v for _, v in items]
        near = values[1:] + [None] if forward else [None] + values[:-1]
        assert [got[i] for i, _ in items] == near


@pytest.mark.parametrize("probs", [[0.0, 0.25, 0.5, 0.75, 1.0], [0.013, 0.987]])
def test_quantiles(skewed, probs):
    data, df = skewed
    got = {(r["key"], r["prob"]): r["value"] for r in exact_quantiles(df, ["key"], "value", probs, accuracy=50).collect()}
    for key, items in by_key(data).items():
        for p in probs:
            assert got[key, p] == pytest.approx(np.quantile([v for _, v in items], p), abs=1e-9)


def test_quantile_of_one_row_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.5), ("b", None), ("c", 2.0), ("c", 4.0)], "k string, v double")
    got = dict(rows(exact_quantiles(df, ["k"], "v", [0.5]).select("k", "value")))
    assert got == {"a": 1.5, "c": 3.0}


def test_numbers_and_tiles(skewed):
    data, df = skewed
    want = [i for i, _, _ in sorted(data, key=lambda r: (r[2], r[0]))]
    got = windows.numbered(df, ["value", "id"], "n").collect()
    assert [r["id"] for r in sorted(got, key=lambda r: r["n"])] == want
    assert sorted(r["n"] for r in got) == list(range(1, 3001))
    sizes = Counter(r["tile"] for r in windows.with_tiles(df.limit(100), ["value", "id"], 7).collect())
    assert sorted(sizes.values(), reverse=True) == [15, 15, 14, 14, 14, 14, 14] and sizes[1] == 15


def test_value_ranks(skewed):
    data, df = skewed
    got = {(r["key"], r["value"]): (r["n_before"], r["n_equal"], r["n_total"])
           for r in windows.value_ranks(df, ["key"], "value", blocks=32).collect()}
    for key, items in by_key(data).items():
        values = [v for _, v in items]
        for v in set(values):
            assert got[key, v] == (sum(x < v for x in values), values.count(v), len(values))


def test_top_pairs_with_a_huge_group(spark):
    rng = random.Random(3)
    sets = {g: {rng.randrange(25) for _ in range(rng.randrange(1, 6))} for g in range(200)}
    sets[999] = set(range(400))
    sets[998] = set(range(0, 300, 2))
    data = [(g, i) for g, items in sets.items() for i in items]
    counts = Counter(p for items in sets.values() for p in combinations(sorted(items), 2))
    want = sorted(((-n, a, b) for (a, b), n in counts.items()))[:10]
    got = aggregates.top_pairs(spark.createDataFrame(data, "g int, i int"), "g", "i", 10).collect()
    assert [(-r["n_groups"], r["item_a"], r["item_b"]) for r in got] == want


def test_stratified_split_shares(skewed):
    _, df = skewed
    out = sampling.stratified_split(df, ["id"], ["key"], {"a": 0.7, "b": 0.3}, 1)
    again = sampling.stratified_split(df.repartition(3), ["id"], ["key"], {"a": 0.7, "b": 0.3}, 1)
    assert rows(out, "id") == rows(again, "id")
    for key, n, a in rows(out.groupBy("key").agg(F.count("*"), F.count_if(F.col("part") == "a"))):
        assert a == int(n * 0.7 + 0.5)


@pytest.mark.parametrize("salts", [1, 5])
def test_interval_join_ends_and_overlap(spark, salts):
    rng = random.Random(5)
    points = [("c1" if rng.random() < 0.8 else "c2", 500 if rng.random() < 0.3 else rng.randrange(2000), i) for i in range(600)]
    spans = [(rng.choice(["c1", "c2"]), s, s + rng.randrange(0, 300), f"g{j}") for j, s in enumerate(rng.sample(range(1900), 60))]
    p = spark.createDataFrame(points, "chrom string, pos int, id int")
    g = spark.createDataFrame(spans, "chrom string, start int, end int, gene string")
    want = sorted((i, n) for c, x, i in points for d, s, e, n in spans if c == d and s <= x <= e)
    got = intervals.annotate_points(p, g, 37, salts=salts)
    assert sorted((r["id"], r["gene"]) for r in got.collect()) == want
    left = intervals.annotate_points(p, g, 37, how="left", salts=salts)
    hit = {i for i, _ in want}
    assert left.filter("gene is null").count() == len([1 for _, _, i in points if i not in hit])
    pairs = sorted((m, n, max(s, u), min(e, v)) for c, s, e, m in spans for d, u, v, n in spans if c == d and s < v and u < e)
    both = intervals.overlaps(g, g, 23)
    assert sorted((r["gene"], r["gene_b"], r["overlap_start"], r["overlap_end"]) for r in both.collect()) == pairs


def test_two_nearest_far_second(spark):
    rng = random.Random(11)
    sites = [(j, rng.random() * 1000, rng.random() * 1000) for j in range(25)] + [(99, 5000.0, 5000.0)]
    points = [(i, rng.random() * 1000, rng.random() * 1000) for i in range(80)] + [(500, 5001.0, 5001.0)]
    want = []
    for i, x, y in points:
        near = sorted((((x - a) ** 2 + (y - b) ** 2) ** 0.5, j) for j, a, b in sites)
        if near[0][0] < 60:
            want.append((i, near[1][1], near[0][1]))
    got = joins.two_nearest(spark.createDataFrame(points, "point_id int, x double, y double"),
                            spark.createDataFrame(sites, "site_id int, x double, y double"), 60.0)
    assert rows(got.select("point_id", "source", "target"), "point_id") == sorted(want)


def test_two_nearest_crowded_sites(spark):
    """Cells are as fine as the sites are dense, so few candidates are looked at; copies and shared ids keep their results."""
    rng = random.Random(12)
    sites = [(j, rng.random() * 100, rng.random() * 100) for j in range(400)] + [(1000 + j, 50.0, 50.0) for j in range(300)] + [(900, 800.0, 800.0)]
    points = [(i % 150, rng.random() * 120 - 10, rng.random() * 120 - 10) for i in range(200)] + [(None, 5.0, 5.0), (500, 790.0, 790.0), (501, 400.0, 400.0)]
    want = []
    for i in sorted({p[0] for p in points} - {None}):
        near = sorted({(((x - a) ** 2 + (y - b) ** 2) ** 0.5, j) for k, x, y in points if k == i for j, a, b in sites})
        if near[0][0] < 90:
            want.append((i, near[1][1], near[0][1]))
    frames = (spark.createDataFrame(points, "point_id int, x double, y double"),
              spark.createDataFrame(sites + sites[:30], "site_id int, x double, y double"))
    assert rows(joins.two_nearest(*frames, 90.0).select("point_id", "source", "target"), "point_id") == want
    assert joins._first_grid(frames[1], 90.0) >= 3


def test_deleted_rows_by_tasks_that_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(changes, "JOIN_ROWS", 50)
    before = spark.createDataFrame([(i if i % 90 else None, f"v{i}") for i in range(1, 900)], "k int, v string")
    gone = spark.createDataFrame([(i % 300,) for i in range(900)] + [(None,)], "k int")
    after = changes.delete_keys(before, gone, ["k"])
    kept = sorted(v for k, v in rows(before) if k is None or k >= 300)
    assert sorted(v for _, v in rows(after)) == kept
    assert after.rdd.getNumPartitions() == 36  # ceil((899 + 901) / 50), not merged by bytes
    back = changes.recover_deleted(before, after, ["k"])
    assert sorted(v for _, v in rows(back)) == sorted([v for _, v in rows(before)] + [v for k, v in rows(before) if k is None])


def test_quantile_normalisation(spark):
    rng = np.random.default_rng(2)
    m = rng.integers(0, 6, (40, 5)).astype(float)
    df = spark.createDataFrame([(int(s), int(f), float(m[f, s])) for f in range(40) for s in range(5)],
                               "sample int, feature int, v double")
    means = np.sort(m, axis=0).mean(axis=1)
    for r in normalise.quantile_normalised(df, "sample", "v").collect():
        assert r["normalised"] == pytest.approx(means[int((m[:, r["sample"]] < r["v"]).sum())])


def test_quantile_normalisation_of_unequal_samples(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("a", 9.0), ("b", 3.0), ("b", None), (None, 8.0)], "s string, v double")
    got = {(r["s"], r["v"]): r["normalised"] for r in normalise.quantile_normalised(df, "s", "v").collect()}
    assert got == {("a", 1.0): 4.0, ("a", 4.0): 4.0, ("a", 9.0): 9.0, ("b", 3.0): 4.0, ("b", None): None, (None, 8.0): 4.0}


def random_graph(seed, n=40, m=160):
    rng = random.Random(seed)
    edges = {(rng.randrange(n), rng.randrange(n)) for _ in range(m)}
    edges |= {(0, i) for i in range(1, n)}
    return sorted((a, b) for a, b in edges if a != b)


def test_graph_motifs_and_clustering(spark):
    edges = random_graph(1)
    have = set(edges)
    df = spark.createDataFrame([(a, b, 1) for a, b in edges], "src int, dst int, weight bigint")
    ffl = sum(1 for a, b in edges for b2, c in edges if b2 == b and c != a and (a, c) in have)
    assert graph.feedforward_loops(df).first()[0] == ffl
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for r in graph.clustering(df).collect():
        v = near[r["id"]]
        links = sum(1 for x, y in combinations(sorted(v), 2) if y in near[x])
        assert r["clustering"] == pytest.approx(2 * links / (len(v) * (len(v) - 1)) if len(v) > 1 else 0)


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(0, 200)] + [(1000, 1001), (1002, 1001)] + [(2000, 2001)]
    random.Random(1).shuffle(chain)
    df = spark.createDataFrame([(b, a, 1) for a, b in chain], "src int, dst int, weight bigint")
    got = dict(rows(graph.components(df)))
    assert {got[i] for i in range(201)} == {0} and got[1002] == 1000 and got[2001] == 2000
    assert tuple(graph.largest_component(graph.components(df)).first()) == (0, 201)


def test_pagerank_with_dangling_nodes(spark):
    edges = [(0, 1, 2), (0, 2, 1), (1, 2, 1), (3, 2, 1)]
    n, rank = 4, np.full(4, 0.25)
    p = np.zeros((4, 4))
    for a, b, w in edges:
        p[a, b] = w
    out = p.sum(axis=1)
    for _ in range(15):
        flow = sum(rank[i] * p[i] / out[i] for i in range(4) if out[i])
        rank = 0.15 / n + 0.85 * (flow + rank[out == 0].sum() / n)
    got = dict(rows(graph.pagerank(spark.createDataFrame(edges, "src int, dst int, weight bigint"), tolerance=1e-9)))
    assert [got[i] for i in range(4)] == pytest.approx(list(rank))


def test_layers_take_the_greatest_source_distance(spark):
    edges = spark.createDataFrame([(0, 1, 1), (1, 2, 1), (5, 2, 1), (2, 3, 1)], "src int, dst int, weight bigint")
    assert dict(rows(graph.layers(edges))) == {0: 0, 1: 1, 2: 2, 3: 3, 5: 0}
    ring = spark.createDataFrame([(0, 1, 1), (1, 0, 1), (1, 2, 1), (2, 1, 1)], "src int, dst int, weight bigint")
    assert dict(rows(graph.layers(ring))) == {0: 1, 1: 0, 2: 1}


def test_a_deep_chain_has_layers(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(70)], "src int, dst int")
    assert dict(rows(graph.layers(chain))) == {i: i for i in range(71)}

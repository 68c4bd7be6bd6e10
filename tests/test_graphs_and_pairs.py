"""Graph rounds, pairs by cells and permutation tests against plain versions."""

import itertools
import random
from collections import Counter, deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from strandlake.functions import sequence as seq_functions
from strandlake.operators import aggregates, diversity, graph, joins, sequences
from strandlake.operators.performance import plan_text


def edges_of(seed, n, m):
    r = random.Random(seed)
    return sorted({(r.randrange(n), r.randrange(n)) for _ in range(m)} | {(0, i) for i in range(1, n, 3)})


def frame(spark, edges):
    return spark.createDataFrame([(a, b, 1 + (a + b) % 3) for a, b in edges], "src int, dst int, weight int")


def test_ranks_equal_power_iteration(spark):
    n, edges = 60, edges_of(1, 60, 150)
    edges = [e for e in edges if e[0] % 7]  # nodes without out-edges
    nodes = spark.range(n).select(F.col("id").cast("int"))
    got = dict(rows(graph.pagerank(frame(spark, edges), nodes, tolerance=1e-12).select("id", "rank")))
    p = np.zeros((n, n))
    for a, b in edges:
        p[a, b] = 1 + (a + b) % 3
    out = p.sum(axis=1)
    rank = np.full(n, 1 / n)
    for _ in range(300):
        spread = rank[out == 0].sum() / n
        rank = 0.15 / n + 0.85 * ((rank / np.where(out > 0, out, 1)) @ p + spread)
    assert max(abs(got[i] - rank[i]) for i in range(n)) < 1e-9 and sum(got.values()) == pytest.approx(1)
    with pytest.raises(RuntimeError):
        graph.pagerank(frame(spark, edges), nodes, tolerance=1e-15, max_rounds=4)
    assert graph.pagerank(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed, sources", [(2, 150), (3, 1)])
def test_layers_from_many_sources(spark, seed, sources):
    """More sources than bits in a word, and none at all."""
    r = random.Random(seed)
    core = [(a, b) for a, b in ((r.randrange(40), r.randrange(40)) for _ in range(70)) if a != b]
    if sources > 1:
        core += [(1000 + i, r.randrange(40)) for i in range(sources)]
    else:
        core += [(b, a) for a, b in core] + [(i, (i + 1) % 40) for i in range(40)]
    ids = sorted({x for e in core for x in e} | {9999})
    near = {i: [b for a, b in core if a == i] for i in ids}
    inn, out = Counter(b for _, b in set(core)), Counter(a for a, _ in set(core))
    starts = [i for i in ids if not inn[i]]
    if sources == 1:
        ids.remove(9999)
        starts = [min(ids, key=lambda i: (-out[i], i))]
    want = dict.fromkeys(ids, 0)
    for s in starts:
        depth, queue = {s: 0}, deque([s])
        while queue:
            x = queue.popleft()
            for y in near[x]:
                if y not in depth:
                    depth[y] = depth[x] + 1
                    queue.append(y)
        for i, d in depth.items():
            want[i] = max(want[i], d)
    nodes = spark.createDataFrame([(i,) for i in ids], "id int")
    assert dict(rows(graph.layers(frame(spark, core), nodes).select("id", "layer"))) == want


def test_triangles_of_a_hub(spark):
    edges = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(1, 59, 2)] + edges_of(4, 30, 60)
    plain = {(a, b) for a, b in edges if a != b}
    want = sum((a, b) in plain and (b, c) in plain and (a, c) in plain for a, b, c in itertools.permutations(range(60), 3))
    assert graph.feedforward_loops(frame(spark, sorted(plain))).first()[0] == want


def test_every_pair_meets_once(spark):
    df = spark.range(130).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for blocks in (1, 2, 7, None):
        got = rows(joins.unordered_pairs(df, "k", blocks).select("k_a", "k_b", "v_a", "v_b"))
        assert sorted(got) == [(a, b, 2 * a, 2 * b) for a, b in itertools.combinations(range(130), 2)]
    assert joins.unordered_pairs(df.limit(0), "k").count() == 0


def brute_pairs(data, k):
    groups = {}
    for g, i in data:
        if g is not None and i is not None:
            groups.setdefault(g, set()).add(i)
    n = Counter(p for s in groups.values() for p in itertools.combinations(sorted(s), 2))
    return sorted(((a, b, c) for (a, b), c in n.items()), key=lambda x: (-x[2], x[0], x[1]))[:k]


def test_pairs_of_large_and_small_groups(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "PAIR_ITEMS", 16)
    r = random.Random(5)
    data = [(r.randrange(300), r.randrange(40)) for _ in range(2500)] + [(1000 + j, i) for j in range(3) for i in range(90)] + [(None, 3), (7, None)]
    df = spark.createDataFrame(data, "g int, i int")
    got = rows(aggregates.top_pairs(df, "g", "i", 15, small_group=12))
    assert got == brute_pairs(data, 15)


def test_a_huge_group_of_one_off_items(spark):
    huge = spark.range(100_000).select(F.lit(-1).cast("bigint").alias("g"), (F.col("id") + 1000).alias("i"))
    data = [(g, i) for g in range(50) for i in (g % 3, 3 + g % 4)]
    small = spark.createDataFrame(data, "g bigint, i bigint")
    assert rows(aggregates.top_pairs(huge.unionByName(small), "g", "i", 5)) == brute_pairs(data, 5)


def test_permutations_in_one_pass(spark, monkeypatch):
    monkeypatch.setattr(diversity, "LABELLINGS", 7)
    r = np.random.default_rng(6)
    n, group = 18, [i % 3 for i in range(18)]
    x = r.normal(size=(n, 2)) + np.array(group)[:, None] * 0.8
    d = {(a, b): float(np.linalg.norm(x[a] - x[b])) for a, b in itertools.combinations(range(n), 2)}
    pairs = spark.createDataFrame([(a, b, v) for (a, b), v in d.items()], "a int, b int, distance double")
    labels = spark.createDataFrame(list(enumerate(group)), "sample int, grp int")
    drawn = dict(rows(diversity._label_arrays(labels, 40, 9).select("sample", "drawn")))

    def pseudo_f(g):
        sst = sum(v * v for v in d.values()) / n
        ssw = sum(sum(v * v for (a, b), v in d.items() if g[a] == g[b] == k) / g.count(k) for k in set(g))
        return ((sst - ssw) / 2) / (ssw / (n - 3))

    labellings = [[drawn[s][p] for s in range(n)] for p in range(41)]
    assert labellings[0] == group and all(sorted(g) == sorted(group) for g in labellings)
    assert len({tuple(g) for g in labellings}) > 30
    f = [pseudo_f(g) for g in labellings]
    got = diversity.permanova(pairs, labels, 40, 9).first()
    assert got["pseudo_f"] == pytest.approx(f[0]) and got["p_value"] == pytest.approx((sum(v >= f[0] for v in f[1:]) + 1) / 41)


@pytest.mark.parametrize("letters, length", [("ACGT", 18), ("AC\u00e9\U0001f600", 9), ("ab~", 500), ("A", 0)])
def test_identity_of_pairs_packed_and_by_letters(spark, letters, length):
    r = random.Random(length)
    texts = {i: "".join(r.choice(letters) for _ in range(length)) for i in range(12)}
    df = spark.createDataFrame(list(texts.items()), "k int, s string")
    want = [(i, j, sum(x != y for x, y in zip(texts[i], texts[j]))) for i in texts for j in texts if i < j]
    got = sequences.pairwise_identity(df, "k", "s")
    assert rows(got.select("a", "b", "distance"), "a", "b") == want
    if length == 18:  # cells, not input files, decide how many tasks make the pairs
        assert got.rdd.getNumPartitions() > 4 and "BroadcastHashJoin" not in plan_text(got) and "zip_with" not in plan_text(got)


def test_identity_refuses_other_lengths(spark):
    with pytest.raises(Exception, match="differ in length"):
        sequences.pairwise_identity(spark.createDataFrame([(1, "ACG"), (2, "AC")], "k int, s string"), "k", "s").collect()


def test_rows_of_pairs_are_repeated_for_few_blocks():
    assert [joins.pair_blocks(n) for n in (0, 5000, 20_000, 60_000)] == [6, 6, 20, 32]
    # Six times the rows: the blocks stay, so repeated rows grow as the rows do; blocks beyond that stay bounded.
    assert joins.pair_blocks(360_000) == 32 and joins.pair_blocks(10_000_000) * joins.MOST_PAIR_ROWS >= 10_000_000


def test_packed_word_of_seven_letters(spark):
    df = spark.createDataFrame([("ab~ xyzGA",), ("",), (None,)], "s string")
    got = df.select(*[seq_functions.packed_word(F.col("s"), i).alias(f"w{i}") for i in range(3)]).collect()
    assert tuple(got[0]) == (int.from_bytes(b"ab~ xyz"), int.from_bytes(b"GA"), None)
    assert tuple(got[1]) == tuple(got[2]) == (None, None, None)

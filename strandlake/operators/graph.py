"""Graph jobs over ``edges(src, dst, weight)``: joins and partial aggregates, checkpointed per round."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions.numeric import ratio
from strandlake.operators.windows import numbered
from strandlake.session import checkpointed


def build_edges(pairs: DataFrame) -> DataFrame:
    """GRF-01: repeated (src, dst) pairs become one edge whose weight counts them."""
    return pairs.groupBy("src", "dst").agg(F.count("*").alias("weight"))


def nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def degrees(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """GRF-02: in and out degree per node, from one grouping over edge ends."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))))
    out = ends.groupBy("id").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))
    if nodes is None:
        return out
    return nodes.join(out, "id", "left").select("id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("out_degree", "in_degree")])


def graph_summary(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """GRF-02: nodes, edges, density, mean and greatest degrees with their hubs (smallest id on a tie)."""
    d = degrees(edges, nodes)

    def hub(c):
        return F.min_by("id", F.struct((-F.col(c)).alias("a"), F.col("id").alias("b")))

    out = d.agg(F.count("*").alias("nodes"), F.sum("out_degree").alias("edges"), F.max("in_degree").alias("max_in"),
                F.max("out_degree").alias("max_out"), hub("in_degree").alias("hub_in"), hub("out_degree").alias("hub_out"))
    n, m = F.col("nodes"), F.col("edges")
    return out.withColumns({"density": ratio(m, n * (n - 1)), "avg_degree": ratio(m, n)})


def transitions(edges: DataFrame) -> DataFrame:
    """GRF-04: row-normalised weights (src, dst, p)."""
    totals = edges.groupBy("src").agg(F.sum("weight").alias("_w"))
    return edges.join(totals, "src").select("src", "dst", ratio(F.col("weight"), F.col("_w")).alias("p"))


def pagerank(edges: DataFrame, nodes: DataFrame | None = None, alpha: float = 0.85, tolerance: float = 1e-6,
             max_rounds: int = 100, rounds_a_checkpoint: int = 4) -> DataFrame:
    """GRF-03: weighted PageRank; the rank of nodes without out-edges is spread over all nodes.

    Rounds go on until the ranks change by less than ``tolerance`` per node in all; an error after ``max_rounds``.

    Rank that is spread evenly over all nodes only scales the ranks, so rounds go without it and the ranks are divided by
    their sum at the end. A round is then one join and one partial aggregate, with no number that the driver has to know
    first; a few rounds go into one checkpoint, which reports the change of its last round and the sum as it is written.
    Where ranks are too large to broadcast, the shuffled join splits the edges of a hub over tasks at run time.
    """
    steps = checkpointed(transitions(edges))
    ids = checkpointed((nodes if nodes is not None else nodes_of(edges)).select("id"))
    n = ids.count()
    if not n:
        return ids.withColumn("rank", F.lit(0.0))
    base = ids.withColumn("_in", F.lit(0.0))  # every node has a rank, also without in-edges
    ranks = ids.withColumn("rank", F.lit(1.0 / n))
    for done in range(rounds_a_checkpoint, max_rounds + rounds_a_checkpoint, rounds_a_checkpoint):
        for _ in range(rounds_a_checkpoint):
            last = ranks
            flow = last.join(steps, last["id"] == steps["src"]).select(F.col("dst").alias("id"), (F.col("rank") * F.col("p")).alias("_in"))
            ranks = flow.unionByName(base).groupBy("id").agg((F.lit((1.0 - alpha) / n) + F.lit(alpha) * F.sum("_in")).alias("rank"))
        # the change of a round shrinks by alpha at least, so the one before the last bounds the last
        both = checkpointed(ranks.join(last.withColumnRenamed("rank", "_old"), "id"))
        change, total = both.agg(F.sum(F.abs(F.col("rank") - F.col("_old"))), F.sum("rank")).first()
        ranks = both.select("id", "rank")
        if change / total < n * tolerance:
            return ranks.withColumn("rank", F.col("rank") / F.lit(total))
    raise RuntimeError("ranks did not settle; raise max_rounds")


def random_walk(edges: DataFrame, start: DataFrame, steps: int = 5) -> DataFrame:
    """GRF-04: distribution after T steps from each start node: (start, id, probability).

    ``start(id)`` lists the start nodes; with all nodes the result is the influence table.
    """
    moves = checkpointed(transitions(edges))
    walk = start.select(F.col("id").alias("start"), "id", F.lit(1.0).alias("probability"))
    for _ in range(steps):
        walk = checkpointed(
            walk.join(moves, walk["id"] == moves["src"]).groupBy("start", F.col("dst").alias("id"))
            .agg(F.sum(F.col("probability") * F.col("p")).alias("probability")))
    return walk


def reciprocity(edges: DataFrame) -> DataFrame:
    """GRF-06: mutual pairs, edges of mutual pairs and one-way edges, from one grouping over unordered pairs."""
    pairs = (edges.filter(F.col("src") != F.col("dst")).select("src", "dst").distinct()
             .groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
             .agg(F.count("*").alias("_n")))
    mutual = F.count_if(F.col("_n") == 2)
    return pairs.agg(mutual.alias("mutual_pairs"), (mutual * 2).alias("reciprocal_edges"),
                     F.count_if(F.col("_n") == 1).alias("one_way_edges"))


def hub_counts(edges: DataFrame, least: int = 2) -> DataFrame:
    """GRF-05: nodes with at least ``least`` out-edges (divergence) and in-edges (convergence)."""
    return degrees(edges).agg(F.count_if(F.col("out_degree") >= least).alias("divergence"),
                              F.count_if(F.col("in_degree") >= least).alias("convergence"))


def triangles(edges: DataFrame) -> DataFrame:
    """Triangles of the undirected graph, each once: nodes u, v, w and the directions of its three sides.

    Sides are oriented from the node of lower degree to the one of higher degree. The out-degree is then
    at most the root of twice the edge count even for a hub, which bounds the paths that are built.
    """
    plain = edges.filter(F.col("src") != F.col("dst")).select("src", "dst").distinct()
    sides = plain.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(
        F.max((F.col("src") < F.col("dst")).cast("int")).alias("ab"),
        F.max((F.col("src") > F.col("dst")).cast("int")).alias("ba"))
    degree = sides.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("d"))
    ranked = (sides.join(degree.select(F.col("id").alias("a"), F.col("d").alias("da")), "a")
              .join(degree.select(F.col("id").alias("b"), F.col("d").alias("db")), "b"))
    up = F.struct("da", "a") < F.struct("db", "b")
    oriented = checkpointed(ranked.select(
        F.when(up, F.col("a")).otherwise(F.col("b")).alias("u"), F.when(up, F.col("b")).otherwise(F.col("a")).alias("v"),
        F.when(up, F.col("ab")).otherwise(F.col("ba")).alias("f"), F.when(up, F.col("ba")).otherwise(F.col("ab")).alias("r"),
        F.greatest("da", "db").alias("dv")))

    # Every triangle has one node u with two sides that go up from it. Pairs of those are made at u, which has few such
    # sides also as a hub, and closed by the third side, an equi-join on both of its ends.
    def side(y, n, d):
        return oriented.select("u", F.col("v").alias(y), F.col("f").alias(f"f{n}"), F.col("r").alias(f"r{n}"), F.col("dv").alias(d))

    pairs = side("v", 1, "d1").join(side("w", 3, "d3"), "u").filter(F.struct("d1", "v") < F.struct("d3", "w"))
    third = oriented.select(F.col("u").alias("v"), F.col("v").alias("w"), F.col("f").alias("f2"), F.col("r").alias("r2"))
    return pairs.join(third, ["v", "w"]).select("u", "v", "w", *[f"{x}{n}" for n in (1, 2, 3) for x in "fr"])


def feedforward_loops(edges: DataFrame) -> DataFrame:
    """GRF-05: number of ordered triples A to B, B to C, A to C."""
    uv, vu, vw, wv, uw, wu = (F.col(c) for c in ("f1", "r1", "f2", "r2", "f3", "r3"))
    count = (uv * vw * uw + uw * wv * uv + vu * uw * vw + vw * wu * vu + wu * uv * wv + wv * vu * wu)
    return triangles(edges).agg(F.coalesce(F.sum(count), F.lit(0)).alias("feedforward_loops"))


def clustering(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """GRF-08: clustering coefficient per node, undirected and directed form; 0 below two neighbours."""
    found = triangles(edges)
    product = (F.col("f1") + F.col("r1")) * (F.col("f2") + F.col("r2")) * (F.col("f3") + F.col("r3"))
    per_node = (found.select(product.alias("s"), F.explode(F.array("u", "v", "w")).alias("id"))
                .groupBy("id").agg(F.count("*").alias("t"), F.sum("s").alias("dt")))
    plain = edges.filter(F.col("src") != F.col("dst")).select("src", "dst").distinct()
    pairs = plain.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.count("*").alias("s"))
    size = (pairs.select("s", F.explode(F.array("a", "b")).alias("id")).groupBy("id")
            .agg(F.count("*").alias("k"), F.sum("s").alias("total"), F.count_if(F.col("s") == 2).alias("both")))
    ids = nodes if nodes is not None else nodes_of(edges)
    k, total = F.col("k"), F.col("total")
    zero = F.lit(0.0)
    return ids.join(size, "id", "left").join(per_node, "id", "left").select(
        "id", F.coalesce(ratio(F.col("t") * 2, k * (k - 1)), zero).alias("clustering"),
        F.coalesce(ratio(F.col("dt"), total * (total - 1) - F.col("both") * 2), zero).alias("directed_clustering"))


def components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """GRF-07: (id, component), the component named by its smallest node.

    Alternating large-star and small-star steps: every node links its neighbours to the least node it
    knows. Each step is a min per node (a partial aggregate) and a join, and the number of rounds grows
    with the logarithm of the size, not with the diameter.
    """
    links = checkpointed(edges.filter(F.col("src") != F.col("dst")).select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    before = None
    while True:  # every round but the last lowers some label, so this ends
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))))
        links = checkpointed(small.filter(F.col("u") != F.col("v")).distinct())
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    ids = nodes if nodes is not None else nodes_of(edges)
    return ids.join(links.select(F.col("u").alias("id"), "v"), "id", "left").select(
        "id", F.coalesce("v", "id").alias("component"))


def largest_component(labels: DataFrame) -> DataFrame:
    """GRF-07: label and size of the largest component."""
    return (labels.groupBy("component").agg(F.count("*").alias("size"))
            .orderBy(F.desc("size"), "component").limit(1))


def layers(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """GRF-09: per node the greatest, over source nodes, of its distance from the source; 0 when unreached.

    Sources have no in-edges; without any, the node of most out-edges (smallest id on a tie) is the source. All sources
    are searched at once: they are numbered, and a node's state is one word of bits for each 64 sources that reach it, so
    a step of up to 64 searches is one row and a bitwise or. A node's layer is the last step that brought it a new source.
    """
    plain = checkpointed(edges.filter(F.col("src") != F.col("dst")).select("src", "dst").distinct())
    ids = nodes if nodes is not None else nodes_of(edges)
    d = degrees(plain, ids)
    sources = d.filter(F.col("in_degree") == 0).select("id")
    if sources.isEmpty():
        sources = d.orderBy(F.desc("out_degree"), "id").limit(1).select("id")
    place = F.col("_no") - 1
    frontier = checkpointed(numbered(sources, ["id"], "_no").select(
        "id", F.floor(place / 64).alias("word"), F.expr("shiftleft(1L, cast((_no - 1) % 64 as int))").alias("bits")))
    reached = frontier
    found = frontier.select("id", F.lit(0).alias("depth"))
    for depth in itertools.count(1):  # ends when nothing new is reached
        step = (frontier.join(plain, frontier["id"] == plain["src"]).groupBy(F.col("dst").alias("id"), "word")
                .agg(F.bit_or("bits").alias("bits"))
                .join(reached.withColumnRenamed("bits", "_seen"), ["id", "word"], "left")
                .select("id", "word", F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("_seen", F.lit(0).cast("bigint")))).alias("bits"))
                .filter("bits <> 0"))
        frontier = checkpointed(step)
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier.select("id", F.lit(depth).alias("depth")))
        reached = checkpointed(reached.unionByName(frontier).groupBy("id", "word").agg(F.bit_or("bits").alias("bits")))
    best = found.groupBy("id").agg(F.max("depth").alias("layer"))
    return ids.join(best, "id", "left").select("id", F.coalesce("layer", F.lit(0)).alias("layer"))


def match_nodes(found: DataFrame, truth: DataFrame, limit: float) -> DataFrame:
    """GRF-10: each detected node claims its nearest true node; the nearest claimant below the limit gets it.

    Both tables hold (id, x, y). Candidates come from grid cells as wide as the limit.
    """
    def cell(c):
        return F.floor(F.col(c) / F.lit(float(limit)))

    around = F.sequence(F.lit(-1), F.lit(1))
    spread = (found.select(F.col("id").alias("f"), F.col("x").alias("fx"), F.col("y").alias("fy"), cell("x").alias("px"),
                           cell("y").alias("py"), F.explode(around).alias("dx")).select("*", F.explode(around).alias("dy"))
              .select("f", "fx", "fy", (F.col("px") + F.col("dx")).alias("cx"), (F.col("py") + F.col("dy")).alias("cy")))
    sites = truth.select(F.col("id").alias("t"), "x", "y", cell("x").alias("cx"), cell("y").alias("cy"))
    distance = F.sqrt(F.pow(F.col("fx") - F.col("x"), 2) + F.pow(F.col("fy") - F.col("y"), 2))
    nearest = (spread.join(sites, ["cx", "cy"]).select("f", "t", distance.alias("d")).filter(F.col("d") < limit)
               .groupBy("f").agg(F.min(F.struct("d", "t")).alias("b")).select("f", F.col("b.t").alias("t"), F.col("b.d").alias("d")))
    return nearest.groupBy("t").agg(F.min(F.struct("d", "f")).alias("b")).select(
        F.col("b.f").alias("found_id"), F.col("t").alias("true_id"))


def edge_scores(found: DataFrame, truth: DataFrame, matches: DataFrame) -> DataFrame:
    """GRF-10: precision, recall and F1 of detected edges in the space of true nodes."""
    a = matches.select(F.col("found_id").alias("src"), F.col("true_id").alias("s"))
    b = matches.select(F.col("found_id").alias("dst"), F.col("true_id").alias("t"))
    mapped = (found.select("src", "dst").join(a, "src").join(b, "dst")
              .select(F.col("s").alias("src"), F.col("t").alias("dst")).distinct())
    marked = (mapped.select("src", "dst", F.lit(1).alias("f"), F.lit(0).alias("g"))
              .unionByName(truth.select("src", "dst").distinct().select("src", "dst", F.lit(0).alias("f"), F.lit(1).alias("g")))
              .groupBy("src", "dst").agg(F.max("f").alias("f"), F.max("g").alias("g")))
    tp, fp, fn = (F.count_if((F.col("f") == x) & (F.col("g") == y)) for x, y in ((1, 1), (1, 0), (0, 1)))
    zero = F.lit(0.0)
    out = marked.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return out.withColumns({"precision": F.coalesce(ratio(tp, tp + fp), zero), "recall": F.coalesce(ratio(tp, tp + fn), zero),
                            "f1": F.coalesce(ratio(tp * 2, tp * 2 + fp + fn), zero)})


def threshold_sweep(assigned: DataFrame, thresholds: list[float]) -> DataFrame:
    """GRF-11: distinct edges whose distance is below each threshold.

    Each edge is reduced to its least distance first; the thresholds are counted in one aggregation.
    """
    best = assigned.groupBy("source", "target").agg(F.min("distance").alias("d"))
    cells = F.array(*[F.struct(F.lit(float(x)).alias("threshold"), F.count_if(F.col("d") < x).alias("edges")) for x in thresholds])
    return best.agg(cells.alias("_c")).select(F.inline("_c"))


def modularity(edges: DataFrame, partition: DataFrame) -> DataFrame:
    """GRF-12: modularity of a given partition ``(id, community)`` of the undirected weighted graph."""
    a = partition.select(F.col("id").alias("src"), F.col("community").alias("ca"))
    b = partition.select(F.col("id").alias("dst"), F.col("community").alias("cb"))
    sides = edges.join(a, "src").join(b, "dst")
    ends = sides.select(F.inline(F.array(
        F.struct(F.col("ca").alias("c"), F.col("weight").alias("d"), F.when(F.col("ca") == F.col("cb"), F.col("weight")).otherwise(0).alias("i")),
        F.struct(F.col("cb").alias("c"), F.col("weight").alias("d"), F.lit(0).cast("bigint").alias("i")))))
    per = ends.groupBy("c").agg(F.sum("d").alias("d"), F.sum("i").alias("i"))
    total = edges.select(F.sum("weight").cast("double")).scalar()
    return per.agg(F.sum(F.col("i") / total - F.pow(F.col("d") / (total * 2), 2)).alias("modularity"))

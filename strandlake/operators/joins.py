"""Join operators.

No side is broadcast by a hint unless it has a fixed size (a one-row aggregate or a written
tier table): Spark broadcasts any other side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``, and splits hot keys of a shuffled join at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.functions.numeric import decay
from strandlake.session import checkpointed


def join_with_counts(left: DataFrame, right: DataFrame, key: str, how: str, counts: dict[str, Column]) -> DataFrame:
    """AGG-36, JOIN-12: reduce the right side to one row per key, then join; no fan-out."""
    return left.join(right.groupBy(key).agg(*[c.alias(n) for n, c in counts.items()]), key, how)


#: Rows on one side of a cell of pairs, and cells made at least, so that a small set is spread too.
PAIR_ROWS, LEAST_BLOCKS = 1024, 6
#: A row is repeated for each block, which costs disk: beyond so many blocks they get more rows first, up to so many.
MOST_BLOCKS, MOST_PAIR_ROWS = 32, 16384
#: Tasks that cells are dealt to at most.
PAIR_TASKS = 2048


def pair_blocks(n: int) -> int:
    """Blocks that ``n`` rows are dealt to."""
    return max(LEAST_BLOCKS, min(MOST_BLOCKS, -(-n // PAIR_ROWS)), -(-n // MOST_PAIR_ROWS))


def unordered_pairs(df: DataFrame, key: str, blocks: int | None = None) -> DataFrame:
    """Every pair of rows with ``a < b`` by key, columns suffixed ``_a`` and ``_b``; for sets whose pairs are the result.

    Rows are dealt to blocks whose number follows their count, and a pair of blocks is one cell: both sides of a cell are
    bounded, and the cells, not the rows, grow with the square as the result does. Pairs are made by an equi-join on cells.
    """
    blocks = blocks or pair_blocks(df.count())
    own = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    cells = df.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")

    def side(end: Column, suffix: str) -> DataFrame:
        # One number holds the cell and whether a row of the side comes from the cell's first block.
        at = ((low.cast("bigint") * blocks + high) * 2 + (F.col("_own") == end).cast("int")).alias("_at")
        return cells.select(*[F.col(c).alias(f"{c}{suffix}") for c in df.columns], at).repartition(tasks, "_at")

    # A few rows make many pairs: tasks follow the cells, whatever the size of the rows, and no side is broadcast.
    tasks = min(blocks * (blocks + 1) // 2, PAIR_TASKS)
    return side(low, "_a").join(side(high, "_b").hint("shuffle_hash"), "_at").filter(F.col(f"{key}_a") < F.col(f"{key}_b")).drop("_at")


def report_grid(facts: DataFrame, a: str, b: str, dims_a: DataFrame, dims_b: DataFrame) -> DataFrame:
    """JOIN-05: every combination of two dimension values with its count, 0 where none.

    The grid is the result itself; both dimensions are reduced to distinct values first.
    """
    grid = dims_a.select(a).distinct().crossJoin(dims_b.select(b).distinct())
    counts = facts.groupBy(a, b).agg(F.count("*").alias("n"))
    return grid.join(counts, [a, b], "left").select(a, b, F.coalesce("n", F.lit(0)).alias("n"))


def tiers(spark: SparkSession, rows: list[tuple[str, float, float]]) -> DataFrame:
    """SRC-16: a written (tier, lo, hi) table."""
    return spark.createDataFrame(rows, "tier string, lo double, hi double")


def tier_lookup(df: DataFrame, value: str, table: DataFrame) -> DataFrame:
    """JOIN-09: ``lo <= x < hi`` against a written tier table, which has a fixed size and is broadcast."""
    v = F.col(value)
    return df.join(F.broadcast(table), (v >= F.col("lo")) & (v < F.col("hi"))).drop("lo", "hi")


def with_group_mean(df: DataFrame, key: str, value: Column, mean: Column) -> DataFrame:
    """JOIN-12: each row with its group's mean and its distance from it."""
    means = df.groupBy(key).agg(mean.alias("group_mean"))
    return df.join(means, key).withColumn("delta", value - F.col("group_mean"))


def prefix_join(left: DataFrame, barcode: str, right: DataFrame, prefix: str, length: int) -> DataFrame:
    """JOIN-16: ``barcode LIKE prefix || '%'`` for prefixes of one length, as an equi-join."""
    keyed = left.withColumn("_prefix", F.substring(barcode, 1, length))
    checked = right.filter(F.length(prefix) == length)
    return keyed.join(checked, F.col("_prefix") == F.col(prefix)).drop("_prefix")


def prefix_join_any(left: DataFrame, barcode: str, right: DataFrame, prefix: str) -> DataFrame:
    """JOIN-16 for prefixes of several lengths: one equi-join key per length that occurs.

    Only the distinct lengths reach the driver; they are bounded by the longest prefix.
    """
    lengths = [r[0] for r in right.select(F.length(prefix).alias("n")).distinct().collect() if r[0]]
    keyed = left.withColumn("_prefix", F.explode(F.array_distinct(F.array(
        *[F.substring(F.col(barcode), 1, n) for n in sorted(lengths)]))))
    return keyed.join(right, F.col("_prefix") == F.col(prefix)).drop("_prefix")


def paired_reads(first: DataFrame, second: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """JOIN-19: mates by read id without ``/1`` or ``/2``; ``how='full'`` keeps reads without a mate."""
    def side(df, n):
        return df.select(F.regexp_replace("read_id", "/[12]$", "").alias("pair_id"),
                         *[F.col(c).alias(f"{c}{n}") for c in columns])

    return side(first, 1).join(side(second, 2), "pair_id", how)


def mate_mismatches(first: DataFrame, second: DataFrame) -> DataFrame:
    """JOIN-19: reads whose mate is missing."""
    both = paired_reads(first, second, ["read_id"], "full")
    return both.filter(F.col("read_id1").isNull() | F.col("read_id2").isNull())


def check_mates(first: DataFrame, second: DataFrame) -> None:
    """JOIN-19: raise when any read has no mate."""
    bad = mate_mismatches(first, second).limit(1).collect()
    if bad:
        raise ValueError(f"read without mate: {bad[0]['pair_id']}")


#: Candidate sites of a point in one cell that a first grid may have on average, and halvings of a grid looked at for it.
CROWD, HALVINGS = 4, 20


def two_nearest(points: DataFrame, sites: DataFrame, max_distance: float) -> DataFrame:
    """JOIN-20: nearest site is the target, second nearest the source, kept if the nearest is near enough.

    ``points(point_id, x, y)``, ``sites(site_id, x, y)``. Candidates come from a pyramid of grids: the nine cells around a
    point hold every site within one cell's width of it. The first grid is so fine that its cells hold few sites where
    sites are; a point is done where its second nearest is within a cell's width, or where the cells are ``max_distance``
    wide and hold no nearest. Any other asks the nine cells of the next, twice coarser grid, so a distant point asks nine
    cells a level, however far it is.
    """
    span = sites.agg(F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("s")).first()["s"] or 0.0
    size = float(max_distance) / 2 ** _first_grid(sites, float(max_distance))
    # Of the sites of one place only the first two can be a result; a point without id has none.
    order = Window.partitionBy("x", "y").orderBy(F.asc_nulls_first("site_id"))
    sites = checkpointed(sites.select("site_id", "x", "y").distinct().withColumn("_rn", F.row_number().over(order)).filter("_rn <= 2").drop("_rn"))
    out, todo = None, points.filter(F.col("point_id").isNotNull())
    while True:
        # Kept in a checkpoint: the round decides both what is done and what is searched again.
        near = checkpointed(_nearest_in_cells(todo, sites, size))
        last = size > span + max_distance  # the nine cells hold all sites
        beyond = (F.col("d1") >= max_distance) if size >= max_distance else F.lit(False)
        sure = F.coalesce(beyond | (F.col("d2") <= size), F.lit(False)) if not last else F.lit(True)
        done = near.filter(sure)
        out = done if out is None else out.unionByName(done)
        if last:
            break
        if size >= max_distance:  # a point whose nine cells are empty has no site near enough
            todo = todo.join(near.filter(~sure).select("point_id"), "point_id", "left_semi")
        else:
            todo = todo.join(done.select("point_id"), "point_id", "left_anti")
        todo, size = checkpointed(todo), size * 2
        if todo.isEmpty():
            break
    kept = out.filter((F.col("d1") < max_distance) & F.col("source").isNotNull())
    return kept.select("point_id", "source", "target", F.col("d1").alias("distance"))


def _cell(column, size):
    return F.floor(F.col(column) / size)


def _first_grid(sites, size):
    """How often ``size`` is halved until the cell of a site holds few sites on average; a place counts once."""
    at = F.struct(*[F.floor(F.col(c) / (F.lit(size) / F.pow(F.lit(2.0), F.col("half")))).alias(c) for c in ("x", "y")])
    places = sites.filter("x is not null and y is not null").select("x", "y").distinct()
    counts = (places.withColumn("half", F.explode(F.sequence(F.lit(0), F.lit(HALVINGS)))).groupBy("half", at.alias("cell"))
              .agg(F.count("*").cast("double").alias("n")))
    crowds = {r["half"]: r["c"] for r in counts.groupBy("half").agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("c")).collect()}
    return next((h for h in sorted(crowds) if crowds[h] <= CROWD), HALVINGS if crowds else 0)


def _nearest_in_cells(points, sites, size):
    """The two nearest sites of each point among those in the nine cells around it.

    Sites, not points, are repeated for the cells around them, so a point meets all its candidates in one place: they are
    reduced to the two smallest there, by one pass for each, and no list or table of candidates is kept or moved.
    """
    around = F.sequence(F.lit(-1), F.lit(1))
    cells = (sites.select("site_id", F.col("x").alias("sx"), F.col("y").alias("sy"), F.explode(around).alias("dx"))
             .select("*", F.explode(around).alias("dy"))
             .select("site_id", "sx", "sy", (_cell("sx", size) + F.col("dx")).alias("cx"), (_cell("sy", size) + F.col("dy")).alias("cy")))
    distance = F.sqrt(F.pow(F.col("x") - F.col("sx"), 2) + F.pow(F.col("y") - F.col("sy"), 2))
    at = F.struct(distance.alias("d"), "site_id")
    place = ["cx", "cy", "point_id", "x", "y"]
    asked = points.select("point_id", "x", "y", _cell("x", size).alias("cx"), _cell("y", size).alias("cy"))
    best = asked.join(cells, ["cx", "cy"]).groupBy(*place).agg(F.min(at).alias("b"))
    both = best.join(cells, ["cx", "cy"]).groupBy(*place, "b").agg(F.min(F.when(at != F.col("b"), at)).alias("s"))
    # A point_id may stand at several places: its second is the least that is not its first.
    first = both.withColumn("f", F.min("b").over(Window.partitionBy("point_id")))
    return (first.groupBy("point_id", "f").agg(F.min(F.when(F.col("b") != F.col("f"), F.col("b")).otherwise(F.col("s"))).alias("s"))
            .select("point_id", F.col("f.site_id").alias("target"), F.col("f.d").alias("d1"),
                    F.col("s.site_id").alias("source"), F.col("s.d").alias("d2")))


def weighted_edges(assigned: DataFrame, order: str) -> DataFrame:
    """GRF-01: repeated pairs add weight; strength is exp(-d/80) of the last one in ``order``."""
    return (assigned.groupBy(F.col("source").alias("src"), F.col("target").alias("dst"))
            .agg(F.count("*").alias("weight"), F.max_by("distance", order).alias("_d"))
            .select("src", "dst", "weight", decay(F.col("_d")).alias("strength")))


def known_lookup(variants: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """JOIN-24: left join of an annotation table on (chromosome, position), with a flag."""
    marked = known.withColumn("is_known", F.lit(True))
    return variants.join(marked, keys, "left").withColumn("is_known", F.coalesce("is_known", F.lit(False)))

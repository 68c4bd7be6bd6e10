"""Ordered operators that keep working when one key holds a large share of the rows.

A plain window sorts a whole key in one task. Here rows are dealt by range of (key, order)
(``operators/ordered.py``), so the number of tasks of a key follows its rows. Where the caller
knows blocks of bounded size that never decrease along the order (a position bin), it may pass
them instead and save the ranges: each block is ordered alone and only block summaries are
ordered per key. Rank filters use ``row_number`` directly, because Spark cuts each task to the
first N rows per key before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.functions.numeric import ratio
from strandlake.operators.ordered import neighbours, running_sums
from strandlake.operators.quantiles import exact_quantiles
from strandlake.session import checkpointed, join_back


def top_n(df: DataFrame, keys: list[str], order: list, n: int, rank: str = "rn") -> DataFrame:
    """WIN-01, WIN-12: first n rows per key; ``order`` must end in a unique column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)
            .withColumn(rank, F.col(rank).cast("bigint")))


def rank_at_most(df: DataFrame, keys: list[str], order: list, n: int, rank: str = "rnk") -> DataFrame:
    """WIN-02: rows whose rank (ties share it) is at most n."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank, F.rank().over(w)).filter(F.col(rank) <= n)
            .withColumn(rank, F.col(rank).cast("bigint")))


def running(df: DataFrame, keys: list[str], order: list[str], block: Column | None,
            sums: dict[str, Column]) -> DataFrame:
    """WIN-03: running sums per key up to and including each row.

    Pass ``lit(1)`` for a running count, fixed-point values for exact sums. ``block`` is for blocks of bounded size;
    without it rows are dealt by range.
    """
    if block is None:
        return running_sums(df, keys, order, sums)
    rows = df.withColumn("_key", F.struct(*keys, block.alias("_block")))
    return running_in_blocks(rows, keys, order, sums).select(*df.columns, *sums)


def running_in_blocks(rows: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``running`` over rows with ``_key``, the struct of their keys and ``_block``, in place of both.

    A struct is never NULL, so blocks with NULL keys meet by plain equality, and rows that are dealt by ``_key`` already are
    not moved again.
    """
    rows = rows.withColumns({f"_x_{n}": c for n, c in sums.items()})
    totals = rows.groupBy("_key").agg(*[F.sum(f"_x_{n}").alias(f"_t_{n}") for n in sums])
    own = [F.col(f"_key.{k}") for k in keys]
    earlier = Window.partitionBy(*own).orderBy("_key._block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_key", *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums])
    inside = Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({f"_s_{n}": F.sum(f"_x_{n}").over(inside) for n in sums})
    joined = local.join(offsets, "_key")
    return joined.withColumns({n: F.col(f"_s_{n}") + F.col(f"_o_{n}") for n in sums}).drop(*[f"_{p}_{n}" for n in sums for p in "xso"])


def _neighbour(df, keys, order, block, columns, forward):
    if block is None:
        return neighbours(df, keys, order, columns, forward)
    rows = df.withColumn("_block", block)
    step = F.lead if forward else F.lag
    edge = F.min_by if forward else F.max_by
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    local = rows.withColumns({
        "_near": step(F.struct(*[F.col(c).alias(n) for n, c in columns.items()])).over(inside)})
    edges = rows.groupBy(*keys, "_block").agg(
        edge(F.struct(*[F.col(c).alias(n) for n, c in columns.items()]), F.struct(*order)).alias("_edge"))
    across = edges.select(*keys, "_block", step("_edge").over(
        Window.partitionBy(*keys).orderBy("_block")).alias("_far"))
    joined = join_back(local, across, [*keys, "_block"])
    return joined.select(*df.columns, *[
        F.when(F.col("_near").isNotNull(), F.col(f"_near.{n}")).otherwise(F.col(f"_far.{n}")).alias(n)
        for n in columns])


def with_next(df: DataFrame, keys: list[str], order: list[str], block: Column | None,
              columns: dict[str, str]) -> DataFrame:
    """WIN-04: columns of the next row of the key, NULL at its end."""
    return _neighbour(df, keys, order, block, columns, True)


def with_previous(df: DataFrame, keys: list[str], order: list[str], block: Column | None,
                  columns: dict[str, str]) -> DataFrame:
    """WIN-05: columns of the previous row of the key, NULL at its start."""
    return _neighbour(df, keys, order, block, columns, False)


def numbered(df: DataFrame, order: list, name: str = "row_number") -> DataFrame:
    """WIN-10: global row numbers 1..n in a stated order, without a single-task window.

    Rows are range-partitioned and sorted in their partitions; the number is the partition's
    offset plus the place inside it. The sorted rows are checkpointed, so that counting and
    numbering see the same partitions. Only one row per partition is ordered globally.
    """
    places = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order)
                          .withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned(F.col("_place"), 33)
    counts = places.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    starts = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"))
    local = F.col("_place") - F.shiftleft(F.col("_part"), 33)
    return (places.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .select(*df.columns, (F.col("_start") + local + 1).alias(name)))


def with_tiles(df: DataFrame, order: list, tiles: int, name: str = "tile") -> DataFrame:
    """WIN-09: NTILE over all rows; the first n mod tiles tiles hold one row more."""
    rows = numbered(df, order, "_rn")
    total = df.select(F.count("*").alias("n")).scalar()
    small, extra = F.floor(total / tiles), total % tiles
    head = extra * (small + 1)
    tile = (F.when(F.col("_rn") <= head, F.floor((F.col("_rn") - 1) / (small + 1)))
            .otherwise(extra + F.floor((F.col("_rn") - 1 - head) / F.greatest(small, F.lit(1)))) + 1)
    return rows.withColumn(name, tile.cast("int")).drop("_rn")


def value_ranks(df: DataFrame, keys: list[str], value: str, descending: bool = False,
                blocks: int | None = None) -> DataFrame:
    """Per distinct value: rows equal, rows ranked before it, rows in all (per key).

    Values are first reduced to counts, so a hot value is one row; the counts are dealt by range of (key, value), so a hot
    key with many values spreads over as many tasks as its values ask for (or ``blocks``). Values of any ordered type are
    compared as they are. NULL values rank before all others.
    """
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n_equal"))
    order = [F.desc_nulls_first(value) if descending else F.asc_nulls_first(value)]
    upto = running_sums(counts, keys, order, {"_upto": F.col("n_equal")}, blocks)
    totals = upto.groupBy(*keys).agg(F.sum("n_equal").alias("n_total"))
    return join_back(upto, totals, keys).select(*keys, value, "n_equal", (F.col("_upto") - F.col("n_equal")).alias("n_before"), "n_total")


def percent_ranks(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """WIN-08: each row with PERCENT_RANK x 100 and its burden segment."""
    ranks = value_ranks(df, keys or [], value)
    share = F.when(F.col("n_total") > 1, F.col("n_before") / (F.col("n_total") - 1)).otherwise(0.0)
    return (join_back(df, ranks.select(*(keys or []), value, share.alias("_share")), [*(keys or []), value])
            .withColumns({"percentile": F.col("_share") * 100.0,
                          "segment": F.when(F.col("_share") >= 0.75, "High Burden")
                          .when(F.col("_share") >= 0.25, "Medium Burden").otherwise("Low Burden")})
            .drop("_share"))


def top_share_by_rank(df: DataFrame, keys: list[str], value: str, share: float = 0.2) -> DataFrame:
    """WIN-11: average rank in the group, highest value first, and whether it is within the share's quantile of ranks."""
    ranks = value_ranks(df, keys, value, descending=True)
    average = F.col("n_before") + (F.col("n_equal") + 1) / 2
    ranked = join_back(df, ranks.select(*keys, value, average.alias("avg_rank")), [*keys, value])
    limit = exact_quantiles(ranked, keys, "avg_rank", [share]).select(*keys, F.col("value").alias("_limit"))
    return (join_back(ranked, limit, keys).withColumn("highly_variable", F.col("avg_rank") <= F.col("_limit"))
            .drop("_limit"))


def growth(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """WIN-05: previous value and growth percent over an already aggregated series."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("previous", F.lag(value).over(w))
            .withColumn("growth_pct", ratio((F.col(value) - F.col("previous")) * 100.0, F.col("previous"))))


def moving_average(df: DataFrame, keys: list[str], order: list[str], value: str, before: int, after: int,
                   name: str) -> DataFrame:
    """WIN-06, WIN-07: average over neighbouring rows of an already aggregated series."""
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order).rowsBetween(-before, after)
    return df.withColumn(name, F.avg(value).over(w))


def cumulative(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """WIN-07: running total of an already aggregated series."""
    w = (Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(name, F.sum(value).over(w))


def segments(df: DataFrame, keys: list[str], order: list[str], block: Column | None, label: str,
             position: str, min_length: int = 1) -> DataFrame:
    """WIN-13: runs of equal consecutive labels, kept from ``min_length`` rows on."""
    before = with_previous(df, keys, order, block, {"_previous": label})
    starts = before.withColumn("_new", (~F.col(label).eqNullSafe(F.col("_previous"))).cast("int"))
    marked = running(starts, keys, order, block, {"_segment": F.col("_new")})
    return (marked.groupBy(*keys, "_segment", label)
            .agg(F.min(position).alias("start"), F.max(position).alias("end"),
                 F.count("*").alias("length"))
            .filter(F.col("length") >= min_length).drop("_segment"))


def sliding_majority(df: DataFrame, key: str, index: str, label: str, window: int, step: int) -> DataFrame:
    """WIN-14: majority label of every whole window of ``window`` rows; the smallest label on a tie.

    ``index`` counts the rows of a key from 0 without gaps.
    """
    first = F.greatest(F.lit(0), F.ceil((F.col(index) - (window - 1)) / step) * step)
    last = F.floor(F.col(index) / step) * step
    sizes = df.groupBy(key).agg((F.max(index) + 1).alias("_size"))
    placed = join_back(df, sizes, [key]).select(
        key, label, "_size", F.explode(F.when(last >= first, F.sequence(first, last, F.lit(step)))).alias("window_start"))
    counts = (placed.filter(F.col("window_start") + window <= F.col("_size"))
              .groupBy(key, "window_start", label).agg(F.count("*").alias("_n")))
    best = F.min_by(label, F.struct((-F.col("_n")).alias("a"), F.col(label).alias("b")))
    return counts.groupBy(key, "window_start").agg(best.alias("majority"))


def best_duplicate(df: DataFrame, keys: list[str], quality: str, tie: str) -> DataFrame:
    """WIN-15: per key the row of the highest quality, with the number of rows it stands for."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.col(quality).alias("a"), (-F.col(tie)).alias("b")))
    return (df.groupBy(*keys).agg(best.alias("_best"), F.count("*").alias("copies"))
            .select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest], "copies"))


def top_dispersion(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """WIN-16: keys of the greatest variance over mean."""
    return (df.groupBy(key).agg(ratio(F.var_samp(value), F.avg(value)).alias("dispersion"))
            .orderBy(F.desc_nulls_last("dispersion"), key).limit(n))


def half_seen(df: DataFrame, key: str, position: str, block: Column | None = None) -> DataFrame:
    """WIN-17: per key the first position at which half of its rows have been seen."""
    counts = df.groupBy(key, position).agg(F.count("*").alias("_c"))
    upto = running(counts, [key], [position], block, {"_seen": F.col("_c")})
    totals = df.groupBy(key).agg(F.count("*").alias("_n"))
    return (join_back(upto, totals, [key]).filter(F.col("_seen") * 2 >= F.col("_n"))
            .groupBy(key).agg(F.min(position).alias("half_position")))

"""Scans along an order when one key may hold most of the rows: rows are dealt by range, only edges are carried on.

Rows are range-partitioned by (key, order), so a large key spreads over many tasks and their number follows the rows.
Every part is ordered alone. A key that lies in one part needs nothing from elsewhere; of a key in several parts one
summary row per part is carried to the parts behind it, where it stands as one more row before (or behind) the key's own.
Parts cut the keys at most once each, so no more than two summary rows a part are ever carried, however many keys there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.session import checkpointed, join_back


def _null_first(order: list) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def dealt_by_range(df: DataFrame, keys: list[str], order: list, parts: int | None = None) -> DataFrame:
    """``df`` with ``_part``, the range of (keys, order) that a row lies in.

    The dealt rows are checkpointed: all that is computed per part then sees the same parts, also when a task is run again.
    ``parts`` is the number of ranges; by default the session's shuffle partitions, merged where they are small.
    """
    by = [*keys, *_null_first(order)]
    dealt = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    return checkpointed(dealt.withColumn("_part", F.spark_partition_id()))


def _with_edges(rows: DataFrame, edges: DataFrame, place: int) -> DataFrame:
    """Rows with ``_place`` 0, and what is carried as one row more per part and key, before (-1) or behind (1) them."""
    if "_place" not in rows.columns:
        rows = rows.withColumn("_place", F.lit(0))
    return rows.unionByName(edges.withColumn("_place", F.lit(place)), allowMissingColumns=True)


def _of_split_keys(per_part: DataFrame, keys: list[str]) -> DataFrame:
    """Summary rows of keys that lie in more than one part."""
    if not keys:
        return per_part
    split = per_part.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    return join_back(per_part, split, keys, "left_semi")


def running_sums(df: DataFrame, keys: list[str], order: list, sums: dict[str, Column], parts: int | None = None) -> DataFrame:
    """``df`` with running sums per key up to and including each row; ``order`` must end in a unique column."""
    rows = dealt_by_range(df.withColumns({f"_x_{n}": c for n, c in sums.items()}), keys, order, parts)
    totals = rows.groupBy("_part", *keys).agg(*[F.sum(f"_x_{n}").alias(f"_t_{n}") for n in sums])
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = _of_split_keys(totals, keys).select("_part", *keys, *[F.sum(f"_t_{n}").over(before).alias(f"_x_{n}") for n in sums])
    inside = Window.partitionBy("_part", *keys).orderBy("_place", *order).rowsBetween(Window.unboundedPreceding, 0)
    summed = _with_edges(rows, carried, -1).withColumns({f"_s_{n}": F.sum(f"_x_{n}").over(inside) for n in sums})
    return summed.filter("_place = 0").select(*df.columns, *[F.col(f"_s_{n}").alias(n) for n in sums])


def neighbours(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, str], forward: bool) -> DataFrame:
    """``df`` with columns of the next (or previous) row of the key, NULL at its end; ``order`` must be unique in a key."""
    step, edge = (F.lead, F.min_by) if forward else (F.lag, F.max_by)
    near = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    rows = dealt_by_range(df, keys, order).withColumn("_near", near)
    edges = rows.groupBy("_part", *keys).agg(edge("_near", F.struct(*order)).alias("_edge"))
    along = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part")
    across = _of_split_keys(edges, keys).select("_part", *keys, step("_edge").over(along).alias("_near"))
    both = _with_edges(rows, across, 1 if forward else -1)
    stepped = both.withColumn("_to", step("_near").over(Window.partitionBy("_part", *keys).orderBy("_place", *order)))
    return stepped.filter("_place = 0").select(*df.columns, *[F.col(f"_to.{n}").alias(n) for n in columns])


def nearest_known(df: DataFrame, order: str, value: Column, before: str, after: str) -> DataFrame:
    """``df`` with the last known (not NULL) ``value`` up to each row and the first from it on, along a unique ``order``.

    One row a part is carried over the parts, so no task sees the whole order.
    """
    rows = dealt_by_range(df.withColumn("_value", value), [], [order])
    known = F.when(F.col("_value").isNotNull(), F.col(order))
    edges = rows.groupBy("_part").agg(F.max_by("_value", known).alias("_last"), F.min_by("_value", known).alias("_first"))
    along = Window.partitionBy(F.lit(0)).orderBy("_part")
    across = edges.select("_part", F.last("_last", True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"),
                          F.first("_first", True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias("_later"))
    both = _with_edges(_with_edges(rows, across.select("_part", F.col("_earlier").alias("_value")), -1),
                       across.select("_part", F.col("_later").alias("_value")), 1)
    inside = Window.partitionBy("_part").orderBy("_place", order)
    found = both.withColumns({before: F.last("_value", True).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
                              after: F.first("_value", True).over(inside.rowsBetween(0, Window.unboundedFollowing))})
    return found.filter("_place = 0").select(*df.columns, before, after)

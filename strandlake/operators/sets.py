"""Set operations on rows and key sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_batches(frames: list[DataFrame]) -> DataFrame:
    """SET-01: union by name; a column missing from a batch is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def compare_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """SET-02, SET-03: distinct keys marked both / only_left / only_right, from one grouping."""
    marked = left.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    sides = marked.groupBy(key).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    side = (F.when((F.col("_l") == 1) & (F.col("_r") == 1), "both")
            .when(F.col("_l") == 1, "only_left").otherwise("only_right"))
    return sides.select(side.alias("side"), key)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """SNK-07: whether two tables hold the same rows, duplicates included."""
    columns = sorted(a.columns)
    if columns != sorted(b.columns):
        return False
    left, right = a.select(*columns), b.select(*columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()

"""Timing, partition and skew helpers."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions.numeric import ratio


def timed(action: Callable[[], object], repeats: int = 1) -> float:
    """PRF-01: best wall-clock seconds of an action."""
    best = float("inf")
    for _ in range(repeats):
        start = time.perf_counter()
        action()
        best = min(best, time.perf_counter() - start)
    return best


def run_all(df: DataFrame) -> None:
    """Compute every row and column without bringing any to the driver."""
    df.write.format("noop").mode("overwrite").save()


def compare(plans: dict[str, DataFrame], repeats: int = 1) -> dict[str, float]:
    """PRF-01: seconds per plan."""
    return {name: timed(lambda df=df: run_all(df), repeats) for name, df in plans.items()}


def partition_sizes(df: DataFrame) -> DataFrame:
    """PRF-01: rows per partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n"))


def partition_skew(df: DataFrame) -> DataFrame:
    """PRF-01: partitions, rows, least, mean and greatest partition, and greatest over mean."""
    return partition_sizes(df).agg(
        F.count("*").alias("partitions"), F.sum("n").alias("total"), F.min("n").alias("least"), F.max("n").alias("greatest"),
        F.avg("n").alias("mean"), ratio(F.max("n"), F.avg("n")).alias("skew"))


def key_skew(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """PRF-01: the n most frequent keys with their share of all rows."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = df.select(F.count("*")).scalar()
    return counts.withColumn("share", ratio(F.col("n"), total)).orderBy(F.desc("n"), key).limit(n)


def by_hash(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """PRF-02."""
    return df.repartition(partitions, *keys)


def by_range(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """PRF-02."""
    return df.repartitionByRange(partitions, *keys)


def fewer(df: DataFrame, partitions: int) -> DataFrame:
    """PRF-02."""
    return df.coalesce(partitions)


@contextmanager
def kept(df: DataFrame):
    """PRF-03: keep a DataFrame in memory and on disk while it is used several times."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """PRF-04: the plan as text."""
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()

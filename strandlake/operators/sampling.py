"""Sampling and splits that give the same rows on every run and every cluster."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.clinical import first_match
from strandlake.operators.ordered import running_sums
from strandlake.session import join_back


def bernoulli(df: DataFrame, keys: list[str], fraction: float, seed: int) -> DataFrame:
    """SMP-01: each key with the given chance, by its seeded hash; any partitioning gives the same rows."""
    share = F.conv(F.substring(key_hash(keys, seed), 1, 8), 16, 10).cast("bigint")
    return df.filter(share < int(fraction * 2 ** 32))


def key_hash(keys: list[str], seed: int) -> Column:
    """Seeded hash of the key, as hexadecimal text."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]).cast("binary"))


def split_by_key(df: DataFrame, keys: list[str], shares: dict[str, float], seed: int,
                 label: str = "part") -> DataFrame:
    """SMP-02: random split by key hash; needs no shuffle and does not depend on partitioning."""
    value = F.conv(F.substring(key_hash(keys, seed), 1, 8), 16, 10).cast("bigint")
    arms = [(value < int(upto * 2 ** 32), name) for name, upto in _upper_ends(shares)[:-1]]
    return df.withColumn(label, first_match(arms, list(shares)[-1]))


def _upper_ends(shares: dict[str, float]) -> list[tuple[str, float]]:
    ends = itertools.accumulate(shares.values())
    return [(name, round(end, 12)) for name, end in zip(shares, ends)]


def stratified_split(df: DataFrame, keys: list[str], strata: list[str], shares: dict[str, float], seed: int,
                     label: str = "part") -> DataFrame:
    """SMP-03: exact shares inside every stratum, in hash order.

    A stratum may hold most rows: rows are dealt by range of (stratum, hash), so no stratum is ordered in one task.
    """
    counted = df.groupBy(*strata).agg(F.count("*").alias("_n"))
    ranked = running_sums(df.withColumn("_h", key_hash(keys, seed)), strata, ["_h", *keys], {"_rank": F.lit(1)})
    placed = join_back(ranked, counted, strata)
    arms = [(F.col("_rank") <= F.floor(F.col("_n") * F.lit(upto) + 0.5), name)
            for name, upto in _upper_ends(shares)[:-1]]
    return placed.withColumn(label, first_match(arms, list(shares)[-1])).select(*df.columns, label)

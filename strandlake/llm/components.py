"""Connected components by alternating large-star and small-star rounds over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.base import Intermediate, stored

#: Links that one file of a round holds, so that few links do not become many small files and tasks.
LINKS_PER_FILE = 100_000


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) to ``(node, component)``: the smallest node reachable, for every node with a link.

    The rounds are the distributed union-find of Kiveris et al.: every node hands its larger neighbours to its smallest
    one, then its smaller neighbours too, until the links are stars around component minima. A round needs joins on
    node ids only; the minima are stored first, so a hub's links are split by adaptive execution and no node's
    neighbours are collected. Self links and repeated links are allowed; no links give an empty table.
    """
    with Intermediate(edges.sparkSession) as tables:
        links = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), "links")
        before = _mark(links)
        while before[0]:
            parts = max(8, before[0] // LINKS_PER_FILE)
            both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(parts), "lowest")
            large = stored(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large-star")
            low = stored(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts), "lowest")
            small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            links = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct().coalesce(parts), "small-star")
            after = _mark(links)
            if after == before:
                break
            before = after
        tables.keep(links)
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

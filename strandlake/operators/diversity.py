"""Diversity statistics over a long abundance table (sample, taxon, count)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions.numeric import ratio
from strandlake.operators.joins import unordered_pairs
from strandlake.operators.ordered import running_sums
from strandlake.operators.sampling import key_hash
from strandlake.operators.windows import numbered, value_ranks
from strandlake.session import checkpointed


def abundance(df: DataFrame, sample: str, taxon: str) -> DataFrame:
    """Counts per (sample, taxon)."""
    return df.groupBy(F.col(sample).alias("sample"), F.col(taxon).alias("taxon")).agg(F.count("*").alias("count"))


def alpha_diversity(table: DataFrame, base: float = 2.0) -> DataFrame:
    """DIV-01: observed taxa, Shannon (log base 2 unless stated), Simpson, bias-corrected Chao1."""
    present = table.filter(F.col("count") > 0)
    totals = present.groupBy("sample").agg(F.sum("count").alias("_n"))
    p = F.col("count") / F.col("_n")
    singles, doubles = F.count_if(F.col("count") == 1), F.count_if(F.col("count") == 2)
    return present.join(totals, "sample").groupBy("sample").agg(
        F.count("*").alias("observed"), (-F.sum(p * F.log(p)) / F.lit(math.log(base))).alias("shannon"),
        (F.lit(1.0) - F.sum(p * p)).alias("simpson"),
        (F.count("*") + ratio(singles * (singles - 1), (doubles + 1) * 2)).alias("chao1"))


def sample_pairs(table: DataFrame) -> DataFrame:
    """Per sample pair the shared minimum, shared taxa and equal counts, from taxa both hold."""
    a = table.filter(F.col("count") > 0).select("taxon", F.col("sample").alias("a"), F.col("count").alias("x"))
    b = a.select("taxon", F.col("a").alias("b"), F.col("x").alias("y"))
    return (a.join(b, "taxon").filter(F.col("a") < F.col("b")).groupBy("a", "b")
            .agg(F.sum(F.least("x", "y")).alias("low"), F.count("*").alias("shared")))


def beta_diversity(table: DataFrame) -> DataFrame:
    """DIV-02: Bray-Curtis dissimilarity and presence Jaccard distance of every sample pair.

    All sample pairs are the result. Work per taxon is bounded by the number of samples, not of rows:
    counts are aggregated first, and pairs without a shared taxon are added from the sample totals.
    """
    table = checkpointed(table.filter(F.col("count") > 0))  # counted, paired and summed below
    totals = table.groupBy("sample").agg(F.sum("count").alias("n"), F.count("*").alias("s"))
    every = unordered_pairs(totals, "sample").withColumnsRenamed({"sample_a": "a", "sample_b": "b"}).join(
        sample_pairs(table), ["a", "b"], "left")
    low, shared = F.coalesce("low", F.lit(0)), F.coalesce("shared", F.lit(0))
    return every.select(
        "a", "b", (F.lit(1.0) - ratio(low * 2, F.col("n_a") + F.col("n_b"))).alias("bray_curtis"),
        (F.lit(1.0) - ratio(shared, F.col("s_a") + F.col("s_b") - shared)).alias("jaccard"))


#: Labellings summed in one pass over the pairs.
LABELLINGS = 128


def _label_arrays(labels: DataFrame, permutations: int, seed: int) -> DataFrame:
    """(sample, drawn): the group of each sample in the given grouping and in every seeded relabelling.

    A relabelling orders the samples by a key hash and deals them the labels in sample order. Samples are numbered by range
    in each ordering, so no ordering of all samples is one task.
    """
    spark = labels.sparkSession
    ordered = checkpointed(numbered(labels.select("sample", "grp"), ["sample"], "_i"))
    draws = ordered.select("sample").join(F.broadcast(spark.range(1, permutations + 1).withColumnRenamed("id", "perm")))
    mixed = running_sums(draws.withColumn("_h", key_hash(["perm", "sample"], seed)), ["perm"], ["_h", "sample"], {"_i": F.lit(1)})
    dealt = mixed.join(ordered.select(F.col("_i").cast("bigint").alias("_i"), "grp"), "_i").select("perm", "sample", "grp")
    every = dealt.unionByName(ordered.select(F.lit(0).cast("bigint").alias("perm"), "sample", "grp"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("perm", "grp"))), lambda x: x["grp"])
    return every.groupBy("sample").agg(in_order.alias("drawn"))  # as many labels as permutations


def _pseudo_f(pairs: DataFrame, labels: DataFrame, permutations: int, seed: int) -> DataFrame:
    """(perm, pseudo_f) of the grouping (perm 0) and of its relabellings, from one pass over ``pairs(a, b, distance)``.

    A relabelling keeps the sizes of the groups, so a pair inside a group adds its squared distance over that size.
    """
    drawn = checkpointed(_label_arrays(labels, permutations, seed))
    sizes = labels.groupBy("grp").agg(F.count("*").alias("n")).agg(
        F.map_from_entries(F.collect_list(F.struct("grp", "n"))).alias("_sizes"), F.sum("n").alias("n"), F.count("*").alias("g"))
    joined = (pairs.join(drawn.select(F.col("sample").alias("a"), F.col("drawn").alias("da")), "a")
              .join(drawn.select(F.col("sample").alias("b"), F.col("drawn").alias("db")), "b")
              .join(F.broadcast(sizes.select("_sizes")))
              .withColumn("d2", F.col("distance") * F.col("distance")))
    total = F.sum("d2").alias("sst")
    out = None
    for begin in range(0, permutations + 1, LABELLINGS):
        some = range(begin, min(begin + LABELLINGS, permutations + 1))
        within = [F.sum(F.when(F.col("da")[p] == F.col("db")[p], F.col("d2") / F.element_at("_sizes", F.col("da")[p])).otherwise(0.0)).alias(f"w{p}")
                  for p in some]
        cells = F.inline(F.array(*[F.struct(F.lit(p).alias("perm"), F.col(f"w{p}").alias("ssw")) for p in some]))
        part = joined.agg(total, *within).select("sst", cells)
        out = part if out is None else out.unionByName(part)
    every = out.join(F.broadcast(sizes.select("n", "g")))
    n, g = F.col("n"), F.col("g")
    sst = F.col("sst") / n
    return every.select("perm", ratio((sst - F.col("ssw")) / (g - 1), F.col("ssw") / (n - g)).alias("pseudo_f"))


def permanova(pairs: DataFrame, labels: DataFrame, permutations: int = 99, seed: int = 42) -> DataFrame:
    """DIV-03: pseudo-F of the grouping and its p-value by seeded permutations."""
    every = _pseudo_f(pairs, labels, permutations, seed).agg(
        F.max(F.when(F.col("perm") == 0, F.col("pseudo_f"))).alias("pseudo_f"),
        F.collect_list(F.when(F.col("perm") > 0, F.col("pseudo_f"))).alias("drawn"))  # one number a permutation
    reached = F.size(F.filter("drawn", lambda f: f >= F.col("pseudo_f")))
    return every.select("pseudo_f", ((reached + 1) / F.lit(permutations + 1)).alias("p_value"))


def anosim(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """DIV-04: R from average ranks of distances between and within groups."""
    ranks = value_ranks(pairs, [], "distance").select(
        "distance", (F.col("n_before") + (F.col("n_equal") + 1) / 2).alias("_rank"), F.col("n_total"))
    la = labels.select(F.col("sample").alias("a"), F.col("grp").alias("ga"))
    lb = labels.select(F.col("sample").alias("b"), F.col("grp").alias("gb"))
    joined = pairs.join(ranks, "distance").join(la, "a").join(lb, "b")
    inside = F.col("ga") == F.col("gb")
    out = joined.agg(F.avg(F.when(~inside, F.col("_rank"))).alias("rb"), F.avg(F.when(inside, F.col("_rank"))).alias("rw"),
                     F.max("n_total").alias("m"))
    return out.select(((F.col("rb") - F.col("rw")) / (F.col("m") / 2)).alias("r"))

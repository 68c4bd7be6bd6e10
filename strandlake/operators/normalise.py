"""Normalisation of measurement matrices in long form (sample, feature, value).

Group statistics are computed by partial aggregation and joined back, so a sample or feature with
very many rows is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.numeric import ratio
from strandlake.operators.ordered import nearest_known
from strandlake.operators.quantiles import exact_medians
from strandlake.operators.windows import running, value_ranks
from strandlake.session import checkpointed, join_back


def batch_centred(df: DataFrame, batch: str, feature: str, value: str) -> DataFrame:
    """FEA-14: value minus its batch mean, per feature."""
    means = df.groupBy(batch, feature).agg(F.avg(value).alias("_m"))
    return join_back(df, means, [batch, feature]).withColumn("corrected", F.col(value) - F.col("_m")).drop("_m")


def batch_factors(df: DataFrame, batch: str, value: Column) -> DataFrame:
    """FEA-14: per batch its mean, z-score among the batch means (sample std) and additive factor."""
    means = df.groupBy(batch).agg(value.alias("batch_mean"))
    overall = means.agg(F.avg("batch_mean").alias("_m"), F.stddev_samp("batch_mean").alias("_s"))
    return means.join(F.broadcast(overall)).select(
        batch, "batch_mean", ratio(F.col("batch_mean") - F.col("_m"), F.col("_s")).alias("z_score"),
        (F.col("_m") - F.col("batch_mean")).alias("normalization_factor"))


def variance_reduction(factors: DataFrame) -> DataFrame:
    """FEA-14: variance of the batch means before (sample) and after (population) correction, percent removed."""
    after = F.var_pop(F.col("batch_mean") + F.col("normalization_factor"))
    out = factors.agg(F.var_samp("batch_mean").alias("before_variance"), after.alias("after_variance"))
    return out.withColumn("variance_reduction", ratio(
        (F.col("before_variance") - F.col("after_variance")) * 100.0, F.col("before_variance")))


def quantile_normalised(df: DataFrame, sample: str, value: str) -> DataFrame:
    """FEA-15: each value becomes the mean, over samples, of the values at its rank; ties take the lowest rank.

    Samples may differ in size: the mean at a rank is over the samples that reach it. A sample's sorted values
    are a step function of the rank, so the sum over samples is a running sum of the steps: a value adds
    itself at its first rank and takes itself away after its last, and so does the number of samples. A value
    repeated any number of times is two steps. A NULL value stays NULL.
    """
    ranks = checkpointed(value_ranks(df.filter(F.col(value).isNotNull()), [sample], value))  # read twice below
    exact = F.col(value).cast("decimal(38,18)")
    first = F.col("n_before") + 1
    steps = ranks.select(F.inline(F.array(
        F.struct(first.alias("_rank"), exact.alias("_step"), F.lit(1).alias("_one")),
        F.struct((first + F.col("n_equal")).alias("_rank"), (-exact).alias("_step"), F.lit(-1).alias("_one")))))
    totals = steps.groupBy("_rank").agg(F.sum("_step").alias("_step"), F.sum("_one").alias("_one"))
    profile = running(totals, [], ["_rank"], F.floor(F.col("_rank") / 65536), {"_sum": F.col("_step"), "_samples": F.col("_one")})
    means = profile.filter(F.col("_samples") > 0).select(
        "_rank", (F.col("_sum").cast("double") / F.col("_samples")).alias("normalised"))
    own = ranks.select(sample, value, first.alias("_rank")).join(means, "_rank").drop("_rank")
    return join_back(df, own, [sample, value], "left")


def median_normalised(df: DataFrame, sample: str, value: str) -> DataFrame:
    """FEA-17: value over the sample's exact median; a median of 0 counts as 1."""
    medians = exact_medians(df, [sample], value)
    divisor = F.when(F.col("median") == 0, 1.0).otherwise(F.col("median"))
    return join_back(df, medians, [sample]).withColumn("normalised", F.col(value) / divisor).drop("median")


def gc_corrected(df: DataFrame, sample: str, gc: str, value: str) -> DataFrame:
    """FEA-18: residual of the sample's linear fit on GC plus the sample mean, never below 0."""
    fits = df.groupBy(sample).agg(F.regr_slope(value, gc).alias("_a"), F.regr_intercept(value, gc).alias("_b"),
                                  F.avg(value).alias("_m"))
    trend = F.col("_a") * F.col(gc) + F.col("_b")
    return (join_back(df, fits, [sample])
            .withColumn("corrected", F.greatest(F.col(value) - trend + F.col("_m"), F.lit(0.0))).drop("_a", "_b", "_m"))


def mappability_corrected(df: DataFrame, track: DataFrame, sample: str, bin_col: str, value: str,
                          limit: float = 0.2) -> DataFrame:
    """FEA-19: value over mappability; bins below the limit interpolated from their neighbours.

    ``track(bin, mappability)`` describes the reference, once for all samples: the usable neighbours
    of every poor bin are found there, so samples need joins only. Beyond the ends the nearest
    usable value stands.
    """
    good = F.when(F.col("mappability") >= limit, F.col(bin_col))
    near = nearest_known(track.select(bin_col, "mappability"), bin_col, good, "_before", "_after")
    near = near.withColumns({"_before": F.coalesce("_before", "_after"), "_after": F.coalesce("_after", "_before")})
    rows = df.join(near, bin_col)
    fine = rows.filter(F.col("mappability") >= limit).withColumn("corrected", F.col(value) / F.col("mappability"))
    poor = rows.filter(F.col("mappability") < limit)

    def side(name, out):
        return fine.select(sample, F.col(bin_col).alias(name), F.col("corrected").alias(out))

    between = F.col(bin_col) - F.col("_before")
    span = F.col("_after") - F.col("_before")
    filled = (poor.join(side("_before", "_x"), [sample, "_before"]).join(side("_after", "_y"), [sample, "_after"])
              .withColumn("corrected", F.col("_x") + F.when(span > 0, (F.col("_y") - F.col("_x")) * between / span)
                          .otherwise(0.0)))
    columns = [*df.columns, "corrected"]
    return fine.select(*columns).unionByName(filled.select(*columns))


def bin_zscores(df: DataFrame, bin_col: str, value: str) -> DataFrame:
    """FEA-20: z-score across the cohort per bin, population std plus 1e-8."""
    stats = df.groupBy(bin_col).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    return join_back(df, stats, [bin_col]).withColumn(
        "z_score", (F.col(value) - F.col("_m")) / (F.col("_s") + F.lit(1e-8))).drop("_m", "_s")


def tpm(counts: DataFrame, lengths: DataFrame, sample: str, gene: str, count: str, length_kb: str) -> DataFrame:
    """FEA-21: transcripts per million; a gene without length counts as 1 kb."""
    rate = counts.join(lengths.select(gene, length_kb), gene, "left").withColumn(
        "_rate", F.col(count) / F.coalesce(F.col(length_kb), F.lit(1.0)))
    totals = rate.groupBy(sample).agg(F.sum("_rate").alias("_total"))
    return (join_back(rate, totals, [sample])
            .withColumn("tpm", F.coalesce(ratio(F.col("_rate"), F.col("_total")) * F.lit(1e6), F.lit(0.0)))
            .drop("_rate", "_total", length_kb))

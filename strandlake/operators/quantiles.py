"""Exact quantiles without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.operators.ordered import running_sums
from strandlake.session import checkpointed, join_back

#: Groups whose brackets are broadcast, a few hundred bytes each.
FEW_GROUPS = 10000


def exact_ranks(df: DataFrame, keys: list[str], value: str, probs: list[float], accuracy: int = 10000) -> DataFrame:
    """The two values around each wanted rank: (keys, prob, low, high, share), one row per key and probability.

    ``low`` and ``high`` have the type of ``value`` and are values of the group, no digit lost; the quantile lies at
    ``share`` between them. A mergeable sketch of fixed size brackets every wanted rank. One more pass counts the rows
    below each bracket and, per distinct value, inside it; brackets of up to ``FEW_GROUPS`` groups go to the rows, so no group
    is brought together, and of more groups each is met by key. Those values are dealt by range and counted up, so no group
    and no bracket is ordered in one task. The bracket is four times as wide as the sketch's stated rank error, and a group
    of at most ``accuracy`` rows is its own bracket, so the ranks lie inside it; should one not, the job fails instead of
    giving a near value.
    """
    eps = 4.0 / accuracy
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), F.col(value).cast("double").alias("_d"))
    lows = [max(0.0, p - eps) for p in probs]
    highs = [min(1.0, p + eps) for p in probs]
    # Kept in a checkpoint: it is asked twice, and its number of groups decides how rows meet their brackets.
    sketch = checkpointed(rows.groupBy(*keys).agg(
        F.percentile_approx("_d", lows, accuracy).alias("_lo"),
        F.percentile_approx("_d", highs, accuracy).alias("_hi"),
        F.min("_d").alias("_min"), F.max("_d").alias("_max"), F.count("*").alias("_n")))
    few = sketch.count() <= FEW_GROUPS
    small = F.col("_n") <= accuracy
    bands = F.array(*[
        F.struct(F.lit(float(p)).alias("prob"),
                 F.when(small | F.lit(lo == 0.0), F.col("_min")).otherwise(F.col("_lo")[i]).alias("a"),
                 F.when(small | F.lit(hi == 1.0), F.col("_max")).otherwise(F.col("_hi")[i]).alias("b"))
        for i, (p, lo, hi) in enumerate(zip(probs, lows, highs))])
    sizes = sketch.select(*keys, "_n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    bands = sketch.select(*keys, bands.alias("_bands"))
    if few:  # a group may hold most rows, and a shuffled join would order them in one task
        bands, sizes = F.broadcast(bands), F.broadcast(sizes)
    tagged = join_back(rows, bands, keys).select(*keys, "_v", "_d", F.explode("_bands").alias("_band"))
    # A value below the bracket is only counted; a value inside keeps its identity.
    inside = tagged.filter(F.col("_d") <= F.col("_band.b")).select(
        *keys, F.col("_band.prob").alias("prob"),
        F.when(F.col("_d") >= F.col("_band.a"), F.col("_v")).alias("_v"))
    counts = inside.groupBy(*keys, "prob", "_v").agg(F.count("*").alias("_c"))
    upto = running_sums(counts, [*keys, "prob"], [F.asc_nulls_first("_v")], {"_upto": F.col("_c")})
    ranked = join_back(upto.filter(F.col("_v").isNotNull()), sizes, [*keys, "prob"])
    position = (F.col("_n") - 1) * F.col("prob")
    lower, upper = F.floor(position) + 1, F.ceil(position) + 1

    def at(rank):
        return F.min(F.when(F.col("_upto") >= rank, F.col("_v")))

    found = ranked.groupBy(*keys, "prob").agg(
        at(lower).alias("low"), at(upper).alias("high"), F.first(position - F.floor(position)).alias("share"),
        (F.min(F.col("_upto") - F.col("_c")) < F.first(lower)).alias("_held"))
    checked = F.when(F.col("_held") & F.col("high").isNotNull(), F.col("share")).otherwise(
        F.raise_error(F.lit("quantile outside its bracket")).cast("double"))
    return found.select(*keys, "prob", "low", "high", checked.alias("share"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                    accuracy: int = 10000) -> DataFrame:
    """Linearly interpolated quantiles: one row per key and probability (keys, prob, value), as doubles."""
    low, high = F.col("low").cast("double"), F.col("high").cast("double")
    return exact_ranks(df, keys, value, probs, accuracy).select(
        *keys, "prob", (low * (1 - F.col("share")) + high * F.col("share")).alias("value"))


def quantiles_of_columns(df: DataFrame, columns: list[str], probs: list[float], name: str = "column_name") -> DataFrame:
    """(name, prob, value) of several numeric columns from one pass over the rows."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias("_x")) for c in columns])))
    return exact_quantiles(long, [name], "_x", probs)


def exact_medians(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return exact_quantiles(df, keys, value, [0.5]).select(*keys, F.col("value").alias("median"))


def quantile_columns(df: DataFrame, keys: list[str], value: str, named: dict[str, float]) -> DataFrame:
    """One row per key with a column per named quantile."""
    long = exact_quantiles(df, keys, value, list(named.values()))
    return long.groupBy(*keys).agg(*[
        F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(n) for n, p in named.items()])


def counted_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float]) -> DataFrame:
    """Exact quantiles of a value with few distinct values (scores, flags), from its counts."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    return counts.groupBy(*keys).agg(F.percentile(value, probs, F.col("_c")).alias("quantiles"))

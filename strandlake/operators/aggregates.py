"""Grouped statistics.

Group-bys here rely on partial aggregation before the shuffle, so a hot group
costs one partial row per task and never a whole group in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.functions.numeric import log2_fold, percent, ratio
from strandlake.operators.quantiles import quantiles_of_columns
from strandlake.session import checkpointed, join_back


def pass_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """FLT-03: rows passing each predicate, and all of them, from one scan."""
    every = reduce(lambda a, b: a & b, rules.values())
    counts = [F.count_if(rule).alias(f"n_{name}") for name, rule in rules.items()]
    wide = df.agg(F.count("*").alias("total"), *counts, F.count_if(every).alias("n_all"))
    names = [*rules, "all"]
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"n_{n}").alias("passed")) for n in names])
    long = wide.select("total", F.inline(rows))
    return long.withColumns({"removed": F.col("total") - F.col("passed"),
                             "pass_rate": percent(F.col("passed"), F.col("total"))})


def group_pass_rate(df: DataFrame, keys: list[str], passed: Column) -> DataFrame:
    """AGG-09: count, passed and percent passed per group."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(passed).alias("n_pass"),
        percent(F.count_if(passed), F.count("*")).alias("pass_rate"))


def pivot_counts(df: DataFrame, key: str, col: str, values: list) -> DataFrame:
    """AGG-10, AGG-12: counts per key and value, 0 where none; the value list fixes the columns."""
    return df.groupBy(key).pivot(col, values).count().fillna(0)


def distinct_values(df: DataFrame, col: str, limit: int = 10000) -> list:
    """Values for a dynamic pivot (AGG-11); refuses a domain too wide to become columns."""
    rows = df.select(col).distinct().orderBy(col).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} values; keep the long form")
    return [r[0] for r in rows]


def mode_per_group(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """AGG-14: most frequent value, the smallest on a tie.

    Counts shrink the data first; the winner is a max over (count, value), not a sorted group.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    top = counts.groupBy(*keys).agg(F.max("n").alias("n"))
    return (join_back(counts, top, [*keys, "n"]).groupBy(*keys)
            .agg(F.min(value).alias("mode"), F.first("n").alias("n")))


def share_within(df: DataFrame, keys: list[str], within: list[str]) -> DataFrame:
    """AGG-26: counts per key and their share of the total of ``within``."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.withColumn("share", ratio(F.col("n"), F.sum("n").over(Window.partitionBy(*within))))


def signal_sum(df: DataFrame, keys: list[str], depth: Column, frequency: Column) -> DataFrame:
    """AGG-34: sum of depth times frequency, of the values as they are.

    Pass decimal columns where the sum has to be the same in any order.
    """
    product = depth * frequency
    return df.groupBy(*keys).agg(F.sum(product).cast("double").alias("signal"))


def fold_change(df: DataFrame, key: str, value: str, condition: str, treated, control) -> DataFrame:
    """AGG-06, AGG-30: means under two conditions, delta, fold change and its log2; nothing is rounded."""
    t = F.avg(F.when(F.col(condition) == treated, F.col(value)))
    c = F.avg(F.when(F.col(condition) == control, F.col(value)))
    return (df.groupBy(key).agg(t.alias("mean_treated"), c.alias("mean_control"))
            .withColumns({"delta": F.col("mean_treated") - F.col("mean_control"),
                          "fold_change": ratio(F.col("mean_treated"), F.col("mean_control")),
                          "log2_fold_change": log2_fold(F.col("mean_treated"), F.col("mean_control"))}))


def coefficient_of_variation(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """AGG-31: sample std over mean; 0 when undefined."""
    return df.groupBy(*keys).agg(
        F.coalesce(ratio(F.stddev_samp(value), F.avg(value)), F.lit(0.0)).alias("cv"))


def latest_per_group(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """AGG-22: values of the row with the greatest ``order`` per key, by partial aggregation."""
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])


def earliest_per_group(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Values of the row with the smallest ``order`` per key."""
    best = F.min_by(F.struct(*values), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])


def partial_statistics(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """AGG-24: mergeable statistics (sum, count, min, max) of one batch."""
    return df.groupBy(*keys).agg(F.sum(value).alias("sum"), F.count(value).alias("count"),
                                 F.min(value).alias("min"), F.max(value).alias("max"))


def merge_statistics(parts: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-24: combine partial statistics of any number of batches."""
    return (parts.groupBy(*keys)
            .agg(F.sum("sum").alias("sum"), F.sum("count").alias("count"),
                 F.min("min").alias("min"), F.max("max").alias("max"))
            .withColumn("mean", ratio(F.col("sum"), F.col("count"))))


def column_summary(df: DataFrame, columns: list[str], exact_unique: bool = False) -> DataFrame:
    """AGG-18, AGG-20: one row per column: count, missing percentage, distinct values, mean, sample std, min and max as text,
    and exact quartiles of numeric columns.

    The measures come from a single aggregation; the quartiles of all columns from one more pass. Distinct values are
    estimated unless exact ones are asked for.
    """
    types = dict(df.dtypes)
    numeric = {c for c in columns if types[c] in ("int", "bigint", "double", "float", "smallint", "tinyint")
               or types[c].startswith("decimal")}
    measures = []
    for c in columns:
        number = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        measures.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("dtype"),
            F.count(c).alias("n"), (F.count("*") - F.count(c)).alias("missing"),
            percent(F.count("*") - F.count(c), F.count("*")).alias("missing_pct"),
            (F.count_distinct(c) if exact_unique else F.approx_count_distinct(c)).alias("unique" if exact_unique else "approx_unique"),
            F.avg(number).alias("mean"), F.stddev_samp(number).alias("std"),
            F.min(c).cast("string").alias("min"), F.max(c).cast("string").alias("max")).alias(f"s_{c}"))
    wide = df.agg(*measures)
    out = wide.select(F.inline(F.array(*[F.col(f"s_{c}") for c in columns])))
    named = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    if not numeric:
        return out.withColumns({n: F.lit(None).cast("double") for n in named})
    points = quantiles_of_columns(df, [c for c in columns if c in numeric], list(named.values())).groupBy("column_name").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in named.items()])
    return out.join(points, "column_name", "left")


#: Items of one side of a cell of pairs of a large group.
PAIR_ITEMS = 512


def top_pairs(df: DataFrame, group: str, item: str, k: int = 10, small_group: int = 50) -> DataFrame:
    """AGG-27: the k item pairs found together in most groups; ties go to the smaller pair.

    Groups of few rows are gathered (they are bounded) and give their pairs directly. A pair cannot be found in more groups
    than its rarer item, and pair counts over the small groups alone give a sound lower limit for the k-th best count: in
    large groups only items that reach it are paired, part of the group against part. A huge group of one-off items emits
    no pairs, and the result is exact.
    """
    named = df.select(F.col(group).alias("g"), F.col(item).alias("i"))
    large = named.groupBy("g").agg(F.count("*").alias("_n")).filter(F.col("_n") > small_group).select("g")
    best = [F.desc("n_groups"), "item_a", "item_b"]
    if large.isEmpty():
        return _pairs_of_small(named).orderBy(*best).limit(k)
    large = checkpointed(large)
    from_small = checkpointed(_pairs_of_small(named.join(large, "g", "left_anti")))
    bound = (from_small.orderBy(F.desc("n_groups")).limit(k)
             .agg(F.when(F.count("*") == k, F.min("n_groups")).otherwise(0).alias("b")))
    sets = checkpointed(named.distinct())
    frequent = sets.groupBy("i").agg(F.count("*").alias("_support")).filter(F.col("_support") >= bound.scalar()).select("i")
    from_large = _pairs_of_large(sets.join(large, "g", "left_semi").join(frequent, "i", "left_semi"))
    return (from_small.unionByName(from_large).groupBy("item_a", "item_b").agg(F.sum("n_groups").alias("n_groups"))
            .orderBy(*best).limit(k))


def _pairs_of_small(sets: DataFrame) -> DataFrame:
    """Counts of the item pairs of bounded groups, made from one sorted list a group."""
    lists = sets.filter(F.col("i").isNotNull() & F.col("g").isNotNull()).groupBy("g").agg(F.array_sort(F.collect_set("i")).alias("l"))
    made = F.flatten(F.transform("l", lambda a, at: F.transform(
        F.slice("l", at + 2, F.size("l")), lambda b: F.struct(a.alias("item_a"), b.alias("item_b")))))
    return lists.filter(F.size("l") > 1).select(F.inline(made)).groupBy("item_a", "item_b").agg(F.count("*").alias("n_groups"))


def _pairs_of_large(sets: DataFrame) -> DataFrame:
    """Counts of the item pairs of large groups: each group's items are dealt to blocks, each pair of blocks is a cell."""
    sizes = sets.groupBy("g").agg(F.ceil(F.count("*") / PAIR_ITEMS).cast("int").alias("_blocks"))
    dealt = (sets.join(sizes, "g").withColumn("_own", F.pmod(F.xxhash64("i"), F.col("_blocks")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
             .withColumns({"_low": F.least("_own", "_other"), "_high": F.greatest("_own", "_other")}))
    at = ["g", "_low", "_high", "_side"]
    a = dealt.select("g", "_low", "_high", (F.col("_own") == F.col("_low")).alias("_side"), F.col("i").alias("item_a"))
    b = dealt.select("g", "_low", "_high", (F.col("_own") == F.col("_high")).alias("_side"), F.col("i").alias("item_b"))
    return a.join(b, at).filter(F.col("item_a") < F.col("item_b")).groupBy("item_a", "item_b").agg(F.count("*").alias("n_groups"))


def ordered_list(df: DataFrame, keys: list[str], value: str, sep: str = ",") -> DataFrame:
    """AGG-13: distinct values of a group in order, joined as text."""
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(value)), sep).alias("items"))


def cohort_activity(df: DataFrame, entity: str, day: str, event: str) -> DataFrame:
    """AGG-28: active entities and events by cohort month and months since the first event."""
    first = df.groupBy(entity).agg(F.min(day).alias("_first"))
    joined = df.join(first, entity)
    months = ((F.year(day) - F.year("_first")) * 12 + F.month(day) - F.month("_first"))
    return (joined.groupBy(F.year("_first").alias("cohort_year"), F.month("_first").alias("cohort_month"),
                           months.alias("months_since_first"))
            .agg(F.countDistinct(entity).alias("active"), F.countDistinct(event).alias("events")))


def cohort_retention(entities: DataFrame, activity: DataFrame, entity: str, start: str, day: str,
                     months: int = 4) -> DataFrame:
    """AGG-29: percent of each cohort active 0..months-1 months after its start.

    Activity is first reduced to one flag row per entity, so no distinct count runs over raw rows.
    """
    gap = (F.year(day) - F.year(start)) * 12 + F.month(day) - F.month(start)
    flags = (activity.join(entities.select(entity, start), entity).groupBy(entity)
             .agg(*[F.max((gap == m).cast("int")).alias(f"_m{m}") for m in range(months)]))
    joined = entities.join(flags, entity, "left")
    size = F.count("*")
    return (joined.groupBy(F.year(start).alias("cohort_year"), F.month(start).alias("cohort_month"))
            .agg(size.alias("cohort_size"),
                 *[percent(F.coalesce(F.sum(f"_m{m}"), F.lit(0)), size).alias(f"month_{m}_pct")
                   for m in range(months)]))

"""Row filters and value repairs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.operators.quantiles import quantiles_of_columns

# Fixed value: the written form of a region.
REGION_PATTERN = re.compile(r"^([^:]+)(?::(\d+)-(\d+))?$")


def bound_filter(df: DataFrame, condition: str, args: dict) -> DataFrame:
    """FLT-10: filter with named parameters; values are bound, never pasted into the text."""
    return df.sparkSession.sql(f"SELECT * FROM {{rows}} WHERE {condition}", args=args, rows=df)


def regions(spark, texts: list[str]) -> DataFrame:
    """FLT-11: ``chrom`` or ``chrom:start-end`` texts as rows; an open region has NULL ends."""
    rows = []
    for text in texts:
        m = REGION_PATTERN.match(text)
        if not m:
            raise ValueError(f"not a region: {text}")
        rows.append((m[1], int(m[2]) if m[2] else None, int(m[3]) if m[3] else None))
    return spark.createDataFrame(rows, "chrom string, start bigint, end bigint")


def in_regions(df: DataFrame, texts: list[str], chrom: str = "chrom", pos: str = "pos") -> DataFrame:
    """FLT-11: rows inside any region, both ends included; written as a predicate, so it reaches the scan."""
    condition = F.lit(False)
    for text in texts:
        m = REGION_PATTERN.match(text)
        if not m:
            raise ValueError(f"not a region: {text}")
        here = F.col(chrom) == m[1]
        condition = condition | (here & F.col(pos).between(int(m[2]), int(m[3])) if m[2] else here)
    return df.filter(condition)


def ordered_ends(df: DataFrame, start: str, end: str) -> DataFrame:
    """FLT-13: swap the ends of intervals written the wrong way round."""
    return df.withColumns({start: F.least(start, end), end: F.greatest(start, end)})


def one_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """FLT-14, FEA-22: the first row per key in a stated order, as a partial aggregate (no sorted group)."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def drop_sparse(df: DataFrame, row: str, column: str, value: str,
                max_column_missing: float = 0.5, max_row_missing: float = 0.3) -> DataFrame:
    """FLT-15: long matrix without columns, then rows, that miss more than the given share."""
    def missing():
        return F.avg(F.col(value).isNull().cast("int"))

    columns = df.groupBy(column).agg(missing().alias("_m")).filter(F.col("_m") <= max_column_missing)
    kept = df.join(columns.select(column), column, "left_semi")
    rows = kept.groupBy(row).agg(missing().alias("_m")).filter(F.col("_m") <= max_row_missing)
    return kept.join(rows.select(row), row, "left_semi")


def joint_top_quartile(df: DataFrame, a: str, b: str, p: float = 0.75) -> DataFrame:
    """FLT-16: rows where both metrics reach their own exact quantile; both quantiles come from one pass."""
    points = quantiles_of_columns(df, [a, b], [p])

    def cut(c):
        return points.filter(F.col("column_name") == c).select("value").scalar()

    return df.filter((F.col(a) >= cut(a)) & (F.col(b) >= cut(b)))


def reset_unsupported(df: DataFrame, call: str, support: str, limit: float, neutral) -> DataFrame:
    """FLT-17: calls with too little support go back to the neutral class."""
    return df.withColumn(call, F.when(F.col(support) < limit, F.lit(neutral)).otherwise(F.col(call)))


def with_pass_flag(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Names of the rules a row fails, as an array; an empty array means it passes all."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), name)
                                       for name, rule in rules.items()]))
    return df.withColumn("failed_rules", failed)

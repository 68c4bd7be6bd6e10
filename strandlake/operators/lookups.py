"""Stored-function style lookups as joins and parameterised DataFrames, never one call per row."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.clinical import mapping_rate


def mapping_rates(runs: DataFrame, wanted: DataFrame) -> DataFrame:
    """UDF-03: mapping rate per asked run; NULL when the run is missing or has no reads."""
    rates = runs.select("run_id", mapping_rate(F.col("mapped_reads"), F.col("total_reads")).alias("mapping_rate"))
    return wanted.join(rates, "run_id", "left")


def entity_report(df: DataFrame, key: str, entity, value: str, low: float, high: float, flag_above: float) -> DataFrame:
    """UDF-05, UDF-06: rows of one entity within a range, flagged above a limit."""
    return (df.filter((F.col(key) == entity) & F.col(value).between(low, high))
            .withColumn("flagged", F.col(value) > flag_above))


def entity_summaries(entities: DataFrame, rows: DataFrame, key: str, value: str) -> DataFrame:
    """UDF-07, UDF-08: count, least, mean and greatest per entity, from one grouping."""
    stats = rows.groupBy(key).agg(F.count("*").alias("n"), F.min(value).alias("lowest"),
                                  F.avg(value).alias("mean"), F.max(value).alias("highest"))
    return entities.join(stats, key, "left")


def report_by_run(view: DataFrame, run_id: str) -> DataFrame:
    """UDF-09: the report of a run."""
    return view.filter(F.col("run_id") == run_id)


def report_by_metric(view: DataFrame, metric_id: int) -> DataFrame:
    """UDF-09: the same report by metric id."""
    return view.filter(F.col("metric_id") == metric_id)


def single_or_null(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """UDF-10: the value when exactly one row has the key, else NULL."""
    return df.groupBy(*keys).agg(F.when(F.count("*") == 1, F.min(value)).alias(name))


def register_sql_functions(spark: SparkSession) -> None:
    """UDF-03, UDF-04: the pure parts as SQL functions for use in query text."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION mapping_rate(mapped BIGINT, total BIGINT) RETURNS DOUBLE "
              "RETURN try_divide(mapped * 100.0D, CAST(total AS DOUBLE))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION coverage_class(x DOUBLE) RETURNS STRING RETURN "
              "CASE WHEN x < 30 THEN 'Low' WHEN x < 80 THEN 'Medium' WHEN x < 120 THEN 'High' ELSE 'Very High' END")


def variant_type_udf():
    """UDF-01: row-at-a-time form, kept to test that the built-in expression agrees."""
    @F.udf("string")
    def classify(ref, alt):
        if ref is None or alt is None:
            return "unknown"
        sizes = (len(ref), len(alt))
        if sizes == (1, 1):
            return "SNV"
        return "MNV" if sizes[0] == sizes[1] else ("insertion" if sizes[0] < sizes[1] else "deletion")

    return classify


def variant_type_pandas_udf():
    """UDF-02: vectorised form; works for any index of the batch."""
    @F.pandas_udf("string")
    def classify(ref: pd.Series, alt: pd.Series) -> pd.Series:
        a, b = ref.str.len().astype(float), alt.str.len().astype(float)
        out = pd.Series("MNV", index=ref.index)
        out = out.mask(a < b, "insertion").mask(a > b, "deletion").mask((a == 1) & (b == 1), "SNV")
        return out.mask(ref.isna() | alt.isna(), "unknown")

    return classify

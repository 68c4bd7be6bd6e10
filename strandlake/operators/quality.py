"""Validation rules, monitoring metrics, drift and scorecards.

Rules and thresholds are data; each report is one aggregation over the table and a small
long-form result.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.numeric import percent, ratio
from strandlake.operators.quantiles import exact_quantiles

# Type names used in rule files, limits and labels used by the reports.
RULE_TYPES = {"string": ("string",), "int": ("int", "bigint", "smallint", "tinyint"),
              "float": ("double", "float", "int", "bigint"), "bool": ("boolean",)}
MISSING_LIMIT = 0.20
MISSING_LEVELS = ((20.0, "HIGH"), (10.0, "MODERATE"))
MEAN_DRIFT_LIMIT, STD_DRIFT_LIMIT = 20.0, 30.0


def load_rules(text: str) -> dict[str, dict]:
    """DQ-01: rule set from JSON text, or from YAML text where a YAML reader is installed."""
    try:
        return json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError as error:
            raise ValueError("rules are neither JSON nor readable as YAML here") from error
        return yaml.safe_load(text)


def row_rules(rules: Mapping[str, dict]) -> list[tuple[str, str, Column]]:
    """DQ-01..03: (column, rule, violated) for every rule that one row can break; NULL breaks only ``nullable``."""
    out = []
    for name, spec in rules.items():
        col = F.col(name)
        if not spec.get("nullable", True):
            out.append((name, "not_null", col.isNull()))
        if "min_value" in spec:
            low = col <= spec["min_value"] if spec.get("open_min") else col < spec["min_value"]
            out.append((name, "min_value", low))
        if "max_value" in spec:
            high = col >= spec["max_value"] if spec.get("open_max") else col > spec["max_value"]
            out.append((name, "max_value", high))
        if "allowed_values" in spec:
            out.append((name, "allowed_values", ~col.isin(*spec["allowed_values"])))
    return [(c, r, F.coalesce(v, F.lit(False))) for c, r, v in out]


def schema_findings(df: DataFrame, rules: Mapping[str, dict]) -> list[tuple[str, str]]:
    """DQ-01: columns that are absent or of another type than their rule says."""
    types = dict(df.dtypes)
    out = [(c, "absent") for c in rules if c not in types]
    for name, spec in rules.items():
        if name in types and "type" in spec and types[name] not in RULE_TYPES[spec["type"]]:
            out.append((name, "type"))
    return out


def rule_report(df: DataFrame, rules: Mapping[str, dict]) -> DataFrame:
    """DQ-01: violations per (column, rule); every rule is checked, none stops the others."""
    wrong = schema_findings(df, rules)
    present = {c: s for c, s in rules.items() if c in df.columns and (c, "type") not in wrong}
    checks = row_rules(present)
    counts = df.agg(F.count("*").alias("total"),
                    *[F.count_if(v).alias(f"v{i}") for i, (_, _, v) in enumerate(checks)])
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"), F.col(f"v{i}").alias("violations"))
             for i, (c, r, _) in enumerate(checks)]
    cells += [F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"), F.col("total").alias("violations"))
              for c, r in wrong]
    out = counts.select(F.inline(F.array(*cells)))
    for name, spec in present.items():
        if spec.get("unique"):
            repeats = duplicate_keys(df, [name]).agg(
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
            out = out.unionByName(repeats.select(F.lit(name).alias("column_name"), F.lit("unique").alias("rule"),
                                                 "violations"))
    return out


def rule_violations(df: DataFrame, key: str, rules: Mapping[str, dict]) -> DataFrame:
    """DQ-01: one row per broken rule and row: key, column, rule, value."""
    present = {c: s for c, s in rules.items() if c in df.columns}
    cells = [F.when(v, F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"),
                                F.col(c).cast("string").alias("value"))) for c, r, v in row_rules(present)]
    found = df.select(key, F.explode(F.array_compact(F.array(*cells))).alias("_c"))
    return found.select(key, "_c.column_name", "_c.rule", "_c.value")


def is_valid(report: DataFrame) -> bool:
    return report.filter(F.col("violations") > 0).isEmpty()


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """DQ-04: keys found more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """DQ-05: child rows without a parent."""
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def without_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """DQ-05: child rows that have a parent."""
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_semi")


def cohort_warnings(df: DataFrame, age: str = "age", wbc: str = "wbc_count", tp53: str = "tp53_mutation") -> DataFrame:
    """DQ-06: age mean outside [40, 75], WBC above 30 in more than 5 % of values, TP53 rate outside [0.3, 0.7]."""
    stats = df.agg(F.avg(age).alias("a"), percent(F.count_if(F.col(wbc) > 30), F.count(wbc)).alias("w"),
                   F.avg(F.col(tp53).cast("int")).alias("t"))
    cells = F.array(
        F.struct(F.lit("age_mean").alias("check"), F.col("a").alias("value"), (~F.col("a").between(40, 75)).alias("warns")),
        F.struct(F.lit("wbc_outlier_pct").alias("check"), F.col("w").alias("value"), (F.col("w") > 5).alias("warns")),
        F.struct(F.lit("tp53_rate").alias("check"), F.col("t").alias("value"), (~F.col("t").between(0.3, 0.7)).alias("warns")))
    return stats.select(F.inline(cells))


def missing_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """DQ-07, DQ-08, DQ-14: missing count and percent per column, level and warning."""
    total = F.count("*")
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), (total - F.count(c)).alias("missing"),
                               total.alias("total")) for c in columns])
    pct = percent(F.col("missing"), F.col("total"))
    level = F
    for limit, label in MISSING_LEVELS:
        level = level.when(F.col("missing_pct") > limit, label)
    return (df.agg(cells.alias("_c")).select(F.inline("_c")).withColumn("missing_pct", pct)
            .withColumns({"level": level.otherwise("OK"), "warns": F.col("missing_pct") > MISSING_LIMIT * 100}))


def absent_features(df: DataFrame, wanted: list[str]) -> list[str]:
    """DQ-14: wanted features that the table does not have."""
    return [c for c in wanted if c not in df.columns]


def feature_gaps(df: DataFrame, wanted: list[str]) -> DataFrame:
    """DQ-14: the missing report of all wanted features; one that the table lacks is missing in every row, level ABSENT."""
    absent = absent_features(df, wanted)
    full = df.withColumns({c: F.lit(None).cast("string") for c in absent})
    report = missing_report(full, wanted)
    is_absent = F.col("column_name").isin(absent) if absent else F.lit(False)
    return report.withColumns({"level": F.when(is_absent, "ABSENT").otherwise(F.col("level")),
                               "warns": is_absent | F.coalesce("warns", F.lit(False))})


def distribution_metrics(df: DataFrame, columns: list[str]) -> DataFrame:
    """DQ-09: count, mean, median, std, min, max, quartiles, bias-corrected skewness and excess kurtosis."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_x")) for c in columns])))
    n, g1, g2 = F.count("_x").cast("double"), F.skewness("_x"), F.kurtosis("_x")
    skew = F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    stats = long.groupBy("column_name").agg(
        F.count("_x").alias("n"), F.avg("_x").alias("mean"), F.stddev_samp("_x").alias("std"),
        F.min("_x").alias("min"), F.max("_x").alias("max"), skew.alias("skewness"), kurt.alias("kurtosis"))
    points = exact_quantiles(long, ["column_name"], "_x", [0.25, 0.5, 0.75])
    wide = points.groupBy("column_name").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
        for name, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))])
    return stats.join(wide, "column_name", "left")


def categorical_metrics(df: DataFrame, columns: list[str]) -> DataFrame:
    """DQ-10: distinct values, most common value (smallest on a tie), its count and percent of non-null."""
    counts = category_counts(df, columns)
    top = counts.groupBy("column_name").agg(F.count("*").alias("unique_values"), F.sum("n").alias("_t"),
                                            F.max("n").alias("most_common_count"))
    tied = counts.join(top, "column_name").filter(F.col("n") == F.col("most_common_count"))
    return (tied.groupBy("column_name", "unique_values", "most_common_count", "_t")
            .agg(F.min("value").alias("most_common"))
            .select("column_name", "unique_values", "most_common", "most_common_count",
                    percent(F.col("most_common_count"), F.col("_t")).alias("most_common_pct")))


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """DQ-10: the distribution itself, in long form."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])))
    return long.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count("*").alias("n"))


def correlations(df: DataFrame, columns: list[str], threshold: float | None = None) -> DataFrame:
    """DQ-11: Pearson correlation of every column pair over rows where both are present, in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    both = [F.corr(*[F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.col(c).cast("double")) for c in (a, b)])
            for a, b in pairs]
    wide = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(both)])
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("feature1"), F.lit(b).alias("feature2"), F.col(f"c{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)])))
    return long if threshold is None else long.filter(F.abs("correlation") > threshold)


def _moments(df: DataFrame, columns: list[str], tag: str) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.avg(c).alias(f"mean_{tag}"),
                               F.stddev_samp(c).alias(f"std_{tag}")) for c in columns])
    return df.agg(cells.alias("_c")).select(F.inline("_c"))


def drift(first: DataFrame, second: DataFrame, columns: list[str]) -> DataFrame:
    """DQ-12: change of mean and std in percent of the first batch, flagged above 20 and 30.

    The mean change is taken against the size of the first mean, so a negative mean can flag too.
    """
    both = _moments(first, columns, "1").join(_moments(second, columns, "2"), "column_name")
    mean_pct = ratio(F.abs(F.col("mean_2") - F.col("mean_1")) * 100.0, F.abs("mean_1"))
    std_pct = ratio(F.abs(F.col("std_2") - F.col("std_1")) * 100.0, F.col("std_1"))
    return both.select("column_name", mean_pct.alias("mean_change_pct"), std_pct.alias("std_change_pct")).withColumn(
        "drifted", F.coalesce((F.col("mean_change_pct") > MEAN_DRIFT_LIMIT)
                              | (F.col("std_change_pct") > STD_DRIFT_LIMIT), F.lit(False)))


def distribution_checks(metrics: DataFrame, config: Mapping[str, dict]) -> DataFrame:
    """DQ-13: metrics outside their configured ranges; ``config`` maps feature to mean_range, std_range, min/max."""
    spark = metrics.sparkSession
    rows = []
    for name, spec in config.items():
        for metric, low, high in (("mean", *spec.get("mean_range", (None, None))),
                                  ("std", *spec.get("std_range", (None, None))),
                                  ("min", spec.get("min_value"), None), ("max", None, spec.get("max_value"))):
            if low is not None or high is not None:
                rows.append((name, metric, None if low is None else float(low), None if high is None else float(high)))
    limits = spark.createDataFrame(rows, "column_name string, metric string, low double, high double")
    long = metrics.unpivot(["column_name"], ["mean", "std", "min", "max"], "metric", "value")
    outside = F.coalesce(F.col("value") < F.col("low"), F.lit(False)) | F.coalesce(
        F.col("value") > F.col("high"), F.lit(False))
    return (long.join(F.broadcast(limits), ["column_name", "metric"])
            .withColumn("outside", outside))


def log_entry(spark: SparkSession, log: DataFrame, stage: str, valid: bool, errors: list[str],
              warnings: list[str]) -> DataFrame:
    """DQ-15: the quality log with one more entry, numbered after the last."""
    entry = (log.agg((F.coalesce(F.max("log_id"), F.lit(0)) + 1).cast("bigint").alias("log_id"))
             .select("log_id", F.lit(stage).alias("stage"), F.lit(valid).alias("is_valid"),
                     F.lit(json.dumps(errors)).alias("errors"), F.lit(json.dumps(warnings)).alias("warnings"),
                     F.current_timestamp().alias("logged_at")))
    return log.unionByName(entry)


def recent_log(log: DataFrame, n: int) -> DataFrame:
    """DQ-15: the latest n entries."""
    return log.orderBy(F.desc("log_id")).limit(n)


def scorecard(metrics: DataFrame, thresholds: list[tuple[str, str, float, float | None]]) -> DataFrame:
    """DQ-16: PASS, WARNING or FAIL per metric; a metric without threshold is INFO.

    ``metrics(metric, value)``; a threshold is (metric, '>=' or '<=', limit, warning limit or None):
    values that miss the limit but reach the warning limit are warnings.
    """
    table = metrics.sparkSession.createDataFrame(
        thresholds, "metric string, direction string, threshold double, warn_at double")
    value, limit, warn = F.col("value"), F.col("threshold"), F.col("warn_at")

    def reached(line):
        return F.when(F.col("direction") == ">=", value >= line).otherwise(value <= line)

    status = (F.when(limit.isNull(), "INFO").when(reached(limit), "PASS")
              .when(warn.isNotNull() & reached(warn), "WARNING").otherwise("FAIL"))
    return metrics.join(F.broadcast(table), "metric", "left").select("metric", "value", "threshold",
                                                                     status.alias("status"))


def overall_status(card: DataFrame) -> DataFrame:
    """DQ-16: FAIL if any metric fails, else WARNING if any warns, else PASS."""
    return card.agg(F.when(F.count_if(F.col("status") == "FAIL") > 0, "FAIL")
                    .when(F.count_if(F.col("status") == "WARNING") > 0, "WARNING")
                    .otherwise("PASS").alias("overall"))


def group_verdicts(df: DataFrame, pass_rate: str, quality: str, adapter_pct: str) -> DataFrame:
    """DQ-17: verdict with joined reasons: pass rate < 50, mean quality < 25, adapters > 20 percent."""
    reasons = F.concat_ws(
        "; ",
        F.when(F.col(pass_rate) < 50, F.format_string("Low pass rate (%.1f%%)", pass_rate)),
        F.when(F.col(quality) < 25, F.format_string("Low avg quality (%.1f)", quality)),
        F.when(F.col(adapter_pct) > 20, F.format_string("High adapter contamination (%.1f%%)", adapter_pct)))
    return df.withColumn("_r", reasons).withColumns(
        {"passed": F.col("_r") == "", "reasons": F.when(F.col("_r") == "", "PASS").otherwise(F.col("_r"))}).drop("_r")


def outliers(df: DataFrame, column: str, limit: float = 3.0) -> DataFrame:
    """DQ-18: rows with absolute z-score above the limit, by population std."""
    stats = df.agg(F.avg(column).alias("_m"), F.stddev_pop(column).alias("_s"))
    z = ratio(F.col(column) - F.col("_m"), F.col("_s"))
    return df.join(F.broadcast(stats)).withColumn("z_score", z).filter(F.abs("z_score") > limit).drop("_m", "_s")


def manifest(tables: Mapping[str, tuple[str, str, DataFrame]]) -> DataFrame:
    """DQ-19: one row per table: name, zone, path, schema, row count, time of the listing."""
    out = None
    for name, (zone, path, df) in tables.items():
        row = df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(zone).alias("zone"), F.lit(path).alias("path"),
            F.lit(df.schema.simpleString()).alias("table_schema"), "row_count",
            F.current_timestamp().alias("updated_at"))
        out = row if out is None else out.unionByName(row)
    return out


# --- role views -------------------------------------------------------------------------------

def role_view(df: DataFrame, policy: Mapping[str, object]) -> DataFrame:
    """GOV-01, GOV-02: the rows and columns a role may see.

    A policy holds ``exclude`` (columns) and ``rows`` (a filter Column or expression). The row filter is
    applied before columns are dropped, so it may use an excluded column.
    """
    rows = policy.get("rows")
    visible = df if rows is None else df.filter(rows)
    return visible.drop(*policy.get("exclude", ()))

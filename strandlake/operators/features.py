"""Clinical feature engineering: fit once, apply anywhere, store by version.

Fitting is a few aggregations whose small result is a ``Parameters`` value; applying it is a
projection without shuffle. Parameters turn into rows, so they are stored beside the features.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.clinical import first_match
from strandlake.functions.text import mapped_label
from strandlake.operators.aggregates import distinct_values
from strandlake.operators.quantiles import exact_quantiles

# Column sets, limits and labels of the clinical features.
IMPUTED = {"wbc_count": ("wbc_imputed", "median"), "hemoglobin": ("hemoglobin_imputed", "mean"),
           "platelet_count": ("platelet_imputed", "median")}
SEX_LABELS = {"Male": "Male", "M": "Male", "male": "Male", "Female": "Female", "F": "Female", "female": "Female"}
MUTATIONS = ("tp53_mutation", "kras_mutation", "egfr_mutation")
AGE_BINS = ((40, "18-40"), (60, "41-60"), (75, "61-75"), (120, "76+"))


@dataclass(frozen=True)
class Parameters:
    """Fitted values: imputation fills, category lists, (mean, population std) per scaled column."""

    fills: dict[str, object] = field(default_factory=dict)
    categories: dict[str, list] = field(default_factory=dict)
    scales: dict[str, tuple[float, float]] = field(default_factory=dict)

    def to_rows(self, spark: SparkSession, version: int) -> DataFrame:
        body = json.dumps({"fills": self.fills, "categories": self.categories, "scales": self.scales})
        return spark.createDataFrame([(version, body)], "feature_version int, parameters string")

    @staticmethod
    def from_rows(rows: DataFrame, version: int) -> Parameters:
        found = rows.filter(F.col("feature_version") == version).select("parameters").first()
        if found is None:
            raise ValueError(f"no fitted parameters for version {version}")
        body = json.loads(found[0])
        return Parameters(body["fills"], body["categories"], {k: tuple(v) for k, v in body["scales"].items()})


def _require(df: DataFrame, columns) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")


def fit_fills(df: DataFrame, strategies: dict[str, str]) -> dict[str, object]:
    """FEA-01: mean, median or most frequent value per column."""
    _require(df, strategies)
    fills: dict[str, object] = {}
    means = [c for c, s in strategies.items() if s == "mean"]
    if means:
        fills.update(df.agg(*[F.avg(c).alias(c) for c in means]).first().asDict())
    for name, strategy in strategies.items():
        if strategy == "median":
            row = exact_quantiles(df, [], name, [0.5]).first()
            fills[name] = row["value"] if row else None
        elif strategy == "most_frequent":
            row = (df.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
                   .orderBy(F.desc("n"), name).first())
            fills[name] = row[name] if row else None
        elif strategy != "mean":
            raise ValueError(f"unknown strategy {strategy}")
    return fills


def impute(df: DataFrame, fills: dict[str, object], names: dict[str, str] | None = None) -> DataFrame:
    """FEA-01: new ``*_imputed`` columns; the originals stay."""
    _require(df, fills)
    names = names or {}
    return df.withColumns({names.get(c, f"{c}_imputed"): F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def fit_categories(df: DataFrame, columns: list[str]) -> dict[str, list]:
    """FEA-02: sorted categories per column, the first one to be dropped."""
    _require(df, columns)
    return {c: [v for v in distinct_values(df, c, 1000) if v is not None] for c in columns}


def one_hot(df: DataFrame, categories: dict[str, list]) -> DataFrame:
    """FEA-02: ``{feature}_{category}`` 0/1 columns; unknown categories are all zeros."""
    _require(df, categories)
    return df.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0))
                           for c, values in categories.items() for v in values[1:]})


def fit_scales(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """FEA-03: mean and population std; a constant column is divided by 1."""
    _require(df, columns)
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def scale(df: DataFrame, scales: dict[str, tuple[float, float]], suffix: str = "_scaled") -> DataFrame:
    _require(df, scales)
    return df.withColumns({f"{c}{suffix}": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scales.items()})


def min_max(df: DataFrame, columns: list[str], suffix: str = "_minmax") -> DataFrame:
    """FEA-16: (x - min) / (max - min); a constant column gives 0."""
    _require(df, columns)
    row = df.agg(*[F.min(c).alias(f"a{i}") for i, c in enumerate(columns)],
                 *[F.max(c).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    return df.withColumns({f"{c}{suffix}": (F.col(c) - row[f"a{i}"]) / ((row[f"b{i}"] - row[f"a{i}"]) or 1.0)
                           for i, c in enumerate(columns)})


def log1p_scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """FEA-16: z-score of log1p."""
    logs = df.withColumns({f"{c}_log1p": F.log1p(c) for c in columns})
    names = [f"{c}_log1p" for c in columns]
    return scale(logs, fit_scales(logs, names))


def standard_sex(df: DataFrame, column: str = "sex") -> DataFrame:
    """STR-06: spellings to Male or Female, unknown to NULL."""
    return df.withColumn(column, mapped_label(F.col(column), SEX_LABELS))


def mutation_burden(df: DataFrame) -> DataFrame:
    """FEA-04."""
    _require(df, MUTATIONS)
    return df.withColumn("mutation_burden", sum((F.col(c).cast("int") for c in MUTATIONS), F.lit(0)))


def clinical_risk_score(df: DataFrame) -> DataFrame:
    """FEA-05: age/10 + 5 x comorbidities."""
    _require(df, ("age", "comorbidity_count"))
    return df.withColumn("clinical_risk_score", F.col("age") / 10 + F.col("comorbidity_count") * 5)


def high_risk_flag(df: DataFrame) -> DataFrame:
    """FEA-06: at least two of age > 70, comorbidity >= 3, TMB > 20."""
    _require(df, ("age", "comorbidity_count", "tmb_score"))
    risks = [F.col("age") > 70, F.col("comorbidity_count") >= 3, F.col("tmb_score") > 20]
    hits = sum((F.coalesce(r, F.lit(False)).cast("int") for r in risks), F.lit(0))
    return df.withColumn("high_risk_patient", (hits >= 2).cast("int"))


def age_groups(df: DataFrame) -> DataFrame:
    """FEA-07: right-closed bins, 0 included; outside gives NULL."""
    _require(df, ("age",))
    age = F.col("age")
    arms = [(age < 0, None)] + [(age <= top, label) for top, label in AGE_BINS]
    return df.withColumn("age_group", first_match(arms, None))


def wbc_categories(df: DataFrame) -> DataFrame:
    """FEA-08: Unknown, Low < 4, Normal <= 11, High; the imputed column is preferred."""
    name = "wbc_imputed" if "wbc_imputed" in df.columns else "wbc_count"
    _require(df, (name,))
    value = F.col(name)
    return df.withColumn("wbc_category", first_match(
        [(value.isNull(), "Unknown"), (value < 4, "Low"), (value <= 11, "Normal")], "High"))


def fit(df: DataFrame, encode=("sex", "ethnicity"), scaled=("age", "comorbidity_count", "tmb_score")) -> Parameters:
    """FEA-09: all parameters of the full transform, from columns the table has."""
    known = standard_sex(df) if "sex" in df.columns else df
    strategies = {c: s for c, (_, s) in IMPUTED.items() if c in df.columns}
    return Parameters(fit_fills(known, strategies),
                      fit_categories(known, [c for c in encode if c in df.columns]),
                      fit_scales(known, [c for c in scaled if c in df.columns]))


def transform(df: DataFrame, parameters: Parameters | None) -> DataFrame:
    """FEA-09: the full transform in its fixed order; without fitted parameters it is an error."""
    if parameters is None:
        raise ValueError("fit before transform")
    out = standard_sex(df) if "sex" in df.columns else df
    out = impute(out, parameters.fills, {c: n for c, (n, _) in IMPUTED.items()})
    out = scale(one_hot(out, parameters.categories), parameters.scales)
    out = high_risk_flag(clinical_risk_score(mutation_burden(out)))
    return wbc_categories(age_groups(out))


# --- storage by (entity, version) -------------------------------------------------------------

def ingest_raw(raw: DataFrame, batch: DataFrame, key: str, rules: dict | None) -> DataFrame:
    """Raw table after ingesting a batch: validated first, then delete-and-insert by entity."""
    from strandlake.operators.changes import replace_keys
    from strandlake.operators.quality import is_valid, rule_report
    if rules is not None:
        report = rule_report(batch, rules)
        if not is_valid(report):
            broken = report.filter(F.col("violations") > 0).limit(100).collect()
            raise ValueError(f"batch refused: {[tuple(r) for r in broken]}")
    return replace_keys(raw, batch, [key])


def store_version(stored: DataFrame | None, computed: DataFrame, key: str, version: int) -> DataFrame:
    """FEA-10: feature table with one version rewritten for the computed entities; other versions stay."""
    new = computed.withColumn("feature_version", F.lit(version))
    if stored is None:
        return new
    kept = stored.join(new.select(key, "feature_version"), [key, "feature_version"], "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def features_of(stored: DataFrame, key: str, features: list[str] | None = None, entities: DataFrame | None = None,
                version: int | None = None) -> DataFrame:
    """FEA-11: features of the asked entities; no version means the latest one stored."""
    latest = stored.select(F.max("feature_version")).scalar() if version is None else F.lit(version)
    out = stored.filter(F.col("feature_version") == latest)
    if entities is not None:
        out = out.join(entities.select(key), key, "left_semi")
    return out if features is None else out.select(key, *features)


def training_set(features: DataFrame, labels: DataFrame, key: str, label: str,
                 metadata: list[str] | None = None) -> DataFrame:
    """FEA-12: features joined with their label; rows without label are left out."""
    dropped = [c for c in ("feature_version",) if c in features.columns and c not in (metadata or [])]
    return features.drop(*dropped).join(labels.select(key, label, *(
        c for c in (metadata or []) if c in labels.columns and c not in features.columns)), key)


def lineage(registry: DataFrame) -> DataFrame:
    """FEA-13: one row per feature and source column: feature, source, category, version."""
    return registry.select("feature_name", F.explode("source_columns").alias("source_column"), "category", "version")


def classification_metrics(df: DataFrame, truth: str, predicted: str, classes: list) -> DataFrame:
    """FEA-23: precision, recall and F1 per class from one aggregation."""
    t, p = F.col(truth), F.col(predicted)
    cells = F.array(*[F.struct(F.lit(c).alias("class"), F.count_if((t == c) & (p == c)).alias("tp"),
                               F.count_if((t != c) & (p == c)).alias("fp"),
                               F.count_if((t == c) & (p != c)).alias("fn")) for c in classes])
    tp, fp, fn = F.col("tp").cast("double"), F.col("fp"), F.col("fn")
    return df.agg(cells.alias("_c")).select(F.inline("_c")).withColumns({
        "precision": F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)),
        "f1": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))})

"""Model and partition queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.operators import models as m
from strandlake.operators import performance as p
from strandlake.operators.sampling import split_by_key
from strandlake.plans.registry import query
from strandlake.session import spread

CATEGORICAL, NUMERIC = ["l_linestatus"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def labelled(t):
    """Line items with a label that depends on quantity and discount."""
    label = ((F.col("l_quantity") * F.col("l_discount") > 1.0) | (F.col("l_linenumber") == 7)).cast("double")
    return spread(t.lineitem).select("l_orderkey", "l_linenumber", *CATEGORICAL, *NUMERIC, label.alias("label"))


def parts(t):
    split = split_by_key(labelled(t), ["l_orderkey", "l_linenumber"], {"train": 0.8, "test": 0.2}, 42)
    return [split.filter(F.col("part") == x) for x in ("train", "test")]


@query("forest_confusion", "ML-01 ML-02")
def _(t):
    train, test = parts(t)
    model = m.fit_pipeline(train, CATEGORICAL, NUMERIC, "label")
    return m.confusion(model.transform(test), "label")


@query("forest_importances", "ML-01 ML-02")
def _(t):
    train, _test = parts(t)
    return m.importances(m.fit_pipeline(train, CATEGORICAL, NUMERIC, "label"), CATEGORICAL, NUMERIC, t.spark)


@query("cross_validated_auc", "ML-03")
def _(t):
    return m.cross_validated_auc(labelled(t), CATEGORICAL, NUMERIC, "label", ["logistic", "forest", "boosted"], folds=5)


@query("held_out_auc", "ML-01 ML-02")
def _(t):
    train, test = parts(t)
    rows = [(kind, m.area_under_curve(m.fit_pipeline(train, CATEGORICAL, NUMERIC, "label", kind).transform(test), "label")) for kind in ("logistic", "forest")]
    return t.spark.createDataFrame(rows, "model string, auc double")


@query("explained_share", "ML-04")
def _(t):
    long = t.embeddings.select("vec_id", F.posexplode("embedding").alias("dim", "v")).withColumn("v", F.col("v").cast("double") + 2)
    _scores, explained = m.principal_components(long, "vec_id", "dim", "v", 32, 2)
    return explained


@query("principal_components", "ML-04")
def _(t):
    long = t.embeddings.select("vec_id", F.posexplode("embedding").alias("dim", "v")).withColumn("v", F.col("v").cast("double") + 2)
    scores, _explained = m.principal_components(long, "vec_id", "dim", "v", 32, 2)
    return scores.select("vec_id", F.col("components")[0].alias("pc1"), F.col("components")[1].alias("pc2"))


@query("key_skew", "PRF-01", """
SELECT l_suppkey, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM lineitem) AS share FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(t):
    return p.key_skew(t.lineitem, "l_suppkey")


@query("partition_totals", "PRF-01 PRF-02", """
SELECT 16::BIGINT AS partitions, count(*)::BIGINT AS total, count(*) / 16.0::DOUBLE AS mean, true AS in_order, true AS even FROM lineitem""")
def _(t):
    out = p.partition_skew(p.by_range(t.lineitem, 16, "l_suppkey", "l_orderkey"))
    return out.select("partitions", "total", "mean", ((F.col("least") <= F.col("mean")) & (F.col("mean") <= F.col("greatest"))).alias("in_order"),
                      (F.col("skew") < 3).alias("even"))

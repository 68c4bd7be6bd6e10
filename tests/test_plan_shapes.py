"""Physical plans of the registered queries: what must and must not be in them."""

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from strandlake.operators.performance import plan_text
from strandlake.plans import all_queries
from strandlake.session import Tables

LAZY = [n for n, q in sorted(all_queries().items())
        if q.sql and not {"streamed", "landed"} & {n.split("_")[0]}
        and not set(q.operators) & {"GRF-03", "GRF-04", "GRF-07", "GRF-09", "JOIN-20", "ML-01"}]
# Queries whose result is itself a product of two sides, or a lookup in a written table of fixed size.
PRODUCTS = {"tier_range_join", "report_grid"}
# Queries of UDF-01 and UDF-02: a row function and a vectorised one are what they show, and compare with the built-in form.
PYTHON_IS_THE_FEATURE = {"row_function_classes", "variant_types_vectorised"}


@pytest.fixture(scope="module")
def plans(spark):
    tables = Tables(spark, DATA)
    return {n: plan_text(all_queries()[n].run(tables)) for n in LAZY}


def test_no_python_in_core_paths(plans):
    assert [n for n, p in plans.items() if ("EvalPython" in p or "InPandas" in p) and n not in PYTHON_IS_THE_FEATURE] == []


def test_no_cartesian_products(plans):
    assert [n for n, p in plans.items() if "CartesianProduct" in p and n not in PRODUCTS] == []


def test_filters_and_columns_reach_the_scan(plans):
    for name, column in (("nested_and_or", "p_size"), ("bound_parameters", "o_totalprice"), ("region_filter", "l_suppkey"),
                         ("anti_join", "o_totalprice"), ("star_topn", "l_quantity"), ("signal_sum", "o_orderstatus")):
        pushed = [x for x in plans[name].splitlines() if x.startswith("PushedFilters")]
        assert any(column in x for x in pushed), name
    schema = [x for x in plans["group_stats_pass_rate"].splitlines() if x.startswith("ReadSchema")][0]
    assert "l_shipdate" not in schema and "l_partkey" not in schema


def test_rank_filters_cut_before_the_shuffle(plans):
    for name in ("top3_per_group", "rank_filter", "top_brands_per_type"):
        assert "WindowGroupLimit" in plans[name], name


def test_groups_are_partially_aggregated(plans):
    for name in ("group_stats_pass_rate", "latest_per_group", "mode_per_group", "as_of", "duplicates_keep_best"):
        assert "partial_" in plans[name], name


def test_interval_join_is_an_equi_join(spark, plans):
    assert "BroadcastNestedLoopJoin" not in plans["interval_annotate"]
    assert "BroadcastNestedLoopJoin" not in plans["interval_overlaps"]


def test_large_sides_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = Tables(spark, DATA)
        for name in ("star_topn", "interval_annotate", "merge_upsert", "conditional_distinct", "running_stats", "tpm"):
            assert "BroadcastHashJoin" not in plan_text(all_queries()[name].run(tables)), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unpartitioned_windows_only_over_summaries(spark):
    """The numbering of a large table orders one row per partition globally, never the rows."""
    from strandlake.operators.windows import numbered
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    plan = plan_text(numbered(df, ["v"], "n"))
    assert plan.count("Window") >= 1 and "sum(_n" in plan

"""Time the headline queries and print one JSON line.

BENCH_SF_DIR    folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS      local cores (default 8)
BENCH_QUERIES   comma-separated names, or ``all`` (default: the headline list)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strandlake.operators.performance import run_all
from strandlake.plans import all_queries
from strandlake.session import Tables, build_session

HEADLINE = (
    "group_stats_pass_rate", "hard_filter_counts", "freq_class_pivot", "star_topn", "signal_sum", "conditional_distinct",
    "four_table_chain", "interval_annotate", "interval_overlaps", "anti_join", "row_vs_group_avg", "top3_per_group",
    "running_stats", "qoq_growth", "burden_percentile", "cohort_activity", "cohort_retention", "cooccurrence_pairs",
    "fold_change", "mode_per_group", "global_quantiles", "merge_upsert", "change_audit", "rule_report", "corr_pairs",
    "drift_two_batches", "impute_scale_onehot", "tpm", "quantile_norm", "kmer_top", "gc_like_content", "group_read_qc",
    "target_coverage", "vcf_rows", "ffl_count", "pagerank", "beta_div", "tumbling_counts",
)


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    queries = all_queries()
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if asked == "all" else asked.split(",") if asked else list(HEADLINE)
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, root)
    run_all(tables.lineitem.groupBy("l_returnflag").count())  # start the JVM's scan and shuffle code
    times = {}
    for name in names:
        start = time.perf_counter()
        try:
            run_all(queries[name].run(tables))
            times[name] = round(time.perf_counter() - start, 3)
        except Exception as error:  # keep the other measurements
            print(f"{name}: {str(error)[:300]}", file=sys.stderr)
            times[name] = None
        if os.environ.get("BENCH_VERBOSE"):
            print(name, times[name], file=sys.stderr, flush=True)
    done = [v for v in times.values() if v is not None]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(done), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(root).removeprefix("sf")}))


if __name__ == "__main__":
    main()

"""Projection, filter, sort, set and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions import clinical, text
from strandlake.functions.numeric import exact_mean, half_up, percent
from strandlake.operators import aggregates, filters, sampling, sets
from strandlake.plans.registry import exact_mean as MEAN
from strandlake.plans.registry import query



@query("select_alias_computed", "PRJ-01 PRJ-02 MTH-01", """
SELECT l_orderkey AS call_id, l_linenumber AS line, l_quantity * 2 + 1 AS span,
       abs(l_quantity - 25) AS off_centre, floor(l_quantity / 7) AS sevens
FROM lineitem""")
def _(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("call_id"), F.col("l_linenumber").alias("line"),
        (F.col("l_quantity") * 2 + 1).alias("span"), F.abs(F.col("l_quantity") - 25).alias("off_centre"),
        F.floor(F.col("l_quantity") / 7).cast("double").alias("sevens"))


@query("case_buckets", "PRJ-03 PRJ-04 AGG-02", """
SELECT CASE WHEN l_quantity >= 50 THEN 'HIGH' WHEN l_quantity >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS quality,
       CASE WHEN l_quantity BETWEEN 1 AND 10 THEN 'shallow' WHEN l_quantity BETWEEN 11 AND 30 THEN 'usual'
            ELSE 'deep' END AS depth_band, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def _(t):
    band = (F.when(F.col("l_quantity").between(1, 10), "shallow").when(F.col("l_quantity").between(11, 30), "usual").otherwise("deep"))
    return (t.lineitem.groupBy(clinical.quality_class(F.col("l_quantity")).alias("quality"), band.alias("depth_band"))
            .agg(F.count("*").alias("n")))


@query("freq_class_pivot", "PRJ-05 AGG-10 AGG-12", """
SELECT l_returnflag,
       count(*) FILTER (l_discount < 0.001) AS "Singleton",
       count(*) FILTER (l_discount >= 0.001 AND l_discount < 0.01) AS "Rare",
       count(*) FILTER (l_discount >= 0.01 AND l_discount < 0.05) AS "Low frequency",
       count(*) FILTER (l_discount >= 0.05 OR l_discount IS NULL) AS "Common"
FROM lineitem GROUP BY 1""")
def _(t):
    classed = t.lineitem.select("l_returnflag", clinical.frequency_class(F.col("l_discount")).alias("af_class"))
    return aggregates.pivot_counts(classed, "l_returnflag", "af_class",
                                   ["Singleton", "Rare", "Low frequency", "Common"])


@query("distinct_projection", "PRJ-06", "SELECT DISTINCT p_brand, p_type FROM part")
def _(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("melt_measures", "PRJ-07", """
SELECT l_orderkey, l_linenumber, 'depth' AS metric, l_quantity AS value FROM lineitem UNION ALL
SELECT l_orderkey, l_linenumber, 'frequency', l_discount FROM lineitem UNION ALL
SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem""")
def _(t):
    wide = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("depth"), F.col("l_discount").alias("frequency"),
                             F.col("l_tax").alias("tax"))
    return wide.unpivot(["l_orderkey", "l_linenumber"], ["depth", "frequency", "tax"], "metric", "value")


@query("renamed_columns", "PRJ-08", """
SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment FROM customer""")
def _(t):
    return t.customer.toDF(*[c.removeprefix("c_") for c in t.customer.columns])


@query("dimension_attributes", "PRJ-09 STR-03", """
SELECT DISTINCT p_type || '|' || p_brand AS part_key,
       CASE WHEN p_brand LIKE '%#1%' THEN 'Current generation' WHEN p_brand LIKE '%#2%' THEN 'Previous generation'
            ELSE 'Other' END AS tier,
       CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'Academic' WHEN p_type IN ('LARGE') THEN 'Commercial'
            ELSE 'Other' END AS kind
FROM part WHERE p_type IS NOT NULL""")
def _(t):
    kind = (F.when(F.col("p_type").isin("ECONOMY", "PROMO"), "Academic")
            .when(F.col("p_type").isin("LARGE"), "Commercial").otherwise("Other"))
    return (t.part.filter(F.col("p_type").isNotNull()).select("p_type", "p_brand").distinct()
            .select(text.natural_key(F.col("p_type"), F.col("p_brand")).alias("part_key"),
                    clinical.first_like(F.col("p_brand"), [("%#1%", "Current generation"),
                                                           ("%#2%", "Previous generation")], "Other").alias("tier"),
                    kind.alias("kind")))


PLATFORMS = ("Illumina NovaSeq X Plus", "Illumina NovaSeq 6000", "Illumina HiSeq 2500", "PacBio Sequel II", "Oxford Nanopore", "10x Genomics Chromium", "Other maker")
CENTRES = ("Broad Institute", "Sanger", "NIH", "BGI", "Illumina", "Elsewhere")
STRATEGIES, SOURCES = ("RNA-Seq", "WGS", "WES", "ATAC-seq", "AMPLICON"), ("TRANSCRIPTOMIC", "GENOMIC", "OTHER")


@query("platform_dimensions", "PRJ-09", f"""
WITH d AS (SELECT p_partkey, {list(PLATFORMS)}[p_partkey % 7 + 1] AS i, {list(CENTRES)}[p_partkey % 6 + 1] AS c, {list(STRATEGIES)}[p_size % 5 + 1] AS s,
    {list(SOURCES)}[p_partkey % 3 + 1] AS src, ['Homo sapiens', 'Mus musculus', 'Danio rerio'][p_size % 3 + 1] AS o, CASE WHEN p_size % 10 > 0 THEN 2010 + p_size % 15 END AS y FROM part)
SELECT p_partkey, CASE o WHEN 'Homo sapiens' THEN 'Human' WHEN 'Mus musculus' THEN 'Mouse' ELSE 'Other' END AS organism_group,
  coalesce(y >= 2022, false) AS is_recent, CASE WHEN c IN ('Broad Institute', 'Sanger', 'NIH') THEN 'Academic' WHEN c IN ('BGI', 'Illumina') THEN 'Commercial' ELSE 'Other' END AS center_type,
  CASE WHEN contains(i, '10x Genomics') THEN 'Single-cell RNA-seq' WHEN s = 'RNA-Seq' AND contains(src, 'TRANSCRIPTOMIC') THEN 'Bulk RNA-seq'
    WHEN s IN ('WGS', 'WES') AND src = 'GENOMIC' THEN 'DNA-seq' WHEN s IN ('ChIP-Seq', 'ATAC-seq', 'CUT&RUN') THEN 'Epigenomics' ELSE 'Other' END AS assay_category,
  CASE WHEN contains(i, 'NovaSeq X') THEN 'Current generation' WHEN contains(i, 'NovaSeq') THEN 'Previous generation' WHEN contains(i, 'HiSeq') THEN 'Legacy'
    WHEN contains(i, 'PacBio') OR contains(i, 'Nanopore') THEN 'Long-read' ELSE 'Other' END AS instrument_tier FROM d""")
def _(t):
    def one_of(names, place):
        return F.element_at(F.array(*[F.lit(n) for n in names]), (place % len(names) + 1).cast("int"))

    key, size = F.col("p_partkey"), F.col("p_size")
    rows = t.part.select(
        key, one_of(PLATFORMS, key).alias("instrument"), one_of(CENTRES, key).alias("centre"), one_of(STRATEGIES, size).alias("strategy"),
        one_of(SOURCES, key).alias("library"), one_of(("Homo sapiens", "Mus musculus", "Danio rerio"), size).alias("organism"),
        F.when(size % 10 > 0, size % 15 + 2010).alias("release_year"))
    return rows.select(
        "p_partkey", clinical.organism_group(F.col("organism")).alias("organism_group"), clinical.is_recent(F.col("release_year")).alias("is_recent"),
        clinical.center_type(F.col("centre")).alias("center_type"),
        clinical.assay_category(F.col("instrument"), F.col("strategy"), F.col("library")).alias("assay_category"),
        clinical.instrument_tier(F.col("instrument")).alias("instrument_tier"))


@query("rates_and_units", "PRJ-10 UDF-12 MTH-01", """
SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') / 365.25::DOUBLE AS years_ago,
       mapped * 100.0::DOUBLE / nullif(total, 0) AS mapping_rate,
       dup * 100.0::DOUBLE / nullif(mapped, 0) AS dup_of_mapped, dup * 100.0::DOUBLE / nullif(total, 0) AS dup_of_total
FROM (SELECT o_orderkey, o_orderdate, sum(l_quantity) AS total, sum(l_quantity) FILTER (l_returnflag <> 'R') AS mapped,
             sum(l_quantity) FILTER (l_returnflag = 'A') AS dup
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)""")
def _(t):
    runs = (t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("total"),
        F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))).alias("mapped"),
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("dup")))
    joined = t.orders.select("o_orderkey", "o_orderdate").join(runs, "o_orderkey")
    mapped, total, dup = F.col("mapped"), F.col("total"), F.col("dup")
    return joined.select(
        "o_orderkey",
        clinical.years_from_days(F.datediff(F.lit("2002-01-01").cast("date"), "o_orderdate")).alias("years_ago"),
        clinical.mapping_rate(mapped, total).alias("mapping_rate"),
        clinical.duplicate_rate_of_mapped(dup, mapped).alias("dup_of_mapped"),
        clinical.duplicate_rate_of_total(dup, total).alias("dup_of_total"))


def hard_rules():
    return {"qual": F.col("l_quantity") >= 30, "freq": F.col("l_discount") >= 0.02, "tax": F.col("l_tax") <= 0.06}


@query("hard_filter_counts", "FLT-01 FLT-02 FLT-03 FLT-12", """
WITH c AS (SELECT count(*) AS total, count(*) FILTER (l_quantity >= 30) AS q,
                  count(*) FILTER (l_discount >= 0.02) AS f, count(*) FILTER (l_tax <= 0.06) AS x,
                  count(*) FILTER (l_quantity >= 30 AND l_discount >= 0.02 AND l_tax <= 0.06) AS a FROM lineitem),
     r AS (SELECT total, 'qual' AS rule, q AS passed FROM c UNION ALL SELECT total, 'freq', f FROM c
           UNION ALL SELECT total, 'tax', x FROM c UNION ALL SELECT total, 'all', a FROM c)
SELECT rule, total, passed, total - passed AS removed, passed * 100.0::DOUBLE / total AS pass_rate FROM r""")
def _(t):
    return aggregates.pass_counts(t.lineitem, hard_rules())


@query("nested_and_or", "FLT-04 FLT-05 FLT-06 FLT-07 FLT-08", """
SELECT p_partkey, p_name, p_brand, p_size FROM part
WHERE p_size BETWEEN 5 AND 40 AND (p_name LIKE '%ring%' OR p_brand LIKE 'Brand#1%')
  AND p_type IN ('ECONOMY', 'PROMO', 'SMALL') AND p_retailprice IS NOT NULL""")
def _(t):
    return (t.part.filter(F.col("p_size").between(5, 40)
                          & (F.col("p_name").like("%ring%") | F.col("p_brand").like("Brand#1%"))
                          & F.col("p_type").isin("ECONOMY", "PROMO", "SMALL") & F.col("p_retailprice").isNotNull())
            .select("p_partkey", "p_name", "p_brand", "p_size"))


@query("null_safe_change", "FLT-09 WIN-04", """
SELECT event_id FROM (SELECT event_id, event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                      AS nxt FROM events) WHERE event_type IS DISTINCT FROM nxt""")
def _(t):
    from strandlake.operators.windows import with_next
    rows = with_next(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"],
                     None, {"nxt": "event_type"})
    return rows.filter(~F.col("event_type").eqNullSafe(F.col("nxt"))).select("event_id")


@query("bound_parameters", "FLT-10", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice >= 100000.0""")
def _(t):
    return filters.bound_filter(t.orders, "o_orderstatus = :status AND o_totalprice >= :least",
                                {"status": "F", "least": 100000.0}).select(
        "o_orderkey", "o_orderstatus", "o_totalprice")


@query("region_filter", "FLT-11", """
SELECT l_suppkey AS chrom, l_partkey AS pos, count(*) AS n FROM lineitem
WHERE (l_suppkey = 3 AND l_partkey BETWEEN 100 AND 900) OR l_suppkey = 7 GROUP BY 1, 2""")
def _(t):
    rows = t.lineitem.select(F.col("l_suppkey").alias("chrom"), F.col("l_partkey").alias("pos"))
    return filters.in_regions(rows, ["3:100-900", "7"]).groupBy("chrom", "pos").agg(F.count("*").alias("n"))


@query("swapped_interval_ends", "FLT-13", """
SELECT l_orderkey, l_linenumber, least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b
FROM lineitem""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"))
    return filters.ordered_ends(rows, "a", "b")


@query("silver_rules", "FLT-14 STR-04 FEA-22", """
SELECT l_orderkey, l_linenumber, flag, l_quantity, l_partkey FROM (
  SELECT l_orderkey, l_linenumber, upper(substr(s, 1, 1)) || lower(substr(s, 2)) AS flag, l_quantity, l_partkey,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS rn
  FROM (SELECT *, trim(' ' || l_returnflag || l_linestatus || ' ') AS s FROM lineitem
        WHERE l_quantity >= 10 AND l_discount > 0 AND l_returnflag <> l_linestatus))
WHERE rn = 1""")
def _(t):
    flag = text.title_case(F.concat(F.lit(" "), "l_returnflag", "l_linestatus", F.lit(" ")))
    rows = (t.lineitem.filter((F.col("l_quantity") >= 10) & (F.col("l_discount") > 0) & (F.col("l_returnflag") != F.col("l_linestatus")))
            .withColumn("flag", flag))
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    return (filters.one_per_key(rows.select("l_orderkey", "l_linenumber", "flag", *order),
                                ["l_orderkey", "l_linenumber"], order)
            .select("l_orderkey", "l_linenumber", "flag", "l_quantity", "l_partkey"))


@query("drop_sparse_matrix", "FLT-15", """
WITH m AS (SELECT user_id, event_type || '_' || (hour(ts) // 4) AS metric,
                  CASE WHEN avg(value) > 18 THEN count(*) END AS v FROM events GROUP BY 1, 2),
     c AS (SELECT metric FROM m GROUP BY 1 HAVING avg((v IS NULL)::INT) <= 0.5),
     k AS (SELECT * FROM m WHERE metric IN (SELECT metric FROM c)),
     r AS (SELECT user_id FROM k GROUP BY 1 HAVING avg((v IS NULL)::INT) <= 0.3)
SELECT user_id, metric, v FROM k WHERE user_id IN (SELECT user_id FROM r)""")
def _(t):
    metric = F.concat_ws("_", "event_type", F.floor(F.hour("ts") / 4).cast("string"))
    m = (t.events.groupBy("user_id", metric.alias("metric"))
         .agg(F.when(F.avg("value") > 18, F.count("*")).alias("v")))
    return filters.drop_sparse(m, "user_id", "metric", "v")


@query("joint_top_quartile", "FLT-16", """
WITH m AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend, count(*) AS n
           FROM orders GROUP BY 1)
SELECT o_custkey, spend, n FROM m WHERE spend >= (SELECT quantile_cont(spend, 0.75) FROM m)
  AND n >= (SELECT quantile_cont(n, 0.75) FROM m)""")
def _(t):
    from strandlake.functions.numeric import exact_sum
    m = t.orders.groupBy("o_custkey").agg(exact_sum("o_totalprice", 2).alias("spend"), F.count("*").alias("n"))
    return filters.joint_top_quartile(m, "spend", "n")


@query("reset_unsupported_calls", "FLT-17", """
SELECT CASE WHEN l_quantity < 30 THEN 'N' ELSE l_returnflag END AS call, count(*) AS n FROM lineitem GROUP BY 1""")
def _(t):
    rows = t.lineitem.select(F.col("l_returnflag").alias("call"), "l_quantity")
    return (filters.reset_unsupported(rows, "call", "l_quantity", 30, "N").groupBy("call")
            .agg(F.count("*").alias("n")))


@query("failed_rule_names", "FLT-02 DQ-01", """
SELECT array_to_string(list_filter([CASE WHEN NOT l_quantity >= 30 THEN 'qual' END,
         CASE WHEN NOT l_discount >= 0.02 THEN 'freq' END, CASE WHEN NOT l_tax <= 0.06 THEN 'tax' END],
         lambda x: x IS NOT NULL), ',') AS failed, count(*) AS n FROM lineitem GROUP BY 1""")
def _(t):
    return (filters.with_pass_flag(t.lineitem, hard_rules())
            .groupBy(F.array_join("failed_rules", ",").alias("failed")).agg(F.count("*").alias("n")))


@query("sorted_multi_key", "SRT-01 SRT-02", """
SELECT l_suppkey, n, mean_depth, 'chr' || l_suppkey AS chrom,
       CASE WHEN l_suppkey = 23 THEN 23 ELSE l_suppkey END::INT AS ord
FROM (SELECT l_suppkey, count(*) AS n, """ + MEAN("l_quantity", 2) + """ AS mean_depth FROM lineitem GROUP BY 1)
ORDER BY n DESC NULLS LAST, ord""")
def _(t):
    g = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"), exact_mean("l_quantity", 2).alias("mean_depth"))
    named = g.withColumn("chrom", F.concat(F.lit("chr"), F.col("l_suppkey").cast("string")))
    return (named.withColumn("ord", text.chromosome_order(F.col("chrom")))
            .orderBy(F.desc_nulls_last("n"), "ord"))


@query("top_orders", "SRT-03", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("bernoulli_sample", "SMP-01", """
SELECT o_orderkey, o_totalprice FROM orders WHERE ('0x' || substr(md5('42|' || o_orderkey), 1, 8))::BIGINT < 858993459""")
def _(t):
    return sampling.bernoulli(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 0.2, seed=42)


@query("hash_split", "SMP-02", """
SELECT CASE WHEN ('0x' || substr(md5('42|' || o_orderkey), 1, 8))::BIGINT < 3435973836 THEN 'train' ELSE 'test' END AS part,
       count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders GROUP BY 1""")
def _(t):
    split = sampling.split_by_key(t.orders, ["o_orderkey"], {"train": 0.8, "test": 0.2}, seed=42)
    return split.groupBy("part").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("lo"),
                                     F.max("o_orderkey").alias("hi"))


@query("stratified_split", "SMP-03", """
WITH h AS (SELECT o_orderkey, o_orderpriority, md5('42|' || o_orderkey) AS h FROM orders),
     r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY h, o_orderkey) AS rn,
                  count(*) OVER (PARTITION BY o_orderpriority) AS n FROM h)
SELECT o_orderpriority, part, count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM (
  SELECT o_orderpriority, o_orderkey, CASE WHEN rn <= floor(n * 0.6::DOUBLE + 0.5) THEN 'train'
         WHEN rn <= floor(n * 0.8::DOUBLE + 0.5) THEN 'valid' ELSE 'test' END AS part FROM r)
GROUP BY 1, 2""")
def _(t):
    split = sampling.stratified_split(t.orders.select("o_orderkey", "o_orderpriority"), ["o_orderkey"],
                                      ["o_orderpriority"], {"train": 0.6, "valid": 0.2, "test": 0.2}, seed=42)
    return split.groupBy("o_orderpriority", "part").agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


@query("union_by_name", "SET-01", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM (
  SELECT o_orderkey, o_orderstatus, NULL AS o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
  UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
GROUP BY 1, 2""")
def _(t):
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    old = t.orders.filter(cut).select("o_orderkey", "o_orderstatus")
    new = t.orders.filter(~cut).select("o_orderpriority", "o_orderkey", "o_orderstatus")
    return (sets.union_batches([old, new]).groupBy("o_orderstatus", "o_orderpriority")
            .agg(F.count("*").alias("n")))


@query("key_set_operations", "SET-02 SET-03 JOIN-23", """
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'),
     b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT 'both' AS side, k FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL
SELECT 'only_left', k FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL
SELECT 'only_right', k FROM (SELECT k FROM b EXCEPT SELECT k FROM a)""")
def _(t):
    a = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("k"))
    b = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("k"))
    return sets.compare_keys(a, b, "k")

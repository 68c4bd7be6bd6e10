"""Text-format queries: the tables are written as genomics text by Spark and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions.numeric import half_up
from strandlake.functions.variant import info_field, info_flag
from strandlake.operators import coverage as cov
from strandlake.plans.registry import half_up as HU
from strandlake.plans.registry import query
from strandlake.plans.scalars import SEQ_SQL, qual_of, seq_of
from strandlake.sources import genomics as g
from strandlake.session import scratch_path, spread
from strandlake.sources import sinks, tabular

NAMES = [*g.VCF_COLUMNS, "FORMAT", "S1"]


def vcf_lines(t):
    """Line items as variant lines; every tenth quality is a dot."""
    alt = F.when(F.col("l_linenumber") % 3 == 0, "AT,G").when(F.col("l_linenumber") % 3 == 1, "C").otherwise(".")
    qual = F.when(F.col("l_quantity") % 10 == 0, ".").otherwise(F.col("l_quantity").cast("string"))
    info = F.concat(F.lit("DP="), F.col("l_quantity").cast("int").cast("string"), F.lit(";AF="),
                    F.col("l_discount").cast("string"), F.when(F.col("l_tax") > 0.04, ";DB").otherwise(""))
    sample = F.concat(F.lit("0/1:"), F.col("l_linenumber").cast("string"))
    return spread(t.lineitem).select(F.concat_ws(
        "\t", F.concat(F.lit("chr"), F.col("l_suppkey").cast("string")), F.col("l_partkey").cast("string"), F.lit("."),
        F.lit("A"), alt, qual, F.when(F.col("l_returnflag") == "N", "PASS").otherwise("LowQual"), info, F.lit("GT:DP"),
        sample).alias("value"))


@query("vcf_rows", "SRC-10 STR-08 QC-17", """
SELECT 'chr' || l_suppkey AS chrom, count(*) AS n, count(CASE WHEN l_quantity % 10 <> 0 THEN 1 END) AS with_quality,
  sum(l_quantity)::BIGINT AS depth, count(*) FILTER (l_tax > 0.04) AS flagged FROM lineitem GROUP BY 1""")
def _(t):
    rows = g.vcf_rows(vcf_lines(t), NAMES, with_map=False)
    info = F.col("INFO")
    return rows.groupBy(F.col("CHROM").alias("chrom")).agg(
        F.count("*").alias("n"), F.count("QUAL").alias("with_quality"),
        F.sum(info_field(info, "DP").cast("bigint")).alias("depth"), F.count_if(info_flag(info, "DB")).alias("flagged"))


@query("vcf_summary", "QC-17 STR-09", """
SELECT 'total' AS metric, '' AS value, count(*) AS n FROM lineitem UNION ALL
SELECT 'chromosome', 'chr' || l_suppkey, count(*) FROM lineitem GROUP BY 2 UNION ALL
SELECT 'type', CASE l_linenumber % 3 WHEN 0 THEN 'INSERTION,SNP' WHEN 1 THEN 'SNP' ELSE 'NO_VARIATION' END, count(*) FROM lineitem GROUP BY 2 UNION ALL
SELECT 'filter', CASE WHEN l_returnflag = 'N' THEN 'PASS' ELSE 'LowQual' END, count(*) FROM lineitem GROUP BY 2""")
def _(t):
    return cov.variant_summary(g.vcf_rows(vcf_lines(t), NAMES))


@query("vcf_file", "SRC-10 QC-17", """
SELECT 'source' AS metric, 'made' AS value, 1 AS n UNION ALL SELECT 'contig', '<ID=chr1>', 1 UNION ALL SELECT 'contig', '<ID=chr2>', 1
UNION ALL SELECT 'samples', 'S1', 1 UNION ALL SELECT 'rows', '', count(*) FROM lineitem
UNION ALL SELECT 'genotypes', key, count(*) FROM lineitem, (VALUES ('GT'), ('DP')) AS k(key) GROUP BY 2""")
def _(t):
    """A file with metadata, header and sample column, read whole."""
    head = ["##source=made", "##contig=<ID=chr1>", "##contig=<ID=chr2>", "#" + "\t".join(NAMES)]
    path = scratch_path(t.spark, "variants")
    sinks.write_text(t.spark.createDataFrame([(x,) for x in head], "value string").unionByName(vcf_lines(t)), path)
    file = g.read_vcf(t.spark, path)
    found = file.metadata.select(F.col("key").alias("metric"), "value", F.lit(1).cast("bigint").alias("n"))
    samples = t.spark.createDataFrame([("samples", s, 1) for s in file.samples], found.schema)
    rows = file.rows.agg(F.lit("rows").alias("metric"), F.lit("").alias("value"), F.count("*").alias("n"))
    calls = g.genotypes(file).groupBy(F.lit("genotypes").alias("metric"), F.col("key").alias("value")).agg(F.count("*").alias("n"))
    return found.unionByName(samples).unionByName(rows).unionByName(calls)


@query("vcf_genotypes", "SRC-10", """
SELECT key, value, count(*) AS n FROM (SELECT 'GT' AS key, '0/1' AS value FROM lineitem UNION ALL
  SELECT 'DP', l_linenumber::VARCHAR FROM lineitem) GROUP BY 1, 2""")
def _(t):
    variants = g.Variants(g.vcf_rows(vcf_lines(t), NAMES), t.nation, ["S1"])
    return g.genotypes(variants).groupBy("key", "value").agg(F.count("*").alias("n"))


@query("fastq_round_trip", "SRC-11 SNK-06 SEQ-02", f"""
SELECT CASE WHEN doc_id % 2 = 0 THEN 'READ' ELSE '7.x/' END || doc_id AS read_id, length({SEQ_SQL})::INT AS bases FROM documents""")
def _(t):
    # two families of ids, and every fourth quality line starts with @
    family = F.when(F.col("doc_id") % 2 == 0, "READ").otherwise("7.x/")
    qual = F.when(F.col("doc_id") % 4 == 0, F.regexp_replace(qual_of(), "^.", "@")).otherwise(qual_of())
    rows = t.documents.select(F.concat(family, F.col("doc_id").cast("string")).alias("read_id"), seq_of().alias("seq"), qual.alias("qual"))
    path = scratch_path(t.spark, "reads")
    sinks.write_text(sinks.fastq_text(spread(rows)), path)
    back = g.read_fastq(t.spark, path)
    return back.select("read_id", F.when(F.length("seq") == F.length("qual"), F.length("seq")).alias("bases"))


@query("fasta_round_trip", "SRC-12 SNK-06 SEQ-01", f"""
WITH s AS (SELECT doc_id, {SEQ_SQL} AS s FROM documents)
SELECT 'seq' || doc_id AS id, length(s)::INT AS length,
  {HU("coalesce(length(regexp_replace(s, '[^GC]', '', 'g'))::DOUBLE / nullif(length(s), 0), 0) * 100", 9)} AS gc_content FROM s""")
def _(t):
    rows = spread(t.documents.select("doc_id", "text")).select(F.concat(F.lit("seq"), F.col("doc_id").cast("string")).alias("id"), seq_of().alias("seq"))
    path = scratch_path(t.spark, "sequences")
    sinks.write_text(sinks.fasta_text(rows), path)
    back = g.read_fasta(t.spark, path)
    return back.select("id", "length", half_up(F.col("gc_content"), 9).alias("gc_content"))


def sam_lines(t):
    flag = F.when(F.col("l_linestatus") == "F", 16).when(F.col("l_linenumber") == 7, 4).otherwise(0)
    cigar = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("M2I3D"))
    return spread(t.lineitem).select(F.concat_ws(
        "\t", F.concat(F.lit("r"), F.col("l_orderkey").cast("string")), flag.cast("string"),
        F.concat(F.lit("chr"), F.col("l_suppkey").cast("string")), F.col("l_partkey").cast("string"),
        (F.col("l_quantity").cast("int") % 61).cast("string"), cigar, F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGTGG"), F.lit("IIIIII"),
        F.concat(F.lit("NM:i:"), F.col("l_linenumber").cast("string")),
        F.concat(F.lit("AS:i:"), F.col("l_quantity").cast("int").cast("string"))).alias("value"))


@query("sam_statistics", "SRC-13 QC-14", f"""
SELECT count(*) AS alignments, (count(*) FILTER (NOT (l_linestatus <> 'F' AND l_linenumber = 7))) * 100.0::DOUBLE / count(*) AS mapped_pct,
  {HU('avg(l_quantity::INT % 61)', 6)} AS mean_mapq, 6.0::DOUBLE AS mean_length, (count(*) FILTER (l_linestatus = 'F')) * 100.0::DOUBLE / count(*) AS reverse_pct,
  {HU('avg(l_linenumber)', 6)} AS mean_edit_distance, {HU('avg(l_quantity::INT)', 6)} AS mean_score, {HU('400.0 / 6', 6)} AS gc_pct FROM lineitem""")
def _(t):
    path = scratch_path(t.spark, "alignments")
    sinks.write_text(sam_lines(t), path)
    out = cov.alignment_statistics(g.read_sam(t.spark, path))
    return out.withColumns({c: half_up(F.col(c), 6) for c in ("mean_mapq", "mean_edit_distance", "mean_score", "gc_pct")})


@query("sam_spans", "SRC-13", """
SELECT l_suppkey AS chrom, min(l_partkey - 1)::INT AS first_start, max(l_partkey - 1 + l_quantity::INT + 3)::INT AS last_end FROM lineitem GROUP BY 1""")
def _(t):
    rows = g.sam_rows(sam_lines(t))
    return rows.groupBy(F.expr("substring(chrom, 4)").cast("bigint").alias("chrom")).agg(
        F.min("start").alias("first_start"), F.max("end").alias("last_end"))


@query("rows_per_file", "SRC-03 SRC-04", """
SELECT 'orders.parquet' AS file_name, count(*) AS n FROM orders UNION ALL SELECT 'customer.parquet', count(*) FROM customer""")
def _(t):
    return tabular.rows_per_file(t.orders).unionByName(tabular.rows_per_file(t.customer))


@query("drifting_files", "SRC-05 SET-01", """
SELECT count(*) AS n, count(o_orderkey) AS orders, count(c_custkey) AS customers FROM (
  SELECT o_orderkey, NULL::BIGINT AS c_custkey FROM orders UNION ALL SELECT NULL, c_custkey FROM customer)""")
def _(t):
    both = tabular.read_drifting(t.spark, f"{t.root}/orders.parquet", f"{t.root}/customer.parquet")
    return both.agg(F.count("*").alias("n"), F.count("o_orderkey").alias("orders"), F.count("c_custkey").alias("customers"))


@query("file_layout", "SNK-08", None)
def _(t):
    return sinks.layout_report({"orders": t.orders, "lineitem": t.lineitem})


@query("client_rows_join", "SRC-14 SRC-16", """
SELECT label, count(*) AS n FROM orders JOIN (VALUES ('F', 'final'), ('O', 'open')) v(code, label) ON o_orderstatus = code GROUP BY 1""")
def _(t):
    tabular.client_table(t.spark, [("F", "final"), ("O", "open")], "client_status", "code string, label string")
    return t.spark.sql("SELECT label, count(*) AS n FROM {orders} JOIN client_status ON o_orderstatus = code GROUP BY 1",
                       orders=t.orders)


@query("partitioned_round_trip", "SNK-03 SRC-08", """
SELECT o_orderpriority, count(*) AS n, min(o_orderkey) AS lo FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""")
def _(t):
    path = scratch_path(t.spark, "partitioned")
    sinks.write_partitioned(t.orders, path, ["o_orderstatus"], files_per_key=4)
    back = tabular.read_partitioned(t.spark, path)
    return (back.filter(F.col("o_orderstatus") == "F").groupBy("o_orderpriority")
            .agg(F.count("*").alias("n"), F.min("o_orderkey").alias("lo")))


@query("csv_round_trip", "SRC-01 SRC-07 SNK-02", """
SELECT c_mktsegment, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM customer
WHERE c_acctbal > 100 GROUP BY 1""")
def _(t):
    path = scratch_path(t.spark, "customers")
    sinks.write_delimited(t.customer, path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    text = """SELECT c_mktsegment, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
              FROM {file} WHERE c_acctbal > :least GROUP BY c_mktsegment"""
    return tabular.query_csv(t.spark, path, text, schema, {"least": 100})


@query("interval_file_round_trip", "SRC-02 SNK-02", """
SELECT 'chr' || (p_partkey % 25) AS chrom, count(*) AS n, sum(p_size)::BIGINT AS bases FROM part GROUP BY 1""")
def _(t):
    path = scratch_path(t.spark, "genes")
    key, size = F.col("p_partkey"), F.col("p_size")
    lines = t.part.select(F.concat_ws("\t", F.concat(F.lit("chr"), (key % 25).cast("string")), (key * 3).cast("string"),
                                      (key * 3 + size).cast("string"), F.concat(F.lit("g"), key.cast("string")), F.lit("+")).alias("value"))
    sinks.write_text(lines, path)
    return (tabular.read_bed(t.spark, path).groupBy("chrom")
            .agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bases")))


@query("compacted_table", "SNK-01 SNK-09", """
SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS depth FROM lineitem GROUP BY 1""")
def _(t):
    small, large = scratch_path(t.spark, "many-files"), scratch_path(t.spark, "few-files")
    sinks.write_parquet(t.lineitem.repartition(16), small, sort_by=["l_suppkey", "l_partkey"])
    sinks.compact(t.spark, small, large)
    return (tabular.read_parquet(t.spark, large).groupBy("l_returnflag")
            .agg(F.count("*").alias("n"), F.sum("l_quantity").alias("depth")))

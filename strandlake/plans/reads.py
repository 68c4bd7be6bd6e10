"""Read, coverage and assembly queries over documents read as sequences and line items read as alignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions import sequence as sq
from strandlake.functions.numeric import half_up
from strandlake.operators import coverage as cov
from strandlake.operators import reads as r
from strandlake.plans.registry import half_up as HU
from strandlake.plans.registry import query
from strandlake.plans.scalars import LETTERS, QUALS, SEQ_SQL, qual_of, seq_of
from strandlake.session import spread

ADAPTER = "ACGACA"
QUAL_SQL = f"translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{LETTERS}', '{QUALS[:26]}')"
READS = f"""r AS (SELECT doc_id, lang, source, {SEQ_SQL} AS seq, {QUAL_SQL} AS qual FROM documents),
   c AS (SELECT doc_id, unnest(string_split(qual, '')) AS c FROM r WHERE qual <> ''),
   m AS (SELECT doc_id, sum(ascii(c) - 33) AS qsum, count(*) AS qn FROM c GROUP BY 1),
   q AS (SELECT r.*, qsum, qsum::DOUBLE / qn AS mq FROM r LEFT JOIN m USING (doc_id))"""


def reads(t):
    rows = spread(t.documents.select("doc_id", "lang", "source", "text"))
    return rows.select("doc_id", F.concat(F.lit("r"), F.col("doc_id").cast("string"), F.lit(":batch"),
                                                 (F.col("doc_id") % 5).cast("string")).alias("read_id"),
                              "lang", "source", seq_of().alias("seq"), qual_of().alias("qual"))


@query("group_read_qc", "QC-01 AGG-23", f"""
WITH {READS} SELECT lang, count(*) AS total_reads, sum(length(seq))::BIGINT AS total_bases, sum(length(seq))::DOUBLE / count(*) AS avg_length,
  {HU('sum(coalesce(mq, 0)) / count(*)', 6)} AS avg_quality, sum(length(seq) - length(replace(seq, 'N', '')))::BIGINT AS n_bases,
  count(*) FILTER (mq < 20) AS low_quality_reads, count(*) FILTER (contains(seq, '{ADAPTER}')) AS adapter_reads,
  (count(*) FILTER (mq < 20)) * 100.0::DOUBLE / count(*) AS low_quality_pct,
  (count(*) FILTER (contains(seq, '{ADAPTER}'))) * 100.0::DOUBLE / count(*) AS adapter_pct FROM q GROUP BY 1""")
def _(t):
    out = r.group_read_qc(reads(t), ["lang"], ADAPTER)
    return out.withColumn("avg_quality", half_up(F.col("avg_quality"), 6))


TRIM = f"""a AS (SELECT *, CASE WHEN strpos(seq, '{ADAPTER}') > 0 THEN substr(seq, 1, strpos(seq, '{ADAPTER}') - 1) ELSE seq END AS s FROM r),
   b AS (SELECT *, substr(qual, 1, length(s)) AS q FROM a),
   d AS (SELECT doc_id, unnest(string_split(q, '')) AS c FROM b WHERE q <> ''),
   e AS (SELECT doc_id, avg(ascii(c) - 33) AS mq2 FROM d GROUP BY 1),
   t AS (SELECT b.*, mq2, rtrim(q, '!"#$%&''()*+,-./01234') AS tq FROM b LEFT JOIN e USING (doc_id)),
   z AS (SELECT *, CASE WHEN contains(s, 'N') THEN 'n_filtered' WHEN length(s) < 20 THEN 'length_filtered'
         WHEN mq2 < 20 THEN 'quality_filtered' WHEN length(tq) < 20 THEN 'length_filtered' ELSE 'passed' END AS reason FROM t)"""


@query("trim_counters", "QC-02 SEQ-04 SEQ-05", f"""
WITH {READS}, {TRIM} SELECT lang, count(*) AS total_input, count(*) FILTER (length(s) < length(seq)) AS adapter_trimmed,
  count(*) FILTER (reason = 'n_filtered') AS n_filtered, count(*) FILTER (reason = 'length_filtered') AS length_filtered,
  count(*) FILTER (reason = 'quality_filtered') AS quality_filtered, count(*) FILTER (reason = 'passed') AS passed FROM z GROUP BY 1""")
def _(t):
    return r.trim_counters(r.trimmed_reads(reads(t), ADAPTER, min_length=20), ["lang"])


@query("before_after_trim", "QC-05 SRT-02", f"""
WITH {READS}, {TRIM} SELECT source, count(*) AS before, count(*) FILTER (reason = 'passed') AS after,
  (count(*) FILTER (reason = 'passed')) * 100.0::DOUBLE / count(*) AS kept_pct FROM z GROUP BY 1""")
def _(t):
    counters = r.trim_counters(r.trimmed_reads(reads(t), ADAPTER, min_length=20), ["source"])
    initial = t.documents.groupBy("source").agg(F.count("*").alias("total_reads"))  # counted before anything is trimmed
    return r.before_after(initial, counters, "source", F.regexp_extract("source", r"(\d+)", 1).cast("int"))


@query("position_quality", "QC-03 AGG-23", f"""
WITH {READS}, p AS (SELECT doc_id, qual, unnest(range(1, length(qual) + 1)) AS i FROM r),
  s AS (SELECT i - 1 AS position, ascii(substr(qual, i, 1)) - 33 AS score FROM p)
SELECT position::INT AS position, count(*) AS n, sum(score)::DOUBLE / count(*) AS mean_quality, quantile_cont(score, 0.25) AS q25,
  quantile_cont(score, 0.75) AS q75 FROM s GROUP BY 1""")
def _(t):
    return r.position_quality(reads(t))


@query("quality_histogram", "QC-04", f"""
WITH {READS} SELECT floor(mq / 2.0) * 2.0::DOUBLE AS bin, count(*) AS n FROM q WHERE mq IS NOT NULL GROUP BY 1""")
def _(t):
    return r.histogram(reads(t), sq.phred_mean(F.col("qual")), 2)


@query("length_gc_histograms", "QC-04", f"""
WITH {READS} SELECT 'length' AS metric, floor(length(seq) / 100.0) * 100.0::DOUBLE AS bin, count(*) AS n FROM r GROUP BY 2 UNION ALL
SELECT 'gc', floor(coalesce(length(regexp_replace(seq, '[^GC]', '', 'g'))::DOUBLE / nullif(length(seq), 0), 0) / 0.05::DOUBLE) * 0.05::DOUBLE, count(*) FROM r GROUP BY 2""")
def _(t):
    rows = reads(t)
    lengths = r.histogram(rows, F.length("seq").cast("double"), 100).withColumn("metric", F.lit("length"))
    gc = r.histogram(rows, sq.gc_fraction(F.col("seq")), 0.05).withColumn("metric", F.lit("gc"))
    return lengths.unionByName(gc)


@query("q30_rate", "QC-04", f"""
WITH {READS} SELECT (count(*) FILTER (mq >= 30)) * 100.0::DOUBLE / count(*) AS q30_rate FROM q""")
def _(t):
    return r.q30_rate(reads(t))


def rule_sql(name, length, quality, share):
    return f"""SELECT '{name}' AS rules, count(*) AS total_reads, sum(length(kq))::DOUBLE / count(*) AS avg_length,
      sum(length(regexp_replace(substr(seq, 1, length(kq)), '[^GC]', '', 'g')))::DOUBLE / sum(length(kq)) AS avg_gc,
      sum((SELECT sum(ascii(x) - 33) FROM (SELECT unnest(string_split(kq, '')) AS x)))::DOUBLE / sum(length(kq)) AS avg_quality
    FROM (SELECT *, rtrim(qual, '!"#$%&''()*+,-./') AS kq FROM q WHERE length(seq) >= {length} AND mq >= {quality}
          AND (length(seq) - length(replace(seq, 'N', '')))::DOUBLE / nullif(length(seq), 0) <= {share}) WHERE length(kq) > 0"""


@query("strict_and_lenient", "QC-06 FLT-12 STM-10", f"""
WITH {READS} {rule_sql('strict', 200, 18, 0.06)} UNION ALL {rule_sql('lenient', 50, 15, 0.2)}""")
def _(t):
    return r.compare_rules(reads(t), {"strict": {"min_length": 200, "min_quality": 18, "max_n": 0.06},
                                      "lenient": {"min_length": 50, "min_quality": 15, "max_n": 0.2}})


def mates(t):
    rows = reads(t)
    first = rows.select(F.concat("read_id", F.lit("/1")).alias("read_id"), "seq", "qual")
    second = rows.filter(F.col("doc_id") % 9 != 0).select(
        F.concat("read_id", F.lit("/2")).alias("read_id"), sq.reverse_complement(F.col("seq")).alias("seq"),
        F.reverse("qual").alias("qual"))
    return first, second


@query("paired_filter", "QC-08 JOIN-19", f"""
WITH {READS} SELECT count(*) AS pairs, sum(length(seq))::BIGINT AS bases FROM q WHERE doc_id % 9 <> 0 AND mq >= 17 AND length(seq) >= 100""")
def _(t):
    first, second = mates(t)
    keep = (sq.phred_mean(F.col("qual")) >= 17) & (F.length("seq") >= 100)
    return r.paired_filter(first, second, keep).agg(F.count("*").alias("pairs"),
                                                    F.sum(F.length("seq1").cast("bigint")).alias("bases"))


@query("read_report", "QC-07", f"""
WITH {READS}, k AS (SELECT doc_id, length(seq) AS len, length(regexp_replace(seq, '[^GC]', '', 'g')) AS gc, qsum, length(seq) >= 100 AND mq >= 17 AND coalesce((length(seq) - length(replace(seq, 'N', '')))::DOUBLE / nullif(length(seq), 0), 0) <= 0.1 AS ok FROM q)
SELECT stage, count(*) AS total_reads, """ + ", ".join(HU(c, 6) + f" AS {n}" for n, c in (
    ("avg_length", "sum(len)::DOUBLE / count(*)"), ("avg_gc", "sum(gc)::DOUBLE / sum(len)"), ("avg_quality", "sum(qsum)::DOUBLE / sum(len)"))) + """
FROM (SELECT 'raw_1' AS stage, * FROM k UNION ALL SELECT 'raw_2', * FROM k WHERE doc_id % 9 <> 0 UNION ALL
  SELECT 'filtered_1', * FROM k WHERE ok UNION ALL SELECT 'filtered_2', * FROM k WHERE ok AND doc_id % 9 <> 0) GROUP BY 1
UNION ALL SELECT 'pairs_kept', count(*) FILTER (ok AND doc_id % 9 <> 0), NULL, NULL, NULL FROM k""")
def _(t):
    first, second = mates(t)
    return r.read_report(first, second, 100, 17, 0.1).select("stage", "total_reads", *[
        half_up(F.col(c), 6).alias(c) for c in ("avg_length", "avg_gc", "avg_quality")])


@query("mate_mismatches", "JOIN-19", "SELECT count(*) AS n FROM documents WHERE doc_id % 9 = 0")
def _(t):
    from strandlake.operators.joins import mate_mismatches
    return mate_mismatches(*mates(t)).agg(F.count("*").alias("n"))


@query("adapter_rate", "QC-09", f"""
WITH {READS} SELECT (count(*) FILTER (contains(seq, 'ACGAC'))) * 100.0::DOUBLE / count(*) AS adapter_pct FROM r""")
def _(t):
    return r.adapter_rate(reads(t), ADAPTER, 5)


@query("batch_quality", "QC-10", f"""
WITH {READS} SELECT (doc_id % 5)::VARCHAR AS batch, count(*) AS num_reads, {HU('avg(mq)', 6)} AS mean_quality,
  {HU('stddev_pop(mq)', 6)} AS std_quality FROM q GROUP BY 1""")
def _(t):
    out = r.batch_quality(reads(t))
    return out.withColumns({c: half_up(F.col(c), 6) for c in ("mean_quality", "std_quality")})


@query("sequence_lookup", "QC-16", """
SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND contains(source, '1')""")
def _(t):
    good = t.labels.filter(F.col("quality") == 1).select("doc_id")
    return r.find(r.lookup(t.documents.select("doc_id", "source"), good, "doc_id"), "1", "source").select("doc_id")


def targets(t):
    k = F.col("s_suppkey")
    return t.supplier.select(k.alias("target"), k.alias("chrom"), (k * 13 % 500).alias("start"),
                             (k * 13 % 500 + 200).alias("end"))


def alignments(t):
    start = F.col("l_partkey")
    return t.lineitem.select(F.col("l_suppkey").alias("chrom"), start.alias("start"),
                             (start + F.col("l_quantity").cast("bigint")).alias("end"))


DEPTH = """g AS (SELECT s_suppkey AS target, unnest(range(s_suppkey * 13 % 500, s_suppkey * 13 % 500 + 200)) AS pos FROM supplier),
   a AS (SELECT l_suppkey AS target, unnest(range(l_partkey, l_partkey + l_quantity::BIGINT)) AS pos FROM lineitem),
   c AS (SELECT target, pos, count(*) AS n FROM a GROUP BY 1, 2),
   d AS (SELECT g.target, g.pos, coalesce(n, 0) AS depth FROM g LEFT JOIN c USING (target, pos))"""


@query("target_coverage", "QC-11", f"""
WITH {DEPTH} SELECT target, count(*) AS positions, sum(depth)::DOUBLE / count(*) AS mean_coverage, min(depth) AS min_coverage, max(depth) AS max_coverage,
  {HU('coalesce(stddev_pop(depth) * 100.0 / nullif(avg(depth), 0), 0)', 6)} AS cv_pct, (count(*) FILTER (depth >= 20)) * 100.0::DOUBLE / count(*) AS pct_20x,
  (count(*) FILTER (depth >= 100)) * 100.0::DOUBLE / count(*) AS pct_100x, (count(*) FILTER (depth >= 500)) * 100.0::DOUBLE / count(*) AS pct_500x,
  quantile_cont(depth, 0.5)::DOUBLE AS median_coverage FROM d GROUP BY 1""")
def _(t):
    out = cov.coverage_statistics(cov.depth_runs(targets(t), alignments(t), 128))
    return out.withColumn("cv_pct", half_up(F.col("cv_pct"), 6))


@query("depth_steps", "QC-11 WIN-03", """
WITH e AS (SELECT l_suppkey AS chrom, l_partkey AS pos, 1 AS d FROM lineitem UNION ALL SELECT l_suppkey, l_partkey + l_quantity::BIGINT, -1 FROM lineitem),
  s AS (SELECT chrom, pos, sum(d) AS d FROM e GROUP BY 1, 2)
SELECT chrom, pos, (sum(d) OVER (PARTITION BY chrom ORDER BY pos))::BIGINT AS depth FROM s""")
def _(t):
    from strandlake.operators.intervals import covered_depth
    return covered_depth(alignments(t), 128)


@query("duplicate_rate", "QC-12 WIN-15", """
WITH k AS (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey, l_suppkey, l_linestatus)
SELECT sum(n)::BIGINT AS total, sum(n - 1)::BIGINT AS duplicates, sum(n - 1)::BIGINT * 100.0::DOUBLE / sum(n)::BIGINT AS duplicate_rate FROM k""")
def _(t):
    return cov.duplicate_rate(t.lineitem, ["l_partkey", "l_suppkey", "l_linestatus"])


@query("contamination", "QC-13", """
WITH c AS (SELECT l_suppkey, floor(l_quantity / 10) AS b, count(*) AS n FROM lineitem GROUP BY 1, 2),
  s AS (SELECT l_suppkey, sum(n) AS depth, max(n) FILTER (rn = 2) AS second FROM
        (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC) AS rn FROM c) GROUP BY 1),
  m AS (SELECT second::DOUBLE / depth::DOUBLE AS share FROM s WHERE depth >= 100)
SELECT count(*) AS sites, """ + HU("coalesce(quantile_cont(share, 0.5), 0) * 100", 6) + """ AS contamination_pct FROM m WHERE share > 0.02 AND share < 0.40""")
def _(t):
    rows = t.lineitem.select("l_suppkey", F.floor(F.col("l_quantity") / 10).alias("b"))
    out = cov.contamination(rows, ["l_suppkey"], "b")
    return out.withColumn("contamination_pct", half_up(F.col("contamination_pct"), 6))


def contigs(t):
    return spread(t.documents.select("lang", "text")).select("lang", seq_of().alias("seq")).select(
        "lang", F.length("seq").alias("length"), (sq.gc_fraction(F.col("seq")) * 100).alias("gc_content"))


CONTIGS = f"""k AS (SELECT lang, length(s) AS length, coalesce(length(regexp_replace(s, '[^GC]', '', 'g'))::DOUBLE / nullif(length(s), 0), 0) * 100 AS gc
   FROM (SELECT lang, {SEQ_SQL} AS s FROM documents))"""


@query("assembly_qc", "QC-15", f"""
WITH {CONTIGS}, o AS (SELECT lang, length, sum(length) OVER (PARTITION BY lang ORDER BY length DESC) AS upto, sum(length) OVER (PARTITION BY lang) AS total FROM k),
  n AS (SELECT lang, max(length)::INT AS n50 FROM o WHERE upto >= total * 0.5 GROUP BY 1)
SELECT lang, count(*) AS sequences, sum(length)::BIGINT AS total_bases, max(length)::INT AS longest, min(length)::INT AS shortest,
  sum(length)::DOUBLE / count(*) AS mean_length, count(*) FILTER (length < 500) AS short, count(*) FILTER (gc < 20 OR gc > 80) AS extreme_gc,
  {HU('corr(length, gc)', 6)} AS length_gc_corr, any_value(n50) AS n50, quantile_cont(length, 0.5)::DOUBLE AS median_length FROM k JOIN n USING (lang) GROUP BY 1""")
def _(t):
    out = cov.assembly_qc(contigs(t), ["lang"])
    return out.withColumn("length_gc_corr", half_up(F.col("length_gc_corr"), 6))


@query("size_libraries", "QC-15 PRJ-03", f"""
WITH {CONTIGS} SELECT lang, CASE WHEN length < 500 THEN 'very_short' WHEN length < 2000 THEN 'short' WHEN length < 5000 THEN 'medium' ELSE 'long' END AS size_class,
  count(*) AS sequences, sum(length)::BIGINT AS total_bases FROM k GROUP BY 1, 2""")
def _(t):
    return cov.size_libraries(contigs(t), ["lang"])


@query("longest_sequences", "SRT-04", f"""
WITH s AS (SELECT doc_id, length({SEQ_SQL})::INT AS length FROM documents) SELECT doc_id, length FROM s ORDER BY length DESC, doc_id""")
def _(t):
    return (spread(t.documents.select("doc_id", "text")).select("doc_id", F.length(seq_of()).alias("length")).orderBy(F.desc("length"), "doc_id"))


@query("insert_size_histogram", "SEQ-15", f"""
WITH s AS (SELECT item_id, {SEQ_SQL} AS a FROM benchmark), p AS (SELECT item_id, a, substr(a, 31) AS b, length(a) AS l FROM s),
  o AS (SELECT *, unnest(range(10, least(l, length(b) + 1))) AS n FROM p),
  m AS (SELECT item_id, n FROM o WHERE len(list_filter(range(1, n + 1), lambda i: a[l - n + i] = b[i])) / n::DOUBLE > 0.85)
SELECT coalesce(2 * l - (SELECT max(n) FROM m WHERE m.item_id = p.item_id), 300)::INT AS insert_size, count(*) AS n FROM p GROUP BY 1""")
def _(t):
    # Mates of questions and answers of at most a read's length; each pair compares all overlaps.
    rows = t.benchmark.select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("read_id"), seq_of().alias("seq"))
    second = rows.select("read_id", sq.reverse_complement(F.expr("substring(seq, 31)")).alias("seq"))
    return (r.insert_sizes(rows, second).groupBy("insert_size").agg(F.count("*").alias("n")))

"""Scalar, sequence and calendar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions import clinical, dates, sequence, text, variant
from strandlake.functions.numeric import decay, exact_mean, half_up, log2_plus_one, ratio
from strandlake.operators import lookups, sequences
from strandlake.plans.registry import exact_mean as MEAN
from strandlake.plans.registry import half_up as HU
from strandlake.plans.registry import query
from strandlake.session import computed_once, spread


# Documents as nucleotide sequences: letters only, mapped letter by letter.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASES = "ACGTACGTACGTNACGTACGTACGTA"
SEQ_SQL = f"translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{LETTERS}', '{BASES}')"
SEQS = f"s AS (SELECT doc_id, lang, {SEQ_SQL} AS seq FROM documents)"


def seq_of(col="text"):
    return F.translate(F.regexp_replace(F.lower(col), "[^a-z]+", ""), LETTERS, BASES)


def seqs(t):
    return spread(t.documents.select("doc_id", "lang", "text")).select("doc_id", "lang", seq_of().alias("seq"))


@query("regex_and_ids", "STR-01 STR-02 STR-04 STR-05", """
SELECT p_partkey, regexp_extract('chr' || (p_partkey % 24) || '_x', 'chr(\\d+|X|Y)', 1) AS chrom,
       'SAMPLE_' || lpad(regexp_extract(upper(trim(p_brand)), '(\\d+)', 1), 3, '0') AS sample_id,
       'Run ' || p_partkey || ' size ' || p_size || ' of ' || p_type AS message FROM part""")
def _(t):
    chrom = F.concat(F.lit("chr"), (F.col("p_partkey") % 24).cast("string"), F.lit("_x"))
    return t.part.select("p_partkey", text.chromosome_of(chrom).alias("chrom"),
                         text.canonical_id(F.col("p_brand")).alias("sample_id"),
                         F.format_string("Run %d size %d of %s", "p_partkey", "p_size", "p_type").alias("message"))


@query("label_mapping", "STR-06", """
SELECT o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '5-LOW' THEN 'low' END AS level,
       count(*) AS n FROM orders GROUP BY 1, 2""")
def _(t):
    level = text.mapped_label(F.col("o_orderpriority"), {"1-URGENT": "high", "2-HIGH": "high", "5-LOW": "low"})
    return t.orders.groupBy("o_orderpriority", level.alias("level")).agg(F.count("*").alias("n"))


@query("info_fields", "STR-08", """
SELECT l_returnflag, l_quantity AS dp, count(*) AS n, sum((l_discount > 0.05)::INT)::BIGINT AS flagged, 0::BIGINT AS missing
FROM lineitem GROUP BY 1, 2""")
def _(t):
    info = F.concat(F.lit("DP="), F.col("l_quantity").cast("string"), F.lit(";AF="),
                    F.col("l_discount").cast("string"), F.when(F.col("l_discount") > 0.05, ";DB").otherwise(""),
                    F.lit(";XX=."))
    rows = spread(t.lineitem).select("l_returnflag", info.alias("info"))
    return (rows.groupBy("l_returnflag", variant.info_field(F.col("info"), "DP").cast("double").alias("dp"))
            .agg(F.count("*").alias("n"), F.count_if(variant.info_flag(F.col("info"), "DB")).alias("flagged"),
                 F.count(variant.info_field(F.col("info"), "XX")).alias("missing")))


@query("variant_types", "STR-09 STR-10", """
WITH v AS (SELECT CASE WHEN p_size % 7 = 0 THEN NULL ELSE substr('ACGT', 1, (p_size % 3 + 1)::INT) END AS ref,
                  substr('GATTACA', 1, (p_size % 4 + 1)::INT) AS alt, p_size FROM part)
SELECT CASE WHEN ref IS NULL OR alt IS NULL THEN 'unknown' WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNV'
            WHEN length(ref) < length(alt) THEN 'insertion' WHEN length(ref) > length(alt) THEN 'deletion' ELSE 'MNV' END AS kind,
       CASE WHEN length(coalesce(ref, 'A')) = 1 AND length(alt) = 1 THEN 'SNP' WHEN length(coalesce(ref, 'A')) > length(alt) THEN 'DELETION'
            WHEN length(coalesce(ref, 'A')) < length(alt) THEN 'INSERTION' ELSE 'MNP' END || ',NO_VARIATION' AS kinds, count(*) AS n
FROM v GROUP BY 1, 2""")
def _(t):
    size = F.col("p_size")
    rows = t.part.select(F.when(size % 7 != 0, F.substring(F.lit("ACGT"), F.lit(1), size % 3 + 1)).alias("ref"),
                         F.substring(F.lit("GATTACA"), F.lit(1), size % 4 + 1).alias("alt"))
    kinds = variant.allele_types(F.coalesce("ref", F.lit("A")), F.concat("alt", F.lit(",.")))
    return (rows.groupBy(variant.variant_type(F.col("ref"), F.col("alt")).alias("kind"), kinds.alias("kinds"))
            .agg(F.count("*").alias("n")))


@query("gc_like_content", "SEQ-01 SEQ-03", f"""
WITH {SEQS} SELECT doc_id, length(seq) AS bases,
       coalesce(length(regexp_replace(seq, '[^GC]', '', 'g'))::DOUBLE / nullif(length(seq), 0), 0) AS gc,
       length(regexp_replace(seq, '[^N]', '', 'g'))::DOUBLE / nullif(length(seq), 0) AS n_share FROM s""")
def _(t):
    s = F.col("seq")
    return seqs(t).select("doc_id", F.length(s).cast("bigint").alias("bases"), sequence.gc_fraction(s).alias("gc"),
                          sequence.n_fraction(s).alias("n_share"))


@query("phred_statistics", "SEQ-02", """
WITH c AS (SELECT doc_id, unnest(string_split(translate(regexp_replace(lower(text), '[^a-z]', '', 'g'),
            'abcdefghijklmnopqrstuvwxyz', '!#%)+-/1357:;<=>?@ABCDEFGHI'), '')) AS c FROM documents)
SELECT doc_id, avg(ascii(c) - 33) AS mean_q, min(ascii(c) - 33)::INT AS min_q, max(ascii(c) - 33)::INT AS max_q
FROM c WHERE c <> '' GROUP BY 1""")
def _(t):
    qual = F.col("qual")
    return (spread(t.documents.select("doc_id", "text")).select("doc_id", qual_of().alias("qual")).filter(F.length(qual) > 0)
            .select("doc_id", sequence.phred_mean(qual).alias("mean_q"), sequence.phred_min(qual).alias("min_q"),
                    sequence.phred_max(qual).alias("max_q")))


QUALS = "!#%)+-/1357:;<=>?@ABCDEFGHI"


def qual_of(col="text"):
    return F.translate(F.regexp_replace(F.lower(col), "[^a-z]+", ""), LETTERS, QUALS[:26])


@query("trim_suffix", "SEQ-04 SEQ-05", """
WITH s AS (SELECT doc_id, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', '!#%)+-/1357:;<=>?@ABCDEFGHI') AS q,
           translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTNACGTACGTACGTA') AS seq FROM documents)
SELECT doc_id, length(rtrim(q, '!"#$%&''()*+,-./')) AS kept,
       CASE WHEN strpos(seq, 'ACGA') > 0 THEN strpos(seq, 'ACGA') - 1 ELSE length(seq) END AS before_adapter FROM s""")
def _(t):
    rows = spread(t.documents.select("doc_id", "text")).select("doc_id", qual_of().alias("q"), seq_of().alias("seq"))
    return rows.select("doc_id", F.length(sequence.trimmed_quality(F.col("q"), 15)).cast("bigint").alias("kept"),
                       F.length(sequence.before_adapter(F.col("seq"), "ACGATT", 4)).cast("bigint")
                       .alias("before_adapter"))


@query("reverse_complement", "SEQ-06 SEQ-07", f"""
WITH {SEQS} SELECT doc_id, md5(reverse(translate(seq, 'ACGT', 'TGCA'))) AS rc, md5(replace(seq, 'T', 'U')) AS rna FROM s""")
def _(t):
    s = F.col("seq")
    return seqs(t).select("doc_id", F.md5(sequence.reverse_complement(s).cast("binary")).alias("rc"),
                          F.md5(sequence.transcribe(s).cast("binary")).alias("rna"))


CODON_VALUES = ", ".join(f"('{c}', '{a}')" for c, a in sequence.codon_table().items())


@query("translated_proteins", "SEQ-08", f"""
WITH {SEQS}, k(codon, aa) AS (VALUES {CODON_VALUES}),
     c AS (SELECT doc_id, seq, unnest(range(0, length(seq) // 3)) AS i FROM s),
     a AS (SELECT doc_id, i, coalesce(aa, 'X') AS aa FROM (SELECT doc_id, i, substr(seq, (i * 3 + 1)::BIGINT, 3) AS codon FROM c) LEFT JOIN k USING (codon))
SELECT doc_id, md5(string_agg(aa, '' ORDER BY i)) AS protein, coalesce(min(i) FILTER (aa = '*'), count(*)) AS to_stop FROM a GROUP BY 1""")
def _(t):
    # Translated once: the condition and both columns use its result, which no condition is pushed below.
    protein = F.col("protein")
    return (computed_once(seqs(t), ["doc_id"], {"protein": sequence.protein(F.col("seq"))}).filter(F.length(protein) > 0)
            .select("doc_id", F.md5(protein.cast("binary")).alias("protein"),
                    F.length(sequence.to_first_stop(protein)).cast("bigint").alias("to_stop")))


@query("motif_positions", "SEQ-09", f"""
WITH {SEQS}, p AS (SELECT doc_id, seq, unnest(range(1, length(seq) - 2)) AS i FROM s)
SELECT doc_id, count(*) AS n, min(i) AS first_pos, max(i) AS last_pos FROM p WHERE substr(seq, i, 4) = 'ACAC' GROUP BY 1""")
def _(t):
    hits = seqs(t).select("doc_id", F.explode(sequence.motif_positions(F.col("seq"), "ACAC")).alias("i"))
    return hits.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("i").cast("bigint").alias("first_pos"),
                                      F.max("i").cast("bigint").alias("last_pos"))


@query("motif_pattern", "SEQ-09", f"""
WITH {SEQS}, p AS (SELECT doc_id, seq, unnest(range(1, length(seq) - 2)) AS i FROM s)
SELECT doc_id, count(*) AS n, sum(i)::BIGINT AS place_sum FROM p
WHERE regexp_full_match(substr(seq, i, 4), 'N[^A][CT][^A]') GROUP BY 1""")
def _(t):
    hits = seqs(t).select("doc_id", F.explode(sequence.motif_positions(F.col("seq"), "N[^A][CT][^A]", 4)).alias("i"))
    return hits.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("i").alias("place_sum"))


@query("codon_usage", "SEQ-10", f"""
WITH {SEQS}, k(codon, amino_acid) AS (VALUES {CODON_VALUES}),
     c AS (SELECT seq, unnest(range(0, length(seq) // 3)) AS i FROM s),
     n AS (SELECT codon, amino_acid, count(*) AS n FROM (SELECT substr(seq, (i * 3 + 1)::BIGINT, 3) AS codon FROM c) JOIN k USING (codon) GROUP BY 1, 2)
SELECT codon, amino_acid, n, n::DOUBLE / (sum(n) OVER ())::DOUBLE AS frequency,
       n::DOUBLE / (sum(n) OVER (PARTITION BY amino_acid))::DOUBLE AS relative_use FROM n""")
def _(t):
    return sequences.codon_usage(seqs(t), "seq")


@query("composition", "SEQ-11", f"""
WITH {SEQS}, c AS (SELECT lang, unnest(string_split(seq, '')) AS residue FROM s)
SELECT lang, residue, count(*) AS n, count(*)::DOUBLE / (sum(count(*)) OVER (PARTITION BY lang))::DOUBLE AS share
FROM c WHERE residue <> '' GROUP BY 1, 2""")
def _(t):
    return sequences.composition(seqs(t), ["lang"], "seq", "ACGTN")


@query("one_hot_letters", "SEQ-12", f"""
WITH {SEQS}, c AS (SELECT lang, unnest(string_split(seq, '')) AS c FROM s)
SELECT lang, count(*) FILTER (c = 'A') AS a, count(*) FILTER (c = 'C') AS c, count(*) FILTER (c = 'G') AS g,
       count(*) FILTER (c = 'T') AS t FROM c GROUP BY 1""")
def _(t):
    rows = seqs(t).select("lang", F.explode(sequence.one_hot(F.col("seq"))).alias("h"))
    return rows.groupBy("lang").agg(*[F.sum(F.col("h")[i]).alias(n) for i, n in enumerate("acgt")])


@query("kmer_top", "SEQ-13 SRT-03", f"""
WITH {SEQS}, p AS (SELECT substr(seq, i, 6) AS kmer FROM (SELECT seq, unnest(range(1, length(seq) - 4)) AS i FROM s))
SELECT kmer, count(*) AS n FROM p GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def _(t):
    return sequences.top_kmers(seqs(t), "seq", 6, 20)


@query("hamming_pairs", "SEQ-14 SEQ-17", """
WITH b AS (SELECT item_id, regexp_replace(lower(text), '[^a-z]', '', 'g') AS s FROM benchmark),
     p AS (SELECT a.item_id AS a, b.item_id AS b, a.s AS x, b.s AS y, least(length(a.s), length(b.s)) AS n
           FROM b a JOIN b b ON a.item_id < b.item_id),
     m AS (SELECT a, b, n, len(list_filter(range(1, n + 1), lambda i: x[i] <> y[i])) AS d FROM p)
SELECT a, b, n AS shared, """ + HU("d::DOUBLE / n", 9) + """ AS p_distance FROM m""")
def _(t):
    s = spread(t.benchmark).select("item_id", F.regexp_replace(F.lower("text"), "[^a-z]+", "").alias("s"))
    return sequences.pairwise_p_distance(s, "item_id", "s").withColumn("p_distance", half_up(F.col("p_distance"), 9))


@query("open_reading_frames", "SEQ-16", f"""
WITH {SEQS}, c AS (SELECT doc_id, f, i, substr(seq, (f + i * 3 + 1)::BIGINT, 3) AS codon FROM
        (SELECT doc_id, seq, f, unnest(range(0, (length(seq) - f) // 3)) AS i FROM s, (VALUES (0), (1), (2)) v(f))),
     n AS (SELECT doc_id, f, i, codon, min(CASE WHEN codon IN ('TAA', 'TAG', 'TGA') THEN i END) OVER
             (PARTITION BY doc_id, f ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop FROM c),
     o AS (SELECT doc_id, f + i * 3 AS "start", (stop - i + 1) * 3 AS length FROM n WHERE codon = 'ATG' AND stop IS NOT NULL)
SELECT doc_id, count(*) AS orfs, max(length)::BIGINT AS longest, arg_max("start", (length, -"start"))::BIGINT AS longest_start
FROM o WHERE length >= 30 GROUP BY 1""")
def _(t):
    orfs = sequences.open_reading_frames(seqs(t), "doc_id", "seq", 30)
    best = F.max_by("start", F.struct(F.col("length").alias("a"), (-F.col("start")).alias("b")))
    return orfs.groupBy("doc_id").agg(F.count("*").alias("orfs"), F.max("length").alias("longest"),
                                      best.alias("longest_start"))


@query("column_conservation", "SEQ-17", f"""
WITH {SEQS}, c AS (SELECT i AS pos, substr(seq, i, 1) AS b FROM (SELECT seq, unnest(range(1, length(seq) + 1)) AS i FROM s))
SELECT pos, count(*) AS n, count(DISTINCT b) AS letters, count(DISTINCT b) = 1 AS conserved FROM c GROUP BY 1""")
def _(t):
    return sequences.column_conservation(seqs(t), "seq")


@query("logs_and_decay", "MTH-02", f"""
SELECT o_orderkey, {HU('ln(1 + o_totalprice)', 9)} AS log1p_price, {HU('log2(o_totalprice + 1)', 9)} AS log2_price,
       {HU('exp(-(o_orderkey % 97) / 80.0::DOUBLE)', 9)} AS strength FROM orders""")
def _(t):
    price = F.col("o_totalprice")
    return t.orders.select("o_orderkey", half_up(F.log1p(price), 9).alias("log1p_price"),
                           half_up(log2_plus_one(price), 9).alias("log2_price"),
                           half_up(decay((F.col("o_orderkey") % 97).cast("double")), 9).alias("strength"))


@query("dim_date", "DAT-01 SRC-15", """
WITH d AS (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))::DATE AS d FROM orders)
SELECT strftime(d, '%Y-%m-%d') AS full_date, strftime(d, '%Y%m%d')::INT AS date_key, year(d)::INT AS "year",
       quarter(d)::INT AS quarter, month(d)::INT AS "month", monthname(d) AS month_name, weekofyear(d)::INT AS week,
       dayofmonth(d)::INT AS day_of_month, dayofweek(d)::INT AS day_of_week, dayname(d) AS day_name,
       dayofweek(d) IN (0, 6) AS is_weekend FROM d""")
def _(t):
    days = dates.with_date_parts(dates.calendar_of(t.orders, "o_orderdate"))
    return days.withColumn("full_date", F.date_format("full_date", "yyyy-MM-dd"))


@query("day_and_month_gaps", "DAT-02 DAT-03 DAT-04", """
SELECT l_orderkey, l_linenumber, l_partkey, date_diff('day', o_orderdate, l_shipdate)::INT AS days,
       date_diff('month', o_orderdate, l_shipdate)::INT AS months,
       strftime(date_trunc('quarter', l_shipdate), '%Y-%m-%d') AS quarter_start
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    ship = dates.safe_date(F.date_format("l_shipdate", "yyyy-MM-dd"))
    order = F.col("o_orderdate")
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", dates.days_between(order, ship).alias("days"),
                       dates.months_between_boundaries(order, ship).alias("months"),
                       F.date_format(F.date_trunc("quarter", "l_shipdate"), "yyyy-MM-dd").alias("quarter_start"))


@query("unnested_genes", "ARR-01", """
WITH p AS (SELECT p_brand, list(DISTINCT p_type) AS types FROM part GROUP BY 1)
SELECT type, count(*) AS n FROM (SELECT p_brand, unnest(types) AS type FROM p) GROUP BY 1""")
def _(t):
    paths = t.part.groupBy("p_brand").agg(F.collect_set("p_type").alias("types"))
    return (paths.select("p_brand", F.explode("types").alias("type")).groupBy("type")
            .agg(F.count("*").alias("n")))


@query("json_props", "JSN-01", f"""
SELECT event_type, count(*) AS n, sum(CAST(props::JSON->>'$.k' AS BIGINT))::BIGINT AS k_sum,
       count(CAST(props::JSON->>'$.missing' AS BIGINT)) AS missing FROM events GROUP BY 1""")
def _(t):
    k = text.json_field(F.col("props"), "$.k", "bigint")
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("k_sum"), F.count(
        text.json_field(F.col("props"), "$.missing", "bigint")).alias("missing"))


@query("json_round_trip", "JSN-01", """
SELECT event_type, count(*) AS n, min(event_id) AS lo, max(event_id) AS hi FROM events GROUP BY 1""")
def _(t):
    built = t.events.select(text.json_object(id=F.col("event_id"), kind=F.col("event_type")).alias("j"))
    back = built.select(F.from_json("j", "id bigint, kind string").alias("r")).select("r.*")
    return back.groupBy(F.col("kind").alias("event_type")).agg(
        F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))


@query("mapping_rate_lookup", "UDF-01 UDF-03 UDF-04 UDF-12", f"""
SELECT s_suppkey, rate, CASE WHEN rate < 30 THEN 'Low' WHEN rate < 80 THEN 'Medium' WHEN rate < 120 THEN 'High' ELSE 'Very High' END AS class
FROM (SELECT s_suppkey, (count(*) FILTER (l_returnflag <> 'R')) * 100.0::DOUBLE / nullif(count(l_returnflag), 0) AS rate
      FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1)""")
def _(t):
    runs = t.lineitem.groupBy(F.col("l_suppkey").alias("run_id")).agg(
        F.count("*").alias("total_reads"), F.count_if(F.col("l_returnflag") != "R").alias("mapped_reads"))
    wanted = t.supplier.select(F.col("s_suppkey").alias("run_id"))
    out = lookups.mapping_rates(runs, wanted)
    return out.select(F.col("run_id").alias("s_suppkey"), F.col("mapping_rate").alias("rate"),
                      clinical.coverage_class(F.col("mapping_rate")).alias("class"))


@query("sql_functions", "UDF-03 UDF-04", """
SELECT s_suppkey, rate, CASE WHEN rate < 30 THEN 'Low' WHEN rate < 80 THEN 'Medium' WHEN rate < 120 THEN 'High' ELSE 'Very High' END AS class
FROM (SELECT s_suppkey, mapped * 100.0::DOUBLE / nullif(total, 0) AS rate FROM supplier LEFT JOIN (
  SELECT l_suppkey, count(*) FILTER (l_linenumber <> 1) AS total, count(*) FILTER (l_linenumber <> 1 AND l_returnflag <> 'R') AS mapped FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey)""")
def _(t):
    lookups.register_sql_functions(t.spark)
    return t.sql("""SELECT s_suppkey, mapping_rate(mapped, total) AS rate, coverage_class(mapping_rate(mapped, total)) AS class
        FROM {supplier} LEFT JOIN (SELECT l_suppkey, count_if(l_linenumber <> 1) AS total, count_if(l_linenumber <> 1 AND l_returnflag <> 'R') AS mapped
                                   FROM {lineitem} GROUP BY 1) ON l_suppkey = s_suppkey""", ("supplier", "lineitem"))


@query("genotype_indicators", "SEQ-12", """
WITH g AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN l_returnflag || 'G' END AS rs1, ['CC', 'CT', 'TT'][(l_quantity::BIGINT % 3 + 1)] AS rs2 FROM lineitem)
SELECT rs1 IS NULL AS open_call, count(*) AS n, sum(coalesce((rs1 = 'AG')::INT, 0))::BIGINT AS rs1_AG, sum(coalesce((rs1 = 'NG')::INT, 0))::BIGINT AS rs1_NG,
  sum(coalesce((rs1 = 'RG')::INT, 0))::BIGINT AS rs1_RG, sum((rs2 = 'CC')::INT)::BIGINT AS rs2_CC, sum((rs2 = 'CT')::INT)::BIGINT AS rs2_CT, sum((rs2 = 'TT')::INT)::BIGINT AS rs2_TT
FROM g GROUP BY 1""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_linestatus") == "O", F.concat("l_returnflag", F.lit("G"))).alias("rs1"),
                             F.element_at(F.array(*[F.lit(g) for g in ("CC", "CT", "TT")]), (F.col("l_quantity").cast("bigint") % 3 + 1).cast("int")).alias("rs2"))
    marked = sequences.genotype_indicators(rows, ["rs1", "rs2"])
    added = [c for c in marked.columns if c not in rows.columns]
    return marked.groupBy(F.col("rs1").isNull().alias("open_call")).agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in added])


@query("identity_pairs", "SEQ-14", """
WITH p AS (SELECT a.s_suppkey AS a, b.s_suppkey AS b, a.s_name AS x, b.s_name AS y FROM supplier a JOIN supplier b ON a.s_suppkey < b.s_suppkey)
SELECT a, b, hamming(x, y)::INT AS distance, (length(x) - hamming(x, y)) * 100.0::DOUBLE / length(x) AS identity_pct FROM p""")
def _(t):
    return sequences.pairwise_identity(t.supplier, "s_suppkey", "s_name")


@query("entity_report", "UDF-05 UDF-06 UDF-10", """
SELECT o_orderkey, o_totalprice, o_orderstatus, o_totalprice > 200000 AS flagged FROM orders
WHERE o_custkey = 899 AND o_totalprice BETWEEN 50000 AND 400000""")
def _(t):
    return lookups.entity_report(t.orders, "o_custkey", 899, "o_totalprice", 50000, 400000, 200000).select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "flagged")


@query("entity_summary", "UDF-07 UDF-08", f"""
SELECT c_custkey, n, lowest, {HU('mean', 6)} AS mean, highest FROM customer LEFT JOIN (
  SELECT o_custkey AS c_custkey, count(*) AS n, min(o_totalprice) AS lowest, {MEAN('o_totalprice', 2)} AS mean, max(o_totalprice) AS highest
  FROM orders GROUP BY 1) USING (c_custkey)""")
def _(t):
    out = lookups.entity_summaries(t.customer.select("c_custkey"), t.orders.withColumnRenamed("o_custkey", "c_custkey"),
                                   "c_custkey", "o_totalprice")
    return out.withColumn("mean", half_up(F.col("mean"), 6))


@query("safe_single_lookup", "UDF-10", """
SELECT p_brand, CASE WHEN count(*) = 1 THEN min(p_partkey) END AS only_part FROM part WHERE p_size >= 49 GROUP BY 1""")
def _(t):
    return lookups.single_or_null(t.part.filter(F.col("p_size") >= 49), ["p_brand"], "p_partkey", "only_part")


@query("variant_types_vectorised", "UDF-02", """
SELECT CASE WHEN length(p_brand) = 7 AND length(p_type) = 5 THEN 'deletion' WHEN length(p_brand) < length(p_type) THEN 'insertion'
            WHEN length(p_brand) > length(p_type) THEN 'deletion' ELSE 'MNV' END AS kind, count(*) AS n FROM part GROUP BY 1""")
def _(t):
    kind = lookups.variant_type_pandas_udf()(F.col("p_brand"), F.col("p_type"))
    return t.part.select(kind.alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))

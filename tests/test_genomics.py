"""Formats and sequence semantics on small fixtures."""

import gzip

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from strandlake.functions import sequence as sq
from strandlake.functions import text, variant
from strandlake.operators import coverage, lookups, reads, sequences
from strandlake.operators.performance import plan_text
from strandlake.session import computed_once
from strandlake.sources import genomics as g
from strandlake.sources import sinks, tabular

HEADER = "##fileformat=VCFv4.2\n##source=a\n##source=b=c\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"
RECORDS = ["1\t100\trs1\tA\tG\t50.5\tPASS\tDP=30;AF=0.5", "1\tbad\t.\tAT\tA\t.\tPASS\tDP=10;DB", "2\t300\t.\tA\tAT,G,.\t20\tLowQual\t."]


def put(path, content, zipped=False):
    (gzip.open(path, "wt") if zipped else open(path, "w")).write(content)
    return str(path)


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column).first()[0]


@pytest.mark.parametrize("zipped", [False, True])
def test_vcf(spark, tmp_path, zipped):
    body = HEADER + "\tFORMAT\tS1\tS2\n" + "\n".join(f"{r}\tGT:DP\t0/1:12\t1/1:9" for r in RECORDS) + "\n"
    v = g.read_vcf(spark, put(tmp_path / ("x.vcf.gz" if zipped else "x.vcf"), body, zipped), partitions=3)
    assert v.samples == ["S1", "S2"]
    assert rows(v.metadata, "value") == [("fileformat", "VCFv4.2"), ("source", "a"), ("source", "b=c")]
    got = {r["REF"] + r["ALT"]: r for r in v.rows.collect()}
    assert got["AG"]["POS"] == 100 and got["AG"]["QUAL"] == 50.5 and got["AG"]["INFO"] == {"DP": "30", "AF": "0.5"}
    assert got["ATA"]["POS"] is None and got["ATA"]["QUAL"] is None and got["ATA"]["INFO"]["DB"] == "true"
    assert got["AAT,G,."]["INFO"] == {}
    assert rows(g.genotypes(v).filter("sample = 'S2' and REF = 'AT'").select("key", "value"), "key") == [("DP", "9"), ("GT", "1/1")]
    summary = {(r["metric"], r["value"]): r["n"] for r in coverage.variant_summary(v.rows).collect()}
    assert summary["total", ""] == 3 and summary["type", "INSERTION,SNP,NO_VARIATION"] == 1 and summary["filter", "PASS"] == 2


def test_vcf_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="header"):
        g.read_vcf(spark, put(tmp_path / "a.vcf", "\n".join(RECORDS)))
    with pytest.raises(ValueError, match="INFO"):
        g.read_vcf(spark, put(tmp_path / "b.vcf", HEADER.replace("\tINFO", "") + "\n" + RECORDS[0]))
    short = g.read_vcf(spark, put(tmp_path / "c.vcf", HEADER + "\n1\t2\t3\n"))
    with pytest.raises(PySparkException, match="fewer than 8"):
        short.rows.collect()


def test_info_and_types(spark):
    info = F.col("i")
    assert one(spark, variant.info_field(info, "DP"), i="XDP=9;DP=1;DP=2") == "2"
    assert one(spark, variant.info_map(info), i="DP=1;DP=2;DB") == {"DP": "2", "DB": "true"}
    assert one(spark, variant.info_field(info, "A"), i="A=.") is None
    assert one(spark, variant.info_flag(info, "DB"), i="DBX;A=1") is False
    data = [("A", "G"), ("A", "AT"), ("AT", "A"), ("AT", "GC"), (None, "A"), ("A", None)]
    df = spark.createDataFrame(data, "ref string, alt string")
    ref, alt = F.col("ref"), F.col("alt")
    forms = df.select(variant.variant_type(ref, alt).alias("b"), lookups.variant_type_udf()(ref, alt).alias("u"),
                      lookups.variant_type_pandas_udf()(ref, alt).alias("p")).collect()
    assert [r["b"] for r in forms] == ["SNV", "insertion", "deletion", "MNV", "unknown", "unknown"]
    assert all(r["b"] == r["u"] == r["p"] for r in forms)


def test_fastq_with_at_sign_in_quality(spark, tmp_path):
    body = "@READ_1 x y\nACGT\n+\n@III\n@READ_2\nACGG\n+\nII@@\n@READ_3\nNN\n+\n@R\n"
    df = g.read_fastq(spark, put(tmp_path / "r.fastq", body))
    assert rows(df, "read_id") == [("READ_1", "x y", "ACGT", "@III"), ("READ_2", None, "ACGG", "II@@"), ("READ_3", None, "NN", "@R")]
    sinks.write_text(sinks.fastq_text(df), str(tmp_path / "out"))
    assert rows(g.read_fastq(spark, str(tmp_path / "out")).select("read_id", "qual"), "read_id") == [
        ("READ_1", "@III"), ("READ_2", "II@@"), ("READ_3", "@R")]
    with pytest.raises(PySparkException, match="not four lines"):
        g.fastq_records(spark.createDataFrame([("READ\nAC",)], "value string")).collect()


def test_fastq_loses_no_read(spark, tmp_path):
    """Two families of ids in several files, quality lines that start with @, splits in any place."""
    want = []
    for k in range(3):
        body = []
        for i in range(400):
            name = f"SRRA.{k}.{i}" if i % 2 else f"9-ERRB/{k}_{i}"
            qual = ("@" if i % 3 == 0 else "I") + "@F#I"[: i % 5]
            want.append((name, "ACGTN"[: len(qual)], qual))
            body.append(f"@{name}\n{want[-1][1]}\n+\n{qual}\n")
        put(tmp_path / f"r{k}.fastq", "".join(body))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (old, "1000", "333"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = [(r["read_id"], r["seq"], r["qual"]) for r in g.read_fastq(spark, str(tmp_path)).collect()]
            assert sorted(got) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    put(tmp_path / "r3.fastq", "@x\nAC\n+\n")
    with pytest.raises(PySparkException):
        g.read_fastq(spark, str(tmp_path)).collect()


def test_fasta(spark, tmp_path):
    body = ">s1 first > one\nACGT\nGG\n>s2\n" + "A" * 165 + "\n>s3\n\n"
    df = g.read_fasta(spark, put(tmp_path / "s.fa", body))
    got = {r["id"]: r for r in df.collect()}
    assert got["s1"]["seq"] == "ACGTGG" and got["s1"]["description"] == "s1 first > one"
    assert got["s1"]["gc_content"] == pytest.approx(400 / 6) and got["s2"]["length"] == 165 and got["s3"]["length"] == 0
    lines = sinks.fasta_text(df.filter("id = 's2'")).first()[0].split("\n")
    assert [len(x) for x in lines] == [3, 80, 80, 5]


def test_sam(spark, tmp_path):
    body = "@HD\tVN:1\nr1\t0\tchr1\t11\t60\t3M1I2D4M\t*\t0\t0\tACGTACGT\tIIIIIIII\tNM:i:1\tXX:Z:a:b\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n"
    got = {r["read_id"]: r for r in g.read_sam(spark, put(tmp_path / "a.sam", body)).collect()}
    assert (got["r1"]["start"], got["r1"]["end"]) == (10, 19) and got["r1"]["tags"] == {"NM": "1", "XX": "a:b"}
    assert got["r2"]["tags"] == {} and got["r2"]["strand"] == "+"


def test_commented_tables(spark, tmp_path):
    gct = "#1.2\n2\t2\nName\tDescription\tS1\tS2\ng1\ta\t1.5\tx\ng2\tb\t\t4\n"
    df = tabular.expression_matrix(spark, put(tmp_path / "m.gct", gct), ["S1", "S2"])
    assert rows(df, "Name") == [("g1", "a", 1.5, None), ("g2", "b", None, 4.0)]


def test_sequence_functions(spark):
    s = F.col("s")
    assert one(spark, sq.gc_fraction(s), s="") == 0.0
    assert one(spark, sq.gc_fraction(s), s="gCaT") == 0.5
    assert one(spark, sq.phred_scores(s), s="!I5") == [0, 40, 20]
    assert one(spark, sq.phred_mean(s), s="") is None
    assert one(spark, sq.trimmed_quality(s, 15), s="II!I/.") == "II!I"[:4]
    assert one(spark, sq.trimmed_quality(s, 15), s="!!") == ""
    assert one(spark, sq.reverse_complement(s), s="ACGTX") == "NACGT"
    assert one(spark, sq.protein(s), s="ATGGCCTAAGGGA") == "MA*G"
    assert one(spark, sq.protein(s, True), s="AUGGCCUAAGGG") == "MA"
    assert one(spark, sq.motif_positions(s, "AA"), s="AAAGAA") == [1, 2, 5]
    assert one(spark, sq.motif_positions(s, "N[^P][ST][^P]", 4), s="NGSANPSANNTA") == [1, 9]
    assert one(spark, sq.kmers(s, 3), s="ACGT") == ["ACG", "CGT"] and one(spark, sq.kmers(s, 3), s="AC") == []
    assert one(spark, sq.one_hot(s), s="AN") == [[1, 0, 0, 0], [0, 0, 0, 0]]
    assert one(spark, sq.hamming(F.col("a"), F.col("b")), a="GATTACA", b="GACTATA") == 2
    assert one(spark, sq.p_distance(F.col("a"), F.col("b")), a="ACGT", b="AC") == 0.0
    with pytest.raises(PySparkException, match="differ in length"):
        one(spark, sq.hamming(F.col("a"), F.col("b")), a="A", b="AC")
    assert one(spark, text.canonical_id(s), s=" sample-7b9 ") == "SAMPLE_007"
    assert one(spark, text.canonical_id(s), s="S1234") == "SAMPLE_1234"
    assert one(spark, text.canonical_id(s), s="ctrl") == "CTRL"
    order = spark.createDataFrame([("chr10",), ("chrX",), ("chr2",), ("chrY",), ("chrUn",), ("chr1",)], "c string")
    assert [r[0] for r in order.orderBy(text.chromosome_order(F.col("c"))).collect()] == ["chr1", "chr2", "chr10", "chrX", "chrY", "chrUn"]


def test_insert_size(spark):
    fragment = "ACGGTCATTGCAGGCTTAACCGGATATCGC"
    mate = one(spark, sq.reverse_complement(F.col("s")), s=fragment[10:])
    assert one(spark, sq.insert_size(F.col("a"), F.col("b")), a=fragment[:20], b=mate) == 30
    assert one(spark, sq.insert_size(F.col("a"), F.col("b")), a="A" * 20, b="A" * 20) == 300


def test_insert_sizes_equal_plain_comparison(spark):
    import random
    r = random.Random(4)
    pairs = []
    for _ in range(150):
        n, m = r.randrange(0, 60), r.randrange(0, 60)
        fragment = "".join(r.choice("ACGTN") for _ in range(90))
        start = r.randrange(0, 31)
        mate = "".join(c if r.random() > 0.08 else r.choice("ACGT") for c in fragment[start:start + m])
        pairs.append((fragment[:n], mate))
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("second", sq.reverse_complement(F.col("b")))
    got = df.select("a", "b", sq.insert_size(F.col("a"), F.col("second")).alias("size")).collect()
    for a, b, size in got:
        fits = [n for n in range(10, min(len(a) - 1, len(b)) + 1) if sum(x == y for x, y in zip(a[len(a) - n:], b)) / n > 0.85]
        assert size == (2 * len(a) - max(fits) if fits else 300), (a, b)


def test_open_reading_frames(spark):
    stop = "GCC" * 9
    df = spark.createDataFrame([(1, "C" + "ATG" + stop + "ATG" + "GCC" * 8 + "TAA"), (2, "ATGTAA")], "id int, s string")
    got = rows(sequences.open_reading_frames(df, "id", "s", 30).select("id", "frame", "start", "length"), "start")
    assert got == [(1, 1, 1, 60), (1, 1, 31, 30)]
    longest = sequences.longest_frames(sequences.open_reading_frames(df, "id", "s", 30), "id").first()
    assert longest["length"] == 60


def test_trim_reasons_follow_the_order_of_steps(spark):
    good, low = "I", "#"
    data = [("pass", "A" * 30, good * 30), ("n", "A" * 29 + "N", low * 30), ("short", "A" * 5, good * 5),
            ("qual", "A" * 30, low * 30), ("tail", "A" * 30, "~" * 15 + low * 15), ("cut", "A" * 25 + "CCGG" + "N" * 9, good * 38),
            ("adapter_short", "CCGGAAAA", good * 8)]
    df = spark.createDataFrame(data, "read_id string, seq string, qual string")
    got = {r["read_id"]: r for r in reads.trimmed_reads(df, "CCGG", 20, 20, 20).collect()}
    assert {k: r["reason"] for k, r in got.items()} == {
        "pass": "passed", "n": "n_filtered", "short": "length_filtered", "qual": "quality_filtered",
        "tail": "length_filtered", "cut": "passed", "adapter_short": "length_filtered"}
    assert got["cut"]["seq"] == "A" * 25 and got["cut"]["adapter_trimmed"]


def test_pairs_and_mismatches(spark):
    from strandlake.operators.joins import check_mates, mate_mismatches
    a = spark.createDataFrame([("r1/1", "A", "I"), ("r2/1", "C", "I")], "read_id string, seq string, qual string")
    b = spark.createDataFrame([("r1/2", "T", "I")], "read_id string, seq string, qual string")
    assert mate_mismatches(a, b).count() == 1
    with pytest.raises(ValueError, match="r2"):
        check_mates(a, b)


def test_coverage_and_n50(spark):
    targets = spark.createDataFrame([("t", "1", 10, 20)], "target string, chrom string, start int, end int")
    align = spark.createDataFrame([("1", 0, 12), ("1", 11, 15), ("2", 10, 20)], "chrom string, start int, end int")
    depth = dict(rows(coverage.target_depth(targets, align, 4).select("pos", "depth")))
    assert [depth[p] for p in range(10, 20)] == [1, 2, 1, 1, 1, 0, 0, 0, 0, 0]
    contigs = spark.createDataFrame([(x, 50.0) for x in (80, 70, 50, 40, 30, 20)], "length int, gc_content double")
    assert coverage.nx(contigs, []).first()[0] == 70


def test_access_log(spark):
    lines = spark.createDataFrame([('1.2.3.4 - - [10/Oct/2023:13:55:36 +0000] "GET /a HTTP/1.1" 404 23',), ("junk",)], "value string")
    assert rows(text.parse_access_log(lines).select("client", "path", "status", "bytes")) == [("1.2.3.4", "/a", 404, 23)]


def test_pairwise_identity(spark):
    df = spark.createDataFrame([("a", "ACGT"), ("b", "ACGA"), ("c", "TTTT")], "id string, s string")
    got = {(r["a"], r["b"]): (r["distance"], r["identity_pct"]) for r in sequences.pairwise_identity(df, "id", "s").collect()}
    assert got == {("a", "b"): (1, 75.0), ("a", "c"): (3, 25.0), ("b", "c"): (4, 0.0)}


READS = [("a/1", "ACGTACGTNN", "IIIIIIII!!"), ("b/1", "ACGTA", "!!!!!"), ("c/1", "", ""), ("d/1", None, None), ("e/1", "GGCCGGCCGG", "5555555555"),
         ("f/1", "AAAA", "III!")]


def test_rules_and_report_read_texts_once(spark):
    """Conditions use measures made once per read: plans hold one aggregation of scores, not one per use."""
    df = spark.createDataFrame(READS, "read_id string, seq string, qual string")
    rules = {"strict": {"min_length": 5, "min_quality": 19, "max_n": 0.3}, "lenient": {"min_length": 1, "min_quality": 0, "max_n": 1.0}}
    got = reads.compare_rules(df, rules)
    assert plan_text(got).count("Scan") == plan_text(df).count("Scan")
    want = {n: reads.read_statistics(reads.tail_trimmed(reads.filtered(df, **limits))).first() for n, limits in rules.items()}
    for r in got.collect():
        assert [r[c] for c in ("total_reads", "avg_length", "avg_gc", "avg_quality")] == list(want[r["rules"]])
    empty = reads.compare_rules(df, {"none": {"min_length": 99}}).first()
    assert tuple(empty) == (0, None, None, None, "none")
    second = df.select(F.replace("read_id", F.lit("/1"), F.lit("/2")).alias("read_id"), "seq", "qual").filter("read_id <> 'a/2'")
    report = reads.read_report(df, second, 4, 19, 0.3)
    assert plan_text(report).count("aggregate(") == 0  # texts are behind a checkpoint
    assert {r["stage"]: r["total_reads"] for r in report.collect()} == {"raw_1": 6, "filtered_1": 3, "raw_2": 5, "filtered_2": 2, "pairs_kept": 2}


def test_protein_is_made_once(spark):
    df = computed_once(spark.createDataFrame([(1, "ATGTAAC"), (2, "AT"), (3, None)], "k int, s string"), ["k"], {"p": sq.protein(F.col("s"))})
    got = df.filter(F.length("p") > 0).select("k", "p", sq.to_first_stop(F.col("p")).alias("q"))
    assert rows(got) == [(1, "M*", "M")]
    assert plan_text(got).count("regexp_extract_all(") == plan_text(df).count("regexp_extract_all(")

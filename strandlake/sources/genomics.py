"""Genomics text formats as DataFrames. Parsers take a DataFrame of lines or records (column ``value``)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.functions.variant import info_map

# Mandatory columns of the variant format and of alignments.
VCF_COLUMNS = ("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO")
SAM_COLUMNS = ("read_id", "flag", "chrom", "pos", "mapq", "cigar", "mate_chrom", "mate_pos", "insert_len", "seq", "qual")


@dataclass(frozen=True)
class Variants:
    """Variant file: rows, (key, value) metadata, sample names."""

    rows: DataFrame
    metadata: DataFrame
    samples: list[str]


def vcf_header(lines: DataFrame) -> list[str]:
    """Column names from the header line; a missing header or mandatory column is an error."""
    line = lines.filter(F.col("value").startswith("#CHROM")).select("value").first()
    if line is None:
        raise ValueError("no header line")
    names = line[0].rstrip("\r").lstrip("#").split("\t")
    absent = [c for c in VCF_COLUMNS if c not in names]
    if absent:
        raise ValueError(f"missing columns: {absent}")
    return names


def vcf_metadata(lines: DataFrame) -> DataFrame:
    """``##key=value`` lines; a key may come several times."""
    text = F.expr("substring(value, 3)")
    return lines.filter(F.col("value").startswith("##")).select(
        F.substring_index(text, "=", 1).alias("key"),
        F.when(F.contains(text, F.lit("=")), F.expr("substring(value, 3 + instr(substring(value, 3), '='))"))
        .otherwise("").alias("value"))


def vcf_rows(lines: DataFrame, names: list[str], with_map: bool = True) -> DataFrame:
    """SRC-10: typed rows; POS and QUAL that do not parse are NULL, a row of fewer than 8 fields is an error.

    INFO becomes a map, or stays text without ``with_map``, from which ``info_field`` takes one or two fields far cheaper.
    FORMAT and sample columns stay text.
    """
    body = lines.filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    parts = F.split(F.rtrim("value", F.lit("\r")), "\t", -1)
    checked = F.when(F.size(parts) >= len(VCF_COLUMNS), parts).otherwise(
        F.raise_error(F.concat(F.lit("row with fewer than 8 fields: "), F.col("value"))).cast("array<string>"))
    split = body.select(checked.alias("_p"))
    rows = split.select(*[F.try_element_at("_p", F.lit(i + 1)).alias(n) for i, n in enumerate(names)])
    typed = {"POS": F.col("POS").try_cast("bigint"), "QUAL": F.col("QUAL").try_cast("double")}
    return rows.withColumns(typed | ({"INFO": info_map(F.col("INFO"))} if with_map else {}))


def read_vcf(spark: SparkSession, path: str, partitions: int | None = None) -> Variants:
    """SRC-10: plain or gzip file. Gzip cannot be split: pass ``partitions`` to spread what follows."""
    lines = spark.read.text(path)
    names = vcf_header(lines)
    body = lines.repartition(partitions) if partitions else lines
    fixed = len(VCF_COLUMNS) + ("FORMAT" in names)
    return Variants(vcf_rows(body, names), vcf_metadata(lines), names[fixed:])


def genotypes(variants: Variants) -> DataFrame:
    """Sample columns as rows: CHROM, POS, REF, ALT, sample, key, value."""
    keys = F.split("FORMAT", ":")
    cells = F.array(*[F.struct(F.lit(s).alias("sample"), F.split(F.col(f"`{s}`"), ":").alias("v"))
                      for s in variants.samples])
    per_sample = variants.rows.select("CHROM", "POS", "REF", "ALT", keys.alias("k"), F.inline(cells))
    pairs = F.arrays_zip(F.col("k").alias("key"), F.col("v").alias("value"))
    return (per_sample.select("CHROM", "POS", "REF", "ALT", "sample", F.inline(pairs).alias("key", "value"))
            .filter(F.col("key").isNotNull()))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11: read_id, description, seq, qual of one or more files, plain or gzip; every record has four lines or is an error.

    The text is cut before each line that starts with ``@``, so files split over tasks whatever the ids look like. A
    piece is a whole record, a record without its quality line, or the quality line that starts with ``@``. The last two
    kinds alternate in a file; they are numbered inside each file split, offset by the counts of the splits before, and
    joined two by two. Nothing else is shuffled or ordered.
    """
    cut = spark.read.option("lineSep", "\n@").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), _record_lines().alias("lines"))
    single = F.size("lines") == 1
    whole = cut.filter(F.size("lines") == 4).select("lines")
    odd = cut.filter(F.size("lines") != 4)
    kind = F.when(single, "quality").when((F.size("lines") == 3) & F.col("lines")[2].startswith("+"), "head").otherwise(
        F.raise_error(F.concat(F.lit("not a read record of four lines: "), F.array_join("lines", "|"))).cast("string"))
    odd = odd.withColumn("kind", kind)
    counts = odd.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("place"))
    numbered = odd.withColumn("at", inside).join(offsets, ["file", "block"])
    pair = F.floor((F.col("before") + F.col("at") - 1) / 2)
    joined = numbered.groupBy("file", pair.alias("pair")).agg(
        F.max(F.when(F.col("kind") == "head", F.col("lines"))).alias("head"),
        F.max(F.when(F.col("kind") == "quality", F.col("lines"))).alias("quality"))
    mended = joined.select(F.when(F.col("head").isNotNull() & F.col("quality").isNotNull(), F.concat(
        "head", F.array(F.concat(F.lit("@"), F.col("quality")[0])))).otherwise(
            F.raise_error(F.lit("a read record without a line")).cast("array<string>")).alias("lines"))
    return _reads(whole.unionByName(mended))


def _record_lines() -> Column:
    """Lines of a piece of a read file without ``@``; blank lines after the last record are left out."""
    lines = F.split(F.regexp_replace("value", "\r", ""), "\n", -1)
    rest = F.slice(lines, 5, F.greatest(F.size(lines) - 4, F.lit(0)))
    blank = F.forall(rest, lambda x: x == "")
    alone = F.forall(F.slice(lines, 2, F.size(lines)), lambda x: x == "")
    kept = F.when((F.size(lines) > 4) & blank, F.slice(lines, 1, 4)).otherwise(lines)
    # a file's first header still has its sign; a quality line alone has lost the one that counts
    return F.when(alone, F.slice(lines, 1, 1)).otherwise(
        F.transform(kept, lambda x, i: F.when(i == 0, F.regexp_replace(x, "^@", "")).otherwise(x)))


def fastq_records(records: DataFrame) -> DataFrame:
    """Reads of whole records in ``value``: header, sequence, ``+`` and quality on four lines."""
    lines = _record_lines()
    checked = F.when(F.size(lines) == 4, lines).otherwise(
        F.raise_error(F.lit("a read record is not four lines")).cast("array<string>"))
    return _reads(records.select(checked.alias("lines")))


def _reads(records: DataFrame) -> DataFrame:
    lines = F.col("lines")
    good = lines[2].startswith("+") & (F.length(lines[1]) == F.length(lines[3]))
    checked = F.when(good, lines).otherwise(F.raise_error(F.concat(F.lit("not a read record: "), lines[0])).cast("array<string>"))
    head = F.col("_l")[0]
    return records.select(checked.alias("_l")).select(
        F.substring_index(head, " ", 1).alias("read_id"),
        F.when(F.contains(head, F.lit(" ")), F.regexp_extract(head, r"^\S+ (.*)$", 1)).alias("description"),
        F.col("_l")[1].alias("seq"), F.col("_l")[3].alias("qual"))


def read_fasta(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """SRC-12: id, description, seq, length, gc_content; sequence lines are joined."""
    records = spark.read.option("lineSep", "\n>").text(path)
    return fasta_records(records.repartition(partitions) if partitions else records)


def fasta_records(records: DataFrame) -> DataFrame:
    from strandlake.functions.sequence import gc_fraction
    text = F.regexp_replace(F.regexp_replace("value", "\r", ""), "^>", "")
    parts = F.split(text, "\n", 2)
    rows = records.filter(F.trim("value") != "").select(
        parts[0].alias("_head"), F.regexp_replace(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), r"\s", "")
        .alias("seq"))
    return rows.select(F.regexp_extract("_head", r"^(\S*)", 1).alias("id"), F.col("_head").alias("description"), "seq",
                       F.length("seq").alias("length"), (gc_fraction(F.col("seq")) * 100).alias("gc_content"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """SRC-13: text alignments; header lines are left out."""
    return sam_rows(spark.read.text(path))


def sam_rows(lines: DataFrame) -> DataFrame:
    """The eleven fixed fields typed, optional tags as a map, strand and end of the aligned span."""
    parts = F.split(F.rtrim("value", F.lit("\r")), "\t", -1)
    body = lines.filter(~F.col("value").startswith("@") & (F.trim("value") != "")).select(parts.alias("_p"))
    numbers = {"flag", "pos", "mapq", "mate_pos", "insert_len"}
    fields = [(F.col("_p")[i].try_cast("int") if n in numbers else F.col("_p")[i]).alias(n)
              for i, n in enumerate(SAM_COLUMNS)]
    tags = F.map_from_entries(F.transform(
        F.slice("_p", len(SAM_COLUMNS) + 1, F.greatest(F.size("_p") - len(SAM_COLUMNS), F.lit(0))),
        lambda x: F.struct(F.substring_index(x, ":", 1).alias("k"), F.regexp_extract(x, r"^[^:]*:[^:]*:(.*)$", 1).alias("v"))))
    span = F.aggregate(F.regexp_extract_all("cigar", F.lit(r"(\d+)[MDN=X]"), F.lit(1)), F.lit(0),
                       lambda acc, x: acc + x.cast("int"))
    rows = body.select(*fields, tags.alias("tags"))
    return rows.withColumns({"strand": F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+"),
                             "start": F.col("pos") - 1, "end": F.col("pos") - 1 + span})

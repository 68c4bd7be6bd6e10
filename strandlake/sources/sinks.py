"""Writers and file-layout tools. Every writer takes a path on storage all executors share."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sequence line width, file sizes aimed at when compacting.
FASTA_WIDTH = 80
TARGET_FILE_BYTES = 256 * 1024 * 1024


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", sort_by: list[str] | None = None) -> None:
    """SNK-01: Snappy Parquet; sorting inside tasks makes row-group statistics selective, without a shuffle."""
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    out.write.mode(mode).option("compression", "snappy").parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """SNK-02: CSV or TSV with header."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def write_partitioned(df: DataFrame, path: str, keys: list[str], mode: str = "overwrite",
                      files_per_key: int = 1) -> None:
    """SNK-03: ``key=value`` folders.

    Rows are shuffled on the keys plus a salt, so that a folder gets about ``files_per_key`` files,
    a hot key is not one task, and no task opens a file in every folder.
    """
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_key))
    (df.withColumn("_salt", salt).repartition(*keys, "_salt").drop("_salt")
     .write.mode(mode).partitionBy(*keys).parquet(path))


def append_batches(batches: list[DataFrame], path: str) -> None:
    """DML-13: append batches to one table."""
    for batch in batches:
        batch.write.mode("append").parquet(path)


def create_table_as(df: DataFrame, name: str, path: str | None = None, keys: list[str] | None = None) -> None:
    """SNK-04: table from a query; with a path the table is external."""
    writer = df.write.mode("overwrite").format("parquet")
    if keys:
        writer = writer.partitionBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def fasta_text(df: DataFrame, head: str = "id", seq: str = "seq", width: int = FASTA_WIDTH) -> DataFrame:
    """SNK-06: one text record per sequence, wrapped."""
    wrapped = F.regexp_replace(F.col(seq), f"(.{{{width}}})(?!$)", "$1\n")
    return df.select(F.concat(F.lit(">"), F.col(head), F.lit("\n"), wrapped).alias("value"))


def fastq_text(df: DataFrame) -> DataFrame:
    """SNK-06: one four-line text record per read."""
    return df.select(F.concat(F.lit("@"), F.col("read_id"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual"))
                     .alias("value"))


def write_text(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.option("compression", compression) if compression else writer).text(path)


def round_trip_equal(df: DataFrame, back: DataFrame, places: int = 6) -> bool:
    """SNK-07: whether an export read back holds the same rows after rounding doubles."""
    from strandlake.operators.sets import same_rows

    def rounded(x):
        return x.select(*[F.round(c, places).alias(c) if t in ("double", "float") else F.col(c) for c, t in x.dtypes])

    return same_rows(rounded(df), rounded(back))


def layout_report(frames: dict[str, DataFrame]) -> DataFrame:
    """SNK-08: files, total, least, mean and greatest file size per stored layout."""
    out = None
    for name, df in frames.items():
        files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).groupBy(
            "f").agg(F.first("s").alias("s"))
        row = files.agg(F.count("*").alias("files"), F.sum("s").alias("total_bytes"), F.min("s").alias("min_bytes"),
                        F.avg("s").alias("avg_bytes"), F.max("s").alias("max_bytes")).withColumn("layout", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


def compact(spark: SparkSession, source: str, target: str, keys: list[str] | None = None,
            target_bytes: int = TARGET_FILE_BYTES) -> int:
    """SNK-09: rewrite small files into files of about the target size; returns the number aimed at.

    The result goes to a new path, so readers of the old files are not disturbed and a lost job loses nothing.
    """
    df = spark.read.parquet(source)
    total = layout_report({"source": df}).first()["total_bytes"] or 0
    files = max(1, math.ceil(total / target_bytes))
    if keys:
        write_partitioned(df, target, keys, files_per_key=max(1, files // 100))
    else:
        df.repartition(files).write.mode("overwrite").parquet(target)
    return files

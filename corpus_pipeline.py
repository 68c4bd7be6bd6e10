"""Corpus pipeline: toxic documents out, lines deduplicated, near-copies out, sources mixed, tokens encoded.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; what it gives is written as Parquet and read again as the
next stage's documents. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.base import prepare, stored
from strandlake.llm.bpe import encode_decode
from strandlake.llm.library_tokens import token_count
from strandlake.llm.line_dedup import dedup_lines
from strandlake.llm.mixing import mix
from strandlake.llm.simhash import keep_one_per_group
from strandlake.llm.toxicity import drop_toxic


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the first of each group of like lines only."""
    return dedup_lines(docs)


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return keep_one_per_group(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks, each at least once."""
    return mix(docs, tokens=token_count(F.col("text")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded text."""
    return encode_decode(docs, with_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", unique_lines),
    ("simhash near-dedup", unique_documents),
    ("source mixing", mixed),
    ("bpe encoding", tokens),
]

#: Trained weights, MinHash and BPE merging are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

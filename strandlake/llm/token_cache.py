"""Token counts with a cache of stored counts by content digest and tokenizer version."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import vocabulary
from strandlake.llm.base import prepare, stored, texts
from strandlake.llm.library_tokens import library_encoder
from strandlake.session import scratch_path

LIMIT = 512
SCHEMA = "digest binary, version string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and the release of the library that reads it."""
    from importlib.metadata import version

    with open(path, "rb") as f:
        digest = hashlib.file_digest(f, "sha256").hexdigest()
    return f"{digest}:{version('sentencepiece' if path.endswith('.model') else 'tokenizers')}"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) stored for a tokenizer version; empty if there is no cache yet."""
    found = spark.read.schema(SCHEMA).parquet(cache) if _exists(spark, cache) else spark.createDataFrame([], SCHEMA)
    return found.where(F.col("version") == version).select("digest", "n_tokens")


def count_tokens(docs: DataFrame, cache: str | None = None, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Every row as (doc_id, n_bytes, n_tokens, over_limit), encoding only texts whose count is not in ``cache``.

    The normalised content is the text itself, null as the empty text: any change of it could change the count. Its
    SHA-256 is joined with the cache; of the texts that are missing one row each is encoded and their counts are appended
    to the cache, which other tokenizer versions may share. Without ``cache`` a new one is made in the shared folder.
    Repeated rows each give a row; other columns are ignored; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    prepare(spark)
    path = path or vocabulary.default_path()
    cache = cache or scratch_path(spark, "token-counts")
    version = tokenizer_version(path)
    digest = F.unhex(F.sha2(F.col("text"), 256))
    source = texts(docs).withColumn("digest", digest)
    rows = stored(source.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    # the row to encode for each missing digest: that of its smallest doc_id
    missing = rows.groupBy("digest").agg(F.min("doc_id").alias("first")).join(
        read_cache(spark, cache, version), "digest", "left_anti")
    missing = stored(missing.withColumnRenamed("digest", "wanted"), "missing-digests")
    chosen = source.join(missing, F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("digest") == F.col("wanted")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path)
        for b in batches:
            counts = [len(ids) for ids in encoder.encode(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    encoded = chosen.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")
    encoded.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)
    # repeated rows, or two jobs at a time, may store a count twice
    counts = stored(read_cache(spark, cache, version).join(rows.select("digest").distinct(), "digest", "left_semi")
                    .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token-counts-found")
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

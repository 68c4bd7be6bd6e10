"""Token-id files: documents encoded, written as patched frame-of-reference blocks in order of doc_id, and read back."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.llm import pfor, vocabulary
from strandlake.llm.base import prepare, texts
from strandlake.llm.library_tokens import library_encoder
from strandlake.session import scratch_path

#: Ids from which a chunk is closed, at the end of a document.
CHUNK = 1 << 18
END_ID = 0


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID,
                      chunk_ids: int = CHUNK) -> None:
    """Encode every row of ``docs`` (null text: empty), append ``end_id`` and write the ids in ascending doc_id order.

    The texts are ranged by doc_id (nulls first) and encoded once, in the tasks that write. A file of ``folder`` is one
    range; its rows are chunks of whole documents: ``part`` and ``chunk`` give the order, ``n_ids`` the ids, ``docs`` each
    document's id and number of ids, ``payload`` the blocks (see ``pfor``). Spark's commit makes the folder appear whole
    or not at all. Rows that repeat a doc_id are documents of their own, in any order among themselves.
    """
    prepare(docs.sparkSession)
    path = path or vocabulary.default_path()
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("n", pa.int64())]))

    def chunk(part: int, number: int, ids: list, of: list) -> pa.RecordBatch:
        flat = np.concatenate(ids)
        columns = [pa.array([part], pa.int64()), pa.array([number], pa.int64()), pa.array([len(flat)], pa.int64()),
                   pa.array([[{"doc_id": d, "n": n} for d, n in of]], kind), pa.array([pfor.pack(flat)], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["part", "chunk", "n_ids", "docs", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = library_encoder(path), TaskContext.get().partitionId()
        ids, of, size, number = [], [], 0, 0
        end = np.array([end_id])
        for b in batches:
            for doc_id, found in zip(b.column(0).to_pylist(), encoder.encode(b.column(1).to_pylist())):
                ids += (found, end)
                of.append((doc_id, len(found) + 1))
                size += len(found) + 1
                if size >= chunk_ids:
                    yield chunk(part, number, ids, of)
                    ids, of, size, number = [], [], 0, number + 1
        if ids:
            yield chunk(part, number, ids, of)

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    chunks = ordered.mapInArrow(run, "part long, chunk long, n_ids long, docs array<struct<doc_id: long, n: long>>, payload binary")
    chunks.write.parquet(folder)


def chunk_starts(chunks: DataFrame) -> DataFrame:
    """(part, chunk, start): the ids of all chunks before, from sums within parts and then over parts.

    The ordered sums run over one row per chunk of a part and one row per part; payloads are not read.
    """
    before = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    inside = chunks.select("part", "chunk", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("inside"))
    totals = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("offset"))
    return inside.join(offsets, "part").select("part", "chunk", (F.col("offset") + F.col("inside")).alias("start"))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the files, its ids unpacked from the blocks."""
    prepare(spark)
    chunks = spark.read.parquet(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, number, of, payload in zip(*(b.column(i).to_pylist() for i in range(4))):
                ids = pfor.unpack(payload).astype("<u4")
                n = np.array([d["n"] for d in of], np.int64)
                ends = np.cumsum(n)
                crc = [crc32(ids[i:j]) for i, j in zip((ends - n).tolist(), ends.tolist())]
                rows = len(of)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * rows, pa.int64()), pa.array([number] * rows, pa.int64()),
                     pa.array([d["doc_id"] for d in of], pa.int64()), pa.array(ends - n), pa.array(n), pa.array(crc, pa.int64())],
                    names=["part", "chunk", "doc_id", "inside", "n_tokens", "ids_crc32"])

    found = chunks.select("part", "chunk", "docs", "payload").mapInArrow(
        run, "part long, chunk long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    starts = chunk_starts(chunks.select("part", "chunk", "n_ids"))
    return found.join(starts, ["part", "chunk"]).select(
        "doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_files_round_trip(docs: DataFrame, folder: str | None = None, path: str | None = None, chunk_ids: int = CHUNK) -> DataFrame:
    """Write the files of ``docs`` to ``folder`` (default: a new one in the shared folder) and read them back.

    An empty table gives an empty table.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    write_token_files(docs, folder, path, chunk_ids=chunk_ids)
    return read_token_files(spark, folder)

"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from strandlake.llm.base import ASCII_LOWER, prepare, text_key, texts

#: Hashed features: the weights are at most this many numbers, which bounds what is broadcast (8 MB as pairs).
FEATURES = 1 << 20
#: Labelled rows that the model is fitted on at most (those with the smallest hash of doc_id): they meet in one task.
TRAIN_ROWS = 16_000
#: Bytes of feature lists that the model is fitted on at most; the first ones in the order of that hash. An ordinary text
#: has about two kilobytes of them, so only very long texts meet this bound.
TRAIN_BYTES = 1 << 28
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 10.0, 0.1
FOLDS = 5
#: Bytes at the ends of a word that are not part of it.
PUNCTUATION = b".,;:!?\"'()[]{}<>*_|-"
#: Bytes of a text whose words are held as objects at once.
PIECE = 1 << 22
#: Words whose hashes a worker remembers.
REMEMBERED = 300_000


class _WordHashes(dict):
    """Hash of a word without its punctuation, 0 if nothing is left; remembers a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(PUNCTUATION)
        value = (crc32(bare) or 1) if bare else 0
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value
        return value


_hashes = _WordHashes()


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """Words of a long text, a few megabytes at a time, cut at a blank."""
    start = 0
    while start < len(data):
        end = start + PIECE
        if end < len(data):
            cut = max(data.rfind(b" ", start, end), data.rfind(b"\n", start, end))
            end = cut if cut > start else len(data)
        yield data[start:end].split()
        start = end


def features(text: str) -> np.ndarray:
    """Distinct hashed features of a text: words, neighbouring words, and words with one between them."""
    parts = []
    for words in _pieces(text.encode().translate(ASCII_LOWER)):
        parts.append(np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words)))
    h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    h = h[h != 0]
    one = h * np.uint64(0x9E3779B97F4A7C15)
    two = (h[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[1:]) * np.uint64(0x9FB21C651E98DF25)
    gap = (h[:-2] * np.uint64(0xD6E8FEB86659FD93) + h[2:]) * np.uint64(0xA0761D6478BD642F)
    return (np.concatenate([one, two, gap]) >> np.uint64(44)).astype(np.uint32)


def ftrl(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA,
         l1: float = L1, l2: float = L2) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal with a rate for each coordinate; returns the weights that are not zero, and the intercept.

    z and n are kept for each coordinate; a weight is zero until |z| passes l1, so rare and neutral features vanish. The
    intercept has no l1.
    """
    z, n = np.zeros(FEATURES), np.zeros(FEATURES)
    bz = bn = 0.0
    for _ in range(epochs):
        for x, y in zip(rows, labels):
            zx, nx = z[x], n[x]
            root = np.sqrt(nx)
            w = np.where(np.abs(zx) <= l1, 0.0, (np.sign(zx) * l1 - zx) / ((beta + root) / alpha + l2))
            b = -bz / ((beta + bn ** 0.5) / alpha + l2)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + b, -35, 35))) - y
            new = nx + g * g
            z[x] = zx + g - (np.sqrt(new) - root) / alpha * w
            n[x] = new
            bz += g - ((bn + g * g) ** 0.5 - bn ** 0.5) / alpha * b
            bn += g * g
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))
    at = np.flatnonzero(w).astype(np.int64)
    return at, w[at], -bz / ((beta + bn ** 0.5) / alpha + l2)


def is_held_out(doc_id: Column) -> Column:
    """True for the fold that is never learned from; a null doc_id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights fitted on at most ``rows`` labelled documents outside the held-out fold.

    Rows without doc_id or label are left out; a doc_id labelled twice counts as toxic if any row says so. Without
    any labelled document the model is empty and scores 0.5 for every text. Feature lists beyond ``TRAIN_BYTES`` are left out.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~is_held_out(F.col("doc_id")))
    there = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(docs.select("doc_id"), "doc_id", "left_semi")
    picked = there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most `rows` ids and labels; of texts that share a doc_id the one with the smallest key counts
    few = texts(docs).join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min_by("text", F.struct(*text_key(F.col("text")))).alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(features(t)).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary()), b.column(2).cast(pa.int32())],
                                             names=["doc_id", "found", "toxic"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("order")
        x = [np.frombuffer(v, np.uint32) for v in pdf["found"]]
        at, w, b = ftrl(x, pdf["toxic"].to_numpy(float))
        return pd.DataFrame({"at": np.append(at, -1), "weight": np.append(w, b)})

    extracted = few.select("doc_id", "text", "toxic").mapInArrow(extract, "doc_id long, found binary, toxic int")
    upto = F.sum(F.octet_length("found")).over(Window.orderBy("order").rowsBetween(Window.unboundedPreceding, 0))
    model = (extracted.select("found", "toxic", F.xxhash64(F.lit(7), "doc_id").alias("order")).withColumn("upto", upto)
             .where(F.col("upto") <= TRAIN_BYTES).select("found", "toxic", "order")
             .groupBy(F.lit(0).alias("all")).applyInPandas(fit, "at long, weight double").toPandas())
    at, w = model["at"].to_numpy(np.int64), model["weight"].to_numpy(float)
    return at[at >= 0], w[at >= 0], float(w[at < 0][0]) if (at < 0).any() else 0.0


def scorer(model: tuple[np.ndarray, np.ndarray, float]):
    """A column function from text to score; the weights travel with it as index and value pairs."""
    at, weight, bias = model
    at, weight = at.astype(np.uint32), weight.astype(np.float32)

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = np.zeros(FEATURES, np.float32)
        dense[at] = weight
        for values in batches:
            out = []
            for text in values:
                found = features(text)
                used = np.unique(found[dense[found] != 0])
                out.append(1.0 / (1.0 + np.exp(-np.clip(dense[used].sum(dtype=np.float64) + bias, -35, 35))))
            yield pd.Series(out, dtype="float64")

    return score


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Every row of ``docs`` as (doc_id, held_out, score, predicted).

    Only the text enters a score; null counts as the empty text, whose score is that of the intercept. Repeated rows
    are scored alike, other columns are ignored, and an empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    score = scorer(train(docs, labels, rows))
    return texts(docs).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")).select(
        "*", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without the rows whose text is predicted toxic; all columns stay."""
    prepare(docs.sparkSession)
    score = scorer(train(docs, labels, rows))
    return docs.where(score(F.coalesce(docs["text"], F.lit(""))) < 0.5)

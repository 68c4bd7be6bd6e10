"""SimHash near-duplicates over a byte-position inverted index with count filtering."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from strandlake.llm.base import ASCII_LOWER, Intermediate, fresh, prepare, stored, text_key, texts
from strandlake.llm.blocks import distinct_buckets, in_blocks, links_within
from strandlake.llm.components import components

BYTES = 8
#: Nodes of one part of a hot posting list.
BLOCK = 1024
#: Shingles whose hashes are held at once for one text.
PIECE = 1 << 16


def simhash(text: str, width: int = 4) -> int:
    """64-bit fingerprint: bit k is set when over half of the shingle hashes (XXH64, seed 42) have it."""
    words = text.encode().translate(ASCII_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) >= width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for k in range(0, len(starts), PIECE):
        spans = zip(starts[k: k + PIECE].tolist(), ends[k: k + PIECE].tolist())
        raw = np.frombuffer(b"".join([digest(joined[i:j], 42) for i, j in spans]), np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(starts))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


@F.pandas_udf(LongType())
def _fingerprints(values: pd.Series) -> pd.Series:
    return pd.Series([simhash(x) for x in values], dtype="int64")


def near(values: list, i: int, others: list[int], bits: int) -> np.ndarray:
    """Which of the other fingerprints share the guaranteed number of positional bytes and differ in few enough bits."""
    rest = np.array([values[j] for j in others], np.int64).view(np.uint64) ^ np.int64(values[i]).view(np.uint64)
    tally = (rest.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    return (tally >= BYTES - bits) & (np.bitwise_count(rest) <= bits)


def fingerprint_components(prints: DataFrame, bits: int = 4) -> DataFrame:
    """``prints`` (node long fingerprint, distinct) to (node, component) for every fingerprint that has a link.

    Two fingerprints that differ in at most ``bits`` bits share at least 8 - bits bytes at their positions. A posting
    list is therefore kept for each set of that many positions with its bytes, which are the entries of the byte-position
    index that a pair with the guaranteed tally has in common; pairs below the tally never meet. In a list the shared
    bytes of each pair are tallied over all eight positions and pairs that reach the minimum are verified by their
    differing bits. Long lists are compared part against part.
    """
    if not 0 <= bits < BYTES:
        raise ValueError("bits must be from 0 to 7")
    sets = list(combinations(range(BYTES), BYTES - bits))
    masks = [sum(0xFF << (8 * p) for p in s) for s in sets]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("node").bitwiseAND(F.lit(m))) for k, m in enumerate(signed)])
    postings = prints.select("node", F.explode(keys).alias("bucket"))
    with Intermediate(prints.sparkSession) as tables:
        buckets = stored(distinct_buckets(postings), "posting-lists")
        members = postings.join(buckets, "bucket").withColumn("value", F.col("node"))
        links = links_within(in_blocks(members, BLOCK), "value", lambda v, i, others: near(v, i, others, bits))
        return tables.keep(stored(components(links), "fingerprint-components"))


def _classes(prints: DataFrame, least: Column, bits: int) -> DataFrame:
    """(node, component_id) of every fingerprint: the minimum ``least`` over the rows of its component."""
    nodes = stored(prints.groupBy("node").agg(least.alias("first")), "fingerprint-nodes")
    linked = fingerprint_components(nodes.select("node"), bits)
    first = nodes.join(linked, "node").groupBy("component").agg(F.min("first").alias("component_id"))
    of = linked.join(first, "component").select("node", "component_id")
    return stored(nodes.join(of, "node", "left").select("node", F.coalesce("component_id", "first").alias("component_id")),
                  "fingerprint-classes")


def simhash_components(docs: DataFrame, bits: int = 4) -> DataFrame:
    """Every row of ``docs`` as (doc_id, print long, component_id): the smallest doc_id linked with it, itself included.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows and equal texts share a
    fingerprint; each row gives a row. A null doc_id is never a component_id unless its component has no other; other
    columns are ignored. An empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    with Intermediate(docs.sparkSession) as tables:
        prints = stored(texts(docs).select("doc_id", _fingerprints("text").alias("node")), "fingerprints")
        known = _classes(prints, F.min("doc_id"), bits)
        tables.keep(prints)
        tables.keep(known)
    return prints.join(known, "node").select("doc_id", F.col("node").alias("print"), "component_id")


def keep_one_per_group(docs: DataFrame, bits: int = 4) -> DataFrame:
    """``docs`` with one row of each SimHash component: the first by doc_id and text key; all columns stay.

    Rows that repeat doc_id and text are one document and stay once; rows that share only their doc_id are told apart by
    their texts. Rows without doc_id always stay, as nothing names them.
    """
    prepare(docs.sparkSession)
    names = {c: fresh(docs, f"kept_{c}") for c in ("doc_id", "t1", "t2", "times")}
    keys = ["doc_id", "t1", "t2"]
    with Intermediate(docs.sparkSession) as tables:
        t1, t2 = text_key(F.col("text"))
        prints = stored(texts(docs).select("doc_id", t1.alias("t1"), t2.alias("t2"), _fingerprints("text").alias("node")),
                        "fingerprints")
        known = _classes(prints, F.min(F.when(F.col("doc_id").isNotNull(), F.struct(*keys))), bits)
        firsts = known.where("component_id is not null").select("component_id.*").distinct()
        side = tables.keep(stored(prints.join(firsts, keys).groupBy(*[F.col(c).alias(names[c]) for c in keys]).agg(
            F.count("*").alias(names["times"])), "kept-documents"))
    k1, k2 = text_key(F.coalesce(docs["text"], F.lit("")))
    kept = docs.join(side, (docs["doc_id"] == F.col(names["doc_id"])) & (k1 == F.col(names["t1"])) & (k2 == F.col(names["t2"])))
    nameless = docs.where("doc_id is null")
    if side.where(F.col(names["times"]) > 1).isEmpty():
        return kept.select(*docs.columns).unionByName(nameless)
    single = kept.where(F.col(names["times"]) == 1).select(*docs.columns)
    again = kept.where(F.col(names["times"]) > 1).dropDuplicates([names[c] for c in keys]).select(*docs.columns)
    return single.unionByName(again).unionByName(nameless)

"""Nearest neighbours by inner product over randomly rotated one-bit codes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.base import prepare, stored

K = 20
QUERY_EVERY = 20
#: Vectors whose mean is the centre that codes are taken around (those with the smallest hash of vec_id).
SAMPLE = 4096
#: Bits of a rotated query's components when inner products are taken from packed bits.
QUERY_BITS = 8
#: Standard deviations of the estimate's error that the bounds allow for.
EPSILON = 3.0
#: Rows of a block of queries and of a block of candidates; a pair of blocks is one group of a task.
QUERY_BLOCK, CANDIDATE_BLOCK = 8192, 8192
SEED = 11


def usable(vec: Column) -> Column:
    """Not null, with finite components only, some of them not zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0)


@cache
def rotation(d: int, seed: int = SEED) -> np.ndarray:
    """A random rotation: the orthogonal part of a matrix of normal numbers, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed codes as rows of 64-bit words, length of each residual, product of code and direction)."""
    residual = vectors - centre
    norm = np.linalg.norm(residual, axis=1)
    turned = residual @ turn / np.where(norm > 0, norm, 1.0)[:, None]
    d = vectors.shape[1]
    bits = np.zeros((len(vectors), -(-d // 64) * 64), np.uint8)
    bits[:, :d] = turned > 0
    codes = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    return codes, norm, np.abs(turned).sum(axis=1) / math.sqrt(d)


class CodedBlock:
    """Candidates of one block: codes with their correction scalars, and the vectors that are reranked."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes, norm, factor, centre: np.ndarray, turn: np.ndarray):
        self.ids, self.vectors, self.centre, self.turn = ids, vectors, centre, turn
        self.codes, self.norm, self.factor = codes, norm, np.maximum(factor, 1e-9)
        self.ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        d = vectors.shape[1]
        spread = np.sqrt(np.maximum(0.0, 1 - self.factor ** 2)) / self.factor
        self.error = EPSILON * spread / math.sqrt(max(1, d - 1))

    def bounds(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the inner product of the query with each candidate, from packed bits."""
        d = len(query)
        size = float(np.linalg.norm(query))
        turned = query @ self.turn / size
        low = float(turned.min())
        step = max((float(turned.max()) - low) / ((1 << QUERY_BITS) - 1), 1e-12)
        units = np.rint((turned - low) / step).astype(np.int64)
        padded = np.zeros(self.codes.shape[1] * 64, np.int64)
        padded[:d] = units
        total = np.zeros(len(self.ids), np.int64)
        for j in range(QUERY_BITS):
            plane = np.packbits((padded >> j & 1).astype(np.uint8), bitorder="little").view("<u8")
            total += np.bitwise_count(self.codes & plane).sum(axis=1, dtype=np.int64) << j
        on = low * self.ones + step * total
        product = (2 * on - turned.sum()) / math.sqrt(d)
        slack = self.error + step * math.sqrt(d) / self.factor
        base, scale = float(query @ self.centre), size * self.norm
        middle = base + scale * product / self.factor
        return middle - scale * slack, middle + scale * slack

    def nearest(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, exact products) of the block's k best, of those whose upper bound reaches the k-th best lower bound."""
        lower, upper = self.bounds(query)
        other = self.ids != query_id
        lower = np.where(other, lower, -np.inf)
        cut = np.partition(lower, len(lower) - k)[len(lower) - k] if len(lower) > k else -np.inf
        left = np.flatnonzero(other & (upper >= cut))
        score = (self.vectors[left] * query).sum(axis=1)
        order = np.lexsort((self.ids[left], -score))[:k]
        return self.ids[left][order], score[order]


def nearest_neighbours(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row whose vec_id is divisible by ``query_every``.

    ``vectors`` has vec_id long and vec array<float>. Every usable row is coded and is a candidate for every query but
    the one of its own vec_id; nearness is the inner product in double precision, ties go to the smaller vec_id. Rows
    that repeat a vec_id count once, with the smallest of their vectors; rows without vec_id take no part; vectors of
    different lengths do not meet. Other columns are ignored.

    Codes are made once. Queries and candidates are dealt to blocks by a hash, and each pair of blocks is one group: a
    task holds one block of each, estimates products from the codes and takes exact products of those vectors only that
    the error bounds cannot rule out. k rows of each pair of blocks and query are merged by a window per query.
    """
    spark = vectors.sparkSession
    prepare(spark)
    valid = vectors.where("vec_id is not null").where(usable(F.col("vec"))).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    rows = stored(valid.withColumn("d", F.size("vec")), "vectors")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("d", F.posexplode("vec").alias("at", "x"))
    means = sample.groupBy("d", "at").agg(F.avg("x").alias("m")).collect()  # at most SAMPLE vectors' components
    centres: dict[int, np.ndarray] = {}
    for r in means:
        centres.setdefault(r["d"], np.zeros(r["d"]))[r["at"]] = r["m"]

    def centre_of(d: int) -> np.ndarray:
        return centres[d] if d in centres else np.zeros(d)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for b in batches:
            sizes = b.column(2).to_numpy()
            for d in np.unique(sizes).tolist():
                part = b.filter(pa.array(sizes == d))
                x = np.array(part.column(1).to_pylist(), np.float64)
                turn = turns.setdefault(d, rotation(d))
                codes, norm, factor = encode(x, centre_of(d), turn)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array([c.tobytes() for c in codes], pa.binary()),
                     pa.array(norm), pa.array(factor)], names=["vec_id", "vec", "d", "code", "norm", "factor"])

    kind = dict(rows.dtypes)["vec"]
    coded = stored(rows.mapInArrow(code, f"vec_id long, vec {kind}, d int, code binary, norm double, factor double"), "codes")
    queries = coded.where(F.col("vec_id") % query_every == 0)
    n, q = coded.count(), queries.count()
    candidate_blocks, query_blocks = -(-n // CANDIDATE_BLOCK) or 1, -(-q // QUERY_BLOCK) or 1

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    def all_blocks(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    asked = queries.select(F.lit(0).alias("role"), block(query_blocks).alias("qb"), all_blocks(candidate_blocks).alias("cb"), "*")
    offered = coded.select(F.lit(1).alias("role"), all_blocks(query_blocks).alias("qb"), block(candidate_blocks).alias("cb"), "*")
    keys = ["d", "qb", "cb"]
    together = asked.unionByName(offered).select(*keys, "role", "vec_id", "vec", "code", "norm", "factor")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(group: list[pa.RecordBatch]) -> pa.RecordBatch | None:
            t = pa.Table.from_batches(group)
            role = t.column("role").to_numpy()
            ids = t.column("vec_id").to_numpy()
            ask, offer = role == 0, role == 1
            if not ask.any() or not offer.any():
                return None
            x = np.array(t.column("vec").combine_chunks().flatten(), np.float64).reshape(len(ids), -1)
            codes = np.frombuffer(b"".join(t.column("code").filter(pa.array(offer)).to_pylist()), "<u8").reshape(int(offer.sum()), -1)
            d = x.shape[1]
            held = CodedBlock(ids[offer], x[offer], codes, t.column("norm").to_numpy()[offer],
                              t.column("factor").to_numpy()[offer], centre_of(d), rotation(d))
            out: list = [[], [], []]
            for query_id, query in zip(ids[ask].tolist(), x[ask]):
                found, score = held.nearest(query_id, query, k)
                out[0].append(np.full(len(found), query_id))
                out[1].append(found)
                out[2].append(score)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["query_id", "vec_id", "score"])

        current, group = None, []
        for b in batches:
            parts = np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((parts[1:] != parts[:-1]).any(axis=1)) + 1).tolist(), len(parts)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                key = tuple(parts[i].tolist())
                if key != current and group:
                    if (done := answer(group)) is not None:
                        yield done
                    group = []
                current = key
                group.append(b.slice(i, j - i))
        if group and (done := answer(group)) is not None:
            yield done

    found = together.repartition(*keys).sortWithinPartitions(*keys, "role", "vec_id").mapInArrow(
        search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

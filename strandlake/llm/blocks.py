"""Comparison of the members of buckets, hot buckets cut into blocks; only links leave a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def distinct_buckets(postings: DataFrame, with_first: bool = False) -> DataFrame:
    """Of ``postings`` (bucket, node): each bucket of two or more nodes as ``(bucket, size)``, with its smallest node as
    ``first`` if asked.

    Buckets with the same members (equal size and equal XOR of two 64-bit hashes of the nodes) say the same, so the
    smallest of them stays. Counting is pre-aggregated before the shuffle.
    """
    first = [F.min("node").alias("first")] if with_first else []
    sizes = postings.groupBy("bucket").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"), *first)
    again = [F.min("first").alias("first")] if with_first else []
    return sizes.where("size > 1").groupBy("size", "x", "y").agg(F.min("bucket").alias("bucket"), *again).select(
        "bucket", "size", *(["first"] if with_first else []))


def in_blocks(members: DataFrame, block: int) -> DataFrame:
    """Split each bucket of ``members`` (bucket, size, node, ..) into parts of about ``block`` nodes.

    Each pair of parts of one bucket is a group of its own, so every pair of nodes meets in some group while no task
    holds more than about two parts. A bucket of one part is one group.
    """
    parts = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("node", "bucket"), F.col("parts")).cast("int")
    spread = members.withColumn("parts", parts).withColumn("part", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return spread.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")).drop(
        "parts", "part", "other", "size")


def links_within(grouped: DataFrame, payload: str, linked: Callable[[list, int, list[int]], np.ndarray],
                 ready: Callable[[list], list] | None = None, known: str = "node") -> DataFrame:
    """Links (a, b) of nodes in the same (bucket, low, high) group of ``grouped``.

    ``linked(values, i, others)`` tells of the values at ``others`` whether they link to the i-th. It is asked only about
    values that the group has not connected with it yet, so a group of copies costs one pass, and only links that connect
    something new leave the task: the same components, never all pairs. ``ready`` turns the payloads of an Arrow batch
    into the values that are compared. With ``known``, nodes that are equal in that column are connected from the start, and
    links are given in its values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(nodes: list, values: list, out: list) -> None:
            same: dict = {}
            root = [same.setdefault(n, i) for i, n in enumerate(nodes)]

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            left = list(range(len(nodes)))
            while len(left) > 1:
                i, own = left[0], find(left[0])
                left = left[1:]
                others = [j for j in left if find(j) != own]
                if not others:  # all that are left are connected
                    break
                for j in np.asarray(others)[linked(values, i, others)].tolist():
                    x, y = find(i), find(j)
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        out.append((nodes[i], nodes[j]))

        key, nodes, values = None, [], []
        for batch in batches:
            out: list = []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            if ready and columns[4]:
                columns[4] = ready(columns[4])
            for bucket, low, high, node, value in zip(*columns):
                if (bucket, low, high) != key:
                    flush(nodes, values, out)
                    key, nodes, values = (bucket, low, high), [], []
                nodes.append(node)
                values.append(value)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], schema=LINKS)
        out = []
        flush(nodes, values, out)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], schema=LINKS)

    keys = ["bucket", "low", "high"]
    ordered = grouped.select(*keys, F.col(known).alias("node"), payload).repartition(*keys).sortWithinPartitions(*keys, "node")
    return ordered.mapInArrow(run, "a long, b long")

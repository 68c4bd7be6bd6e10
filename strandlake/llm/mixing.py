"""Temperature mixing: source weights by a bisected exponent, realised as budgeted block permutations."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from strandlake.llm.base import Intermediate, fresh, prepare, stored

#: Blocks of a source: its documents are dealt to so many by a hash, whatever the size of the source.
BLOCKS = 4096
#: A source's tokens are repeated at most so often.
MAX_REPEATS = 2.0
#: Levels of the bisection that one pass over the sources decides, and passes.
LEVELS, PASSES = 5, 6
#: Rows of the block plan up to which it is broadcast (about 36 MB as measured); a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000
SEED = 17


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def find_exponent(sources: DataFrame, entropy: float | None, max_repeats: float | None) -> float:
    """The smallest exponent in [0, 1] whose weights keep to the limits; 1 (the given shares) if none does.

    ``sources`` has the positive ``share`` of each source. The entropy of the weights share^a / sum(share^a) and the
    most repetition, (largest / smallest share)^(1 - a), fall as a grows. ``entropy`` is the most allowed, as a part of
    ln(number of sources). Each pass evaluates all midpoints of five levels of the bisection in one aggregation, so the
    sources themselves never reach the driver.
    """
    low, high = 0.0, 1.0
    few = sources.agg(F.count("*"), F.min("share"), F.max("share")).first()
    if not few[0] or few[0] == 1:
        return 1.0

    def fits(a: float, z: float, zl: float) -> bool:
        repeats = (few[2] / few[1]) ** (1 - a)
        spread = (math.log(z) - a * zl / z) / math.log(few[0])
        return (max_repeats is None or repeats <= max_repeats) and (entropy is None or spread <= entropy)

    for _ in range(PASSES):
        cuts = [low + (high - low) * k / (1 << LEVELS) for k in range(1, 1 << LEVELS)]
        p = F.col("share")
        sums = sources.agg(*[F.sum(F.pow(p, F.lit(a))) for a in cuts],
                           *[F.sum(F.pow(p, F.lit(a)) * F.log(p)) for a in cuts]).first()
        left, right = 0, len(cuts) + 1  # places in (low, *cuts, high)
        while right - left > 1:
            mid = (left + right) // 2
            if fits(cuts[mid - 1], sums[mid - 1], sums[len(cuts) + mid - 1]):
                right = mid
            else:
                left = mid
        ends = [low, *cuts, high]
        low, high = ends[left], ends[right]
    return high


def block_of(seed: int = SEED) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.xxhash64("text")), F.lit(BLOCKS)).cast("int")


def mixing_plan(docs: DataFrame, tokens: Column | None = None, entropy: float | None = None,
                max_repeats: float | None = MAX_REPEATS, budget: float | None = None, seed: int = SEED) -> DataFrame:
    """(source, block, whole, part, place): how often each block is read whole, and whether in the last pass too.

    ``tokens`` counts the tokens of a row; without it blank-separated words stand in for them, which are few in a text
    without blanks. Weights are share^a, normalised, with the exponent found by ``find_exponent``. ``budget`` is the tokens to deal out;
    without it the smallest amount that reads every source at least once. A source reads ``floor(budget * weight /
    tokens)`` whole permutations of its blocks, and of one more permutation each block in turn that fits what is then
    left; a block that does not fit is passed over. ``place`` is the block's place in that last permutation. A source without tokens is read once.
    """
    count = word_count(F.col("text")) if tokens is None else F.coalesce(tokens, F.lit(0))
    blocks = stored(docs.select("source", block_of(seed).alias("block"), count.cast("long").alias("n"))
                    .groupBy("source", "block").agg(F.sum("n").alias("n")), "mix-blocks")
    sources = stored(blocks.groupBy("source").agg(F.sum("n").alias("total")), "mix-sources")
    everything = sources.agg(F.sum("total")).first()[0] or 1
    shares = sources.where("total > 0").withColumn("share", F.col("total") / F.lit(float(everything)))
    a = find_exponent(shares, entropy, max_repeats)
    z, largest = shares.agg(F.sum(F.pow("share", F.lit(a))), F.max(F.pow("share", F.lit(1.0 - a)))).first()
    deal = float(budget) if budget is not None else everything * (z or 1.0) * (largest or 1.0)
    asked = F.lit(deal) * F.pow(F.col("total") / F.lit(float(everything)), F.lit(a)) / F.lit(z or 1.0)
    # rounding must not take a whole pass from a source that is to be read exactly once
    repeats = F.when(F.col("total") > 0, F.floor(asked / F.col("total") + F.lit(1e-9))).otherwise(F.lit(1))
    wanted = sources.select(F.col("source").alias("s"), repeats.cast("int").alias("whole"),
                            F.greatest(F.lit(0.0), asked - repeats * F.col("total")).alias("rest"))
    order = F.xxhash64(F.lit(seed + 1), "source", "block")
    placed = blocks.join(wanted, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("rank", order)
    # a window holds one source's blocks, never more than BLOCKS rows
    order = Window.partitionBy("source").orderBy("rank", "block")
    running = placed.withColumns({"place": F.row_number().over(order),
                                  "upto": F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    rows = running.select("source", "block", "whole", "place", "n", "rest", "upto")

    def last_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = 0.0
        for b in batches:  # the window leaves each source's blocks together and in order
            part = []
            for place, n, rest, upto in zip(*(b.column(i).to_pylist() for i in range(3, 7))):
                left = rest if place == 1 else left
                # blocks without tokens always fit, so they go by the share of the pass
                part.append(n <= left if n else upto <= rest)
                left -= n if part[-1] else 0
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(part, pa.bool_()), b.column(3)],
                                             names=["source", "block", "whole", "part", "place"])

    flag = StructField("part", BooleanType())
    kinds = rows.schema
    return rows.mapInArrow(last_pass, StructType([kinds["source"], kinds["block"], kinds["whole"], flag, kinds["place"]]))


def mix(docs: DataFrame, entropy: float | None = None, max_repeats: float | None = MAX_REPEATS,
        budget: float | None = None, tokens: Column | None = None, seed: int = SEED, copy: str | None = None,
        place: str | None = None) -> DataFrame:
    """``docs`` with every row as often as its source's weight asks; all columns stay.

    ``copy`` and ``place`` name added columns: the number of the pass, from 1, and the block's place in that pass's
    permutation. Null sources are one source; null texts have no tokens; rows of a block go together, so equal rows are
    read equally often. Without ``budget`` no row is lost. An empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    with Intermediate(docs.sparkSession) as tables:
        plan = tables.keep(stored(mixing_plan(docs, tokens, entropy, max_repeats, budget, seed), "mix-plan"))
    names = {c: fresh(docs, f"mix_{c}") for c in ("source", "block", "whole", "part", "place", "copy")}
    side = plan.select(*[F.col(c).alias(n) for c, n in names.items() if c != "copy"])
    if plan.count() <= BROADCAST_ROWS:
        side = F.broadcast(side)
    picked = docs.join(side, docs["source"].eqNullSafe(F.col(names["source"])) & (block_of(seed) == F.col(names["block"])))
    times = F.col(names["whole"]) + F.col(names["part"]).cast("int")
    number = F.explode(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>")))
    again = picked.withColumn(names["copy"], number)
    # each pass has a permutation of its own; the partial one is the plan's
    turn = F.when(F.col(names["copy"]) > F.col(names["whole"]), F.col(names["place"])).otherwise(
        F.pmod(F.xxhash64(F.lit(seed + 2), names["copy"], names["source"], names["block"]), F.lit(1 << 31)).cast("int"))
    more = [F.col(names["copy"]).alias(copy)] if copy else []
    more += [turn.alias(place)] if place else []
    return again.select(*[docs[c] for c in docs.columns], *more)

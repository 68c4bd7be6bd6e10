"""Interval joins through levels of bins: an equi-join on (chromosome, level, bin) plus the exact range test.

An interval stands in the bins of its own level only, the first whose bins are at least as long as it is, so it has at
most two rows however long it is. What is to meet it asks at every level that occurs (bins grow eightfold, so there are
few). Bins that hold far more rows than the others are split into cells by their counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.session import checkpointed

#: Bins double so often from one level to the next; levels that positions of 64 bits can need.
DOUBLINGS, LEVELS = 3, 22
#: Bins are split that hold more than this share of what a shuffle partition gets on average, and more rows than this.
HOT_SHARE, HOT_ROWS = 0.25, 1 << 20
#: One in so many rows is counted to find such bins.
ONE_IN = 64


def _size(bin_size: int, level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(bin_size).cast("bigint"), (level * DOUBLINGS).cast("int"))


def _level(length: Column, bin_size: int) -> Column:
    """The first level whose bins are as long as ``length`` at least; the bit length says which."""
    units = F.greatest(F.ceil(length / bin_size).cast("bigint"), F.lit(1).cast("bigint"))
    highest = (62 - bin_size.bit_length()) // DOUBLINGS
    return F.when(units == 1, 0).otherwise(F.least(F.ceil(F.length(F.bin(units - 1)) / DOUBLINGS), F.lit(highest))).cast("int")


def _first_bins(sides: list[tuple[DataFrame, str, str]], bin_size: int) -> list[DataFrame]:
    """For each (rows, chrom, first) a table (_chrom, _level, _bin, _n): about how many rows begin in a bin at their level.

    One in ``ONE_IN`` rows is counted. The numbers only decide which bins are split into cells, never what is joined.
    """
    every = None
    for i, (df, chrom, first) in enumerate(sides):
        some = df.sample(1.0 / ONE_IN, seed=7) if ONE_IN > 1 else df
        own = some.groupBy(F.col(chrom).alias("_chrom"), "_level", F.floor(F.col(first) / _size(bin_size, F.col("_level"))).alias("_bin")).agg(
            (F.count("*") * ONE_IN).alias("_n")).withColumn("_side", F.lit(i))
        every = own if every is None else every.unionByName(own)
    counted = checkpointed(every)
    return [counted.filter(F.col("_side") == i).drop("_side") for i in range(len(sides))]


def _levels_of(*sides: DataFrame) -> tuple[list[list[int]], int]:
    """(the levels that occur in each side, rows of the larger side): two numbers a side, from one job without a shuffle."""
    every = None
    for i, df in enumerate(sides):
        own = df.agg(F.lit(i).alias("side"), F.bit_or(F.expr("shiftleft(1L, _level)")).alias("bits"), F.count("*").alias("n"))
        every = own if every is None else every.unionByName(own)
    found = every.collect()
    bits = {r["side"]: r["bits"] or 0 for r in found}
    return [[k for k in range(LEVELS) if bits[i] >> k & 1] for i in range(len(sides))], max(r["n"] for r in found)


def _rolled_up(bins: DataFrame, levels: list[int], strictly: bool) -> DataFrame:
    """Counts of the bins that rows ask at the given levels, from their own level (or the next) on."""
    at = F.filter(F.array(*[F.lit(x) for x in levels]).cast("array<int>"), lambda x: x > F.col("_level") if strictly else x >= F.col("_level"))
    asked = bins.withColumn("_at", F.explode(at))
    wider = F.call_function("shiftright", F.col("_bin"), (F.col("_at") - F.col("_level")) * DOUBLINGS)
    return asked.groupBy("_chrom", F.col("_at").alias("_level"), wider.alias("_bin")).agg(F.sum("_n").alias("_n"))


def _in_bins(df: DataFrame, first: Column, last: Column, bin_size: int) -> DataFrame:
    size = _size(bin_size, F.col("_level"))
    return df.withColumn("_bin", F.explode(F.sequence(F.floor(first / size), F.floor(last / size))))


def _cells(left: DataFrame, right: DataFrame, keys: list[str], counts: Callable[[], dict[str, DataFrame]] | None,
           least: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_i`` and ``_j``: rows of a crowded bin are dealt to parts, the other side's rows repeated for each.

    ``counts`` gives the rows of each bin of the left (a) and right (b) side; None says that no bin can be crowded. A bin is crowded if it holds more than a share of
    a shuffle partition's rows, so there are at most a few times as many crowded bins as partitions, whatever the rows.
    ``least`` parts are made of every bin of the left side.
    """
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts, most = counts() if counts else {}, None
    for n, df in counts.items():
        one = df.agg(F.lit(n).alias("side"), F.max("_n").alias("most"), F.sum("_n").alias("total"))
        most = one if most is None else most.unionByName(one)
    limits, hot = {}, {}
    for side, greatest, total in most.collect() if counts else ():  # one row a side
        limits[side] = max((total or 0) * HOT_SHARE / partitions, float(HOT_ROWS))
        hot[side] = (greatest or 0) > limits[side]
    if not any(hot.values()) and least == 1:
        return tuple(df.withColumns({"_i": F.lit(0), "_j": F.lit(0)}) for df in (left, right))

    def crowded(df: DataFrame, name: str) -> DataFrame:
        limit = limits[name]
        return df.filter(F.col("_n") > limit).select(
            *[F.col(k).alias(f"_{name}{k}") for k in keys], F.ceil(F.col("_n") / limit).cast("int").alias(f"_parts_{name}"))

    hot = {n: crowded(counts[n], n) for n, is_hot in hot.items() if is_hot}

    def placed(df: DataFrame, own: str, own_index: str, other: str, other_index: str) -> DataFrame:
        columns = df.columns
        for n in hot:
            same = [F.col(k).eqNullSafe(F.col(f"_{n}{k}")) for k in keys]
            joined = same[0]
            for s in same[1:]:
                joined = joined & s
            df = df.join(hot[n], joined, "left").drop(*[f"_{n}{k}" for k in keys])
        floor = {"a": F.lit(least), "b": F.lit(1)}
        parts = {n: F.greatest(F.coalesce(f"_parts_{n}", F.lit(1)), floor[n]) if n in hot else floor[n] for n in (own, other)}
        part = F.when(parts[own] > 1, F.pmod(F.xxhash64(*columns), parts[own])).otherwise(0).cast("int")
        return df.withColumn(own_index, part).withColumn(other_index, F.explode(F.sequence(F.lit(0), parts[other] - 1))).drop(
            "_parts_a", "_parts_b")

    return placed(left, "a", "_i", "b", "_j"), placed(right, "b", "_j", "a", "_i")


def _prefixed(df: DataFrame, prefix: str, names: list[str]) -> DataFrame:
    return df.withColumnsRenamed({n: f"{prefix}{n}" for n in names})


def annotate_points(points: DataFrame, intervals: DataFrame, bin_size: int, how: str = "inner",
                    chrom: str = "chrom", pos: str = "pos", start: str = "start", end: str = "end",
                    salts: int = 1) -> DataFrame:
    """JOIN-10: ``start <= pos <= end`` with both ends included.

    A point asks once per level of the intervals, an interval has at most two rows, and they meet in exactly one bin, so
    nothing is found twice. Crowded bins, such as one hot position, are split by their counts; ``salts`` is the least
    number of parts. With ``left``, points that no level answers stay with NULLs.
    """
    right = intervals.filter(F.col(start) <= F.col(end)).withColumn("_level", _level(F.col(end) - F.col(start) + 1, bin_size))
    begun = points.withColumn("_level", F.lit(0))
    (_, levels), rows = _levels_of(begun, right)
    levels, begins = levels or [0], [(begun, chrom, pos), (right, chrom, start)]
    right = _in_bins(right, F.col(start), F.col(end), bin_size).withColumnsRenamed(
        {chrom: "_chrom", start: "_start", end: "_end"})
    extra = [c for c in intervals.columns if c not in (chrom, start, end)]
    covers = F.col(pos).between(F.col("_start"), F.col("_end"))
    out = [*points.columns, *extra, F.col("_start").alias(start), F.col("_end").alias(end)]

    def asked(df: DataFrame, at: list[int]) -> DataFrame:
        probes = df.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in at])) if len(at) > 1 else F.lit(at[0]))
        return probes.withColumn("_bin", F.floor(F.col(pos) / _size(bin_size, F.col("_level")))).withColumn("_chrom", F.col(chrom))

    keys = ["_chrom", "_level", "_bin"]

    same = [*keys, "_i", "_j"]
    def counts() -> dict[str, DataFrame]:
        of_left, of_right = _first_bins(begins, bin_size)
        return {"a": _rolled_up(of_left, levels, False), "b": of_right}

    a, b = _cells(asked(points, levels), right, keys, counts if rows > HOT_ROWS else None, salts)
    hit = covers
    for k in same:
        hit = hit & (F.col(f"_a{k}") == F.col(f"_b{k}"))
    found = _prefixed(a, "_a", same).join(_prefixed(b, "_b", same), hit).select(*out)
    if how == "inner":
        return found
    if how != "left":
        raise ValueError(f"how must be inner or left, not {how}")
    return _left_of(points, found, right, levels, asked, keys, covers, out)


def _left_of(points, found, right, levels, asked, keys, covers, out) -> DataFrame:
    """``found`` and the points that no interval of any level covers."""
    rest = points
    for level in levels:
        probes = asked(rest, [level])
        side = _prefixed(right.filter(F.col("_level") == level), "_b", keys)
        hit = covers
        for k in keys:
            hit = hit & (F.col(k) == F.col(f"_b{k}"))
        rest = probes.join(side, hit, "left_anti").select(*points.columns)
    types = {f.name: f.dataType for f in found.schema}
    missing = [F.lit(None).cast(types[n]).alias(n) for n in found.columns if n not in points.columns]
    return found.unionByName(rest.select(*points.columns, *missing))


def overlaps(a: DataFrame, b: DataFrame, bin_size: int, chrom: str = "chrom", start: str = "start",
             end: str = "end") -> DataFrame:
    """JOIN-18: overlap of two half-open interval sets, clipped; columns of ``b`` get ``_b``.

    A pair meets at the higher of its two levels, in the bin of its overlap's start. There the longer interval has its own
    rows and the shorter one asks; intervals of one level meet with ``a`` asking.
    """
    def levelled(df: DataFrame, suffix: str) -> DataFrame:
        named = df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns}) if suffix else df
        lo, hi = F.col(start + suffix), F.col(end + suffix)
        return named.filter(lo < hi).withColumn("_level", _level(hi - lo, bin_size))

    left, right = levelled(a, ""), levelled(b, "_b")
    (of_left, of_right), most = _levels_of(left, right)
    begins = [(left, chrom, start), (right, chrom + "_b", start + "_b")]

    def rows(df: DataFrame, suffix: str, asks: bool, levels: list[int], strictly: bool) -> DataFrame:
        """The asking rows of a side, at the given levels from its own (or the next) on, or its own rows."""
        if asks:
            at = F.filter(F.array(*[F.lit(x) for x in levels]), lambda x: x > F.col("_level") if strictly else x >= F.col("_level"))
            df = df.withColumn("_at", at if levels else F.array().cast("array<int>")).withColumn("_level", F.explode("_at")).drop("_at")
        return _in_bins(df, F.col(start + suffix), F.col(end + suffix) - 1, bin_size).withColumn("_asks", F.lit(asks == (suffix == "")))

    sides = [(rows(left, "", True, of_right, False), rows(right, "_b", False, [], False))]
    if of_left and of_right and max(of_left) > min(of_right):  # only then may one of ``b`` ask
        sides.append((rows(left.filter(F.col("_level") > min(of_right)), "", False, [], False), rows(right, "_b", True, of_left, True)))
    x, y = sides[0] if len(sides) == 1 else (sides[0][0].unionByName(sides[1][0]), sides[0][1].unionByName(sides[1][1]))
    keys = ["_chrom", "_asks", "_level", "_bin"]

    def counts() -> dict[str, DataFrame]:
        bins_left, bins_right = _first_bins(begins, bin_size)
        both = {True: {"a": _rolled_up(bins_left, of_right, False), "b": bins_right},
                False: {"a": bins_left, "b": _rolled_up(bins_right, of_left, True)}}
        found = {n: both[True][n].withColumn("_asks", F.lit(True)) for n in "ab"}
        if len(sides) > 1:
            found = {n: df.unionByName(both[False][n].withColumn("_asks", F.lit(False))) for n, df in found.items()}
        return found

    x, y = _cells(x.withColumn("_chrom", F.col(chrom)), y.withColumn("_chrom", F.col(chrom + "_b")), keys,
                  counts if most > HOT_ROWS else None, 1)
    same = [*keys, "_i", "_j"]
    x, y = _prefixed(x, "_a", same), _prefixed(y, "_z", same)
    low, high = F.greatest(F.col(start), F.col(start + "_b")), F.least(F.col(end), F.col(end + "_b"))
    hit = (low < high) & (F.col("_a_bin") == F.floor(low / _size(bin_size, F.col("_a_level"))))
    for k in same:
        hit = hit & (F.col(f"_a{k}") == F.col(f"_z{k}"))
    return x.join(y, hit).withColumns({"overlap_start": low, "overlap_end": high}).drop(
        *[f"{p}{k}" for k in same for p in ("_a", "_z")])


#: Starts and ends that one task of ``covered_depth`` gets.
STEP_ROWS = 500_000


def covered_depth(alignments: DataFrame, block: int, chrom: str = "chrom", start: str = "start",
                  end: str = "end") -> DataFrame:
    """Depth steps of half-open alignments: (chrom, pos, depth) where the depth changes.

    Starts add one and ends subtract one; the running sum is made per block of positions. Rows are dealt once, by block, to
    tasks of about ``STEP_ROWS`` rows, so a task's memory does not follow the number of alignments.
    """
    from strandlake.operators.windows import running_in_blocks
    spark = alignments.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-2 * alignments.count() // STEP_ROWS))
    deltas = alignments.select(chrom, F.inline(F.array(
        F.struct(F.col(start).alias("pos"), F.lit(1).alias("delta")),
        F.struct(F.col(end).alias("pos"), F.lit(-1).alias("delta")))))
    key = F.struct(chrom, F.floor(F.col("pos") / block).alias("_block"))
    steps = (deltas.select(key.alias("_key"), "pos", "delta").repartition(tasks, "_key")
             .groupBy("_key", "pos").agg(F.sum("delta").alias("delta")))
    out = running_in_blocks(steps, [chrom], ["pos"], {"depth": F.col("delta")})
    return out.select(F.col(f"_key.{chrom}").alias(chrom), "pos", "depth")

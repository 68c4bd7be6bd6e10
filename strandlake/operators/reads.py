"""Read quality jobs over ``(read_id, seq, qual, ...)`` rows; the same code runs on batches and streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions import sequence as sq
from strandlake.functions.numeric import percent, ratio
from strandlake.operators.joins import paired_reads
from strandlake.operators.quantiles import counted_quantiles
from strandlake.session import checkpointed, computed_once

# Limits of the trimming job, in its order of steps.
MIN_LENGTH, MIN_QUALITY, TAIL_QUALITY = 50, 20, 20


def with_measures(reads: DataFrame) -> DataFrame:
    """Length, mean quality, GC and N share of every read."""
    return reads.withColumns({"length": F.length(F.col("seq")), "mean_quality": sq.phred_mean(F.col("qual")),
                              "gc": sq.gc_fraction(F.col("seq")), "n_share": F.coalesce(sq.n_fraction(F.col("seq")), F.lit(0.0))})


def group_read_qc(reads: DataFrame, keys: list[str], adapter: str, min_quality: float = MIN_QUALITY) -> DataFrame:
    """QC-01: reads, bases, mean length and quality, N bases, low-quality and adapter reads per group."""
    measured = reads.withColumns({"_q": sq.phred_mean(F.col("qual")), "_len": F.length(F.col("seq")).cast("bigint")})
    n = F.count("*")
    low, dirty = F.count_if(F.col("_q") < min_quality), F.count_if(F.contains(F.col("seq"), F.lit(adapter)))
    return measured.groupBy(*keys).agg(
        n.alias("total_reads"), F.sum("_len").alias("total_bases"), ratio(F.sum("_len"), n).alias("avg_length"),
        ratio(F.sum(F.coalesce("_q", F.lit(0.0))), n).alias("avg_quality"),
        F.sum(sq.n_count(F.col("seq")).cast("bigint")).alias("n_bases"), low.alias("low_quality_reads"),
        dirty.alias("adapter_reads"), percent(low, n).alias("low_quality_pct"), percent(dirty, n).alias("adapter_pct"))


def trimmed_reads(reads: DataFrame, adapter: str, min_length: int = MIN_LENGTH, min_quality: float = MIN_QUALITY,
                  tail_quality: int = TAIL_QUALITY) -> DataFrame:
    """QC-02: every read with its cleaned sequence and the reason it was refused (``passed`` if none).

    Order: cut at the adapter, refuse N, refuse short, refuse low mean quality, cut the tail, refuse short.
    """
    cut = reads.withColumn("_s", sq.before_adapter(F.col("seq"), adapter)).withColumn(
        "_q", sq.cut_to(F.col("qual"), F.length("_s")))
    tail = cut.withColumn("_t", sq.trimmed_quality(F.col("_q"), tail_quality))
    reason = (F.when(F.contains(F.col("_s"), F.lit("N")), "n_filtered")
              .when(F.length("_s") < min_length, "length_filtered")
              .when(sq.phred_mean(F.col("_q")) < min_quality, "quality_filtered")
              .when(F.length("_t") < min_length, "length_filtered").otherwise("passed"))
    return tail.select(
        *[c for c in reads.columns if c not in ("seq", "qual")], reason.alias("reason"),
        (F.length("_s") < F.length(F.col("seq"))).alias("adapter_trimmed"),
        sq.cut_to(F.col("_s"), F.length("_t")).alias("seq"), F.col("_t").alias("qual"))


def trim_counters(trimmed: DataFrame, keys: list[str]) -> DataFrame:
    """QC-02: counters per reason."""
    def n(reason):
        return F.count_if(F.col("reason") == reason).alias(reason)

    return trimmed.groupBy(*keys).agg(F.count("*").alias("total_input"),
                                      F.count_if("adapter_trimmed").alias("adapter_trimmed"), n("n_filtered"),
                                      n("length_filtered"), n("quality_filtered"), n("passed"))


def position_quality(reads: DataFrame) -> DataFrame:
    """QC-03: per position mean and quartiles of quality, from counts per (position, score)."""
    cells = reads.select(F.posexplode(sq.phred_scores(F.col("qual"))).alias("position", "score"))
    counts = cells.groupBy("position", "score").agg(F.count("*").alias("_n"))
    stats = counts.groupBy("position").agg(
        F.sum("_n").alias("n"), ratio(F.sum(F.col("score") * F.col("_n")), F.sum("_n")).alias("mean_quality"),
        F.percentile("score", [0.25, 0.75], F.col("_n")).alias("_p"))
    return stats.select("position", "n", "mean_quality", F.col("_p")[0].alias("q25"), F.col("_p")[1].alias("q75"))


def histogram(df: DataFrame, value: Column, width: float) -> DataFrame:
    """QC-04: counts per bin of a fixed width."""
    bins = df.select((F.floor(value / F.lit(float(width))) * F.lit(float(width))).alias("bin"))
    # Rows without a value are left out by their count, so the value is computed once per row.
    return bins.groupBy("bin").agg(F.count("bin").alias("n")).filter(F.col("n") > 0)


def q30_rate(reads: DataFrame) -> DataFrame:
    """QC-04: percent of reads with mean quality of 30 or more."""
    return reads.agg(percent(F.count_if(sq.phred_mean(F.col("qual")) >= 30), F.count("*")).alias("q30_rate"))


def before_after(initial: DataFrame, counters: DataFrame, key: str, order: Column) -> DataFrame:
    """QC-05: reads before and after trimming per group, in natural order."""
    return (initial.select(key, F.col("total_reads").alias("before"))
            .join(counters.select(key, F.col("passed").alias("after")), key)
            .withColumn("kept_pct", percent(F.col("after"), F.col("before"))).orderBy(order, key))


def filtered(reads: DataFrame, min_length: int = 50, min_quality: float = 20.0, max_n: float = 0.05) -> DataFrame:
    """FLT-12: reads long enough, good enough and with few N."""
    return reads.filter((F.length(F.col("seq")) >= min_length) & (sq.phred_mean(F.col("qual")) >= min_quality)
                        & (F.coalesce(sq.n_fraction(F.col("seq")), F.lit(0.0)) <= max_n))


def tail_trimmed(reads: DataFrame, threshold: int = 15) -> DataFrame:
    """SEQ-04: 3' trim; reads left empty are dropped."""
    kept = reads.withColumn("qual", sq.trimmed_quality(F.col("qual"), threshold))
    return kept.withColumn("seq", sq.cut_to(F.col("seq"), F.length("qual"))).filter(F.length("qual") > 0)


def _measures(reads: DataFrame) -> DataFrame:
    """Sums every statistic is made of, computed once per read."""
    return computed_once(reads, ["read_id"], {
        "bases": F.length("seq").cast("bigint"), "scores": F.length("qual").cast("bigint"),
        "gc": sq.count_of(F.col("seq"), "GCgc").cast("bigint"), "n": sq.count_of(F.col("seq"), "Nn").cast("bigint"),
        "quality": sq.phred_sum(F.col("qual"))})


def _rule(bases: str, scores: str, n: str, quality: str, min_length: int, min_quality: float, max_n: float) -> Column:
    """FLT-12 as a condition on measures; false where one is missing."""
    share = F.coalesce(ratio(F.col(n), F.col(bases)), F.lit(0.0))
    return F.coalesce((F.col(bases) >= min_length) & (ratio(F.col(quality), F.col(scores)) >= min_quality) & (share <= max_n), F.lit(False))


def _summary(where: Column | None = None) -> list[Column]:
    def total(c):
        return F.sum(c if where is None else F.when(where, F.col(c)))

    count = F.count("*") if where is None else F.count_if(where)
    return [count.alias("total_reads"), ratio(total("bases"), count).alias("avg_length"),
            ratio(total("gc"), total("bases")).alias("avg_gc"), ratio(total("quality"), total("scores")).alias("avg_quality")]


def read_statistics(reads: DataFrame) -> DataFrame:
    """QC-06: reads, mean length, GC share and mean base quality."""
    return _measures(reads).agg(*_summary())


def compare_rules(reads: DataFrame, rules: dict[str, dict], trim_at: int = 15) -> DataFrame:
    """QC-06, STM-10: pipeline statistics per named rule set (strict, lenient): filtered, tail trimmed, left empty dropped.

    All rule sets come from one pass: a read is measured and trimmed once, each set is a condition on its measures.
    """
    kept = sq.trimmed_quality(F.col("qual"), trim_at)
    cut = computed_once(reads, ["seq", "qual"], {"_kept": F.length(kept)})
    tail = F.expr("substring(qual, _kept + 1)")
    whole = sq.phred_sum(F.col("qual"))
    # The quality of what is kept is that of the read without its tail, which is short.
    measured = computed_once(cut, ["_kept"], {
        "_bases": F.length("seq").cast("bigint"), "_scores": F.length("qual").cast("bigint"),
        "_n": sq.count_of(F.col("seq"), "Nn").cast("bigint"), "_quality": whole,
        "bases": F.length(sq.cut_to(F.col("seq"), F.col("_kept"))).cast("bigint"), "scores": F.col("_kept").cast("bigint"),
        "gc": sq.count_of(sq.cut_to(F.col("seq"), F.col("_kept")), "GCgc").cast("bigint"),
        "_tail": F.when(F.length(tail) > 0, sq.phred_sum(tail)).otherwise(F.lit(0).cast("bigint"))}).withColumn(
        "quality", F.col("_quality") - F.col("_tail"))
    limits = {name: {"min_length": 50, "min_quality": 20.0, "max_n": 0.05, **given} for name, given in rules.items()}
    passed = {name: _rule("_bases", "_scores", "_n", "_quality", **given) & (F.col("_kept") > 0) for name, given in limits.items()}
    sums = measured.agg(*[F.struct(*_summary(where)).alias(f"_r{i}") for i, where in enumerate(passed.values())])
    return sums.select(F.inline(F.array(*[F.struct(F.col(f"_r{i}.*"), F.lit(name).alias("rules")) for i, name in enumerate(passed)])))


def paired_filter(first: DataFrame, second: DataFrame, keep: Column) -> DataFrame:
    """QC-08: pairs of which both mates pass ``keep`` (a condition on seq and qual)."""
    return paired_reads(first.filter(keep), second.filter(keep), ["seq", "qual"])


def read_report(first: DataFrame, second: DataFrame, min_length: int = 50, min_quality: float = 20.0,
                max_n: float = 0.05) -> DataFrame:
    """QC-07: statistics of both files before and after filtering, and pairs kept."""
    ok = _rule("bases", "scores", "n", "quality", min_length, min_quality, max_n)
    rows, passed = [], []
    for number, df in ((1, first), (2, second)):
        # Texts are read once: both stages and the pairs, which are joined on ids alone, use the checkpointed measures.
        marked = checkpointed(_measures(df).withColumn("_ok", ok))
        stages = marked.agg(F.struct(*_summary()).alias("raw"), F.struct(*_summary(F.col("_ok"))).alias("filtered"))
        rows += [stages.select(f"{s}.*").withColumn("stage", F.lit(f"{s}_{number}")) for s in ("raw", "filtered")]
        passed.append(marked.filter("_ok"))
    pairs = paired_reads(passed[0], passed[1], []).agg(F.count("*").alias("total_reads"))
    rows.append(pairs.withColumn("stage", F.lit("pairs_kept")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def insert_sizes(first: DataFrame, second: DataFrame) -> DataFrame:
    """SEQ-15: insert size per read pair."""
    return paired_reads(first, second, ["seq"]).select(
        "pair_id", sq.insert_size(F.col("seq1"), F.col("seq2")).alias("insert_size"))


def adapter_rate(reads: DataFrame, adapter: str, first_bases: int = 10, sample: int | None = None) -> DataFrame:
    """QC-09: percent of reads holding the start of the adapter; optionally of the first reads only."""
    looked = reads.limit(sample) if sample else reads
    return looked.agg(percent(F.count_if(F.contains(F.col("seq"), F.lit(adapter[:first_bases]))), F.count("*"))
                      .alias("adapter_pct"))


def batch_quality(reads: DataFrame, pattern: str = r"batch(\d+)") -> DataFrame:
    """QC-10: reads, mean and population std of read quality per batch named in the header."""
    batch = F.regexp_extract("read_id", pattern, 1)
    return (reads.select(batch.alias("batch"), sq.phred_mean(F.col("qual")).alias("_q")).filter(F.col("batch") != "")
            .groupBy("batch").agg(F.count("*").alias("num_reads"), F.avg("_q").alias("mean_quality"),
                                  F.stddev_pop("_q").alias("std_quality")))


def lookup(sequences: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """QC-16: batch lookup of ids."""
    return sequences.join(ids.select(key), key, "left_semi")


def find(sequences: DataFrame, text: str, key: str = "id") -> DataFrame:
    """QC-16: sequences whose id holds a text."""
    return sequences.filter(F.contains(F.col(key), F.lit(text)))


def score_quantiles(reads: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Quantiles of base quality per group, from score counts."""
    cells = reads.select(*keys, F.explode(sq.phred_scores(F.col("qual"))).alias("score"))
    return counted_quantiles(cells, keys, "score", probs)

"""Coverage, duplicates, contamination, alignment and assembly statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.functions.numeric import percent, ratio
from strandlake.operators.intervals import overlaps
from strandlake.operators.quantiles import exact_medians, quantile_columns
from strandlake.operators.windows import running

# Depth limits reported, minor-allele window and least depth, contig limits.
DEPTH_LIMITS = (20, 100, 500)
MINOR_LOW, MINOR_HIGH, MINOR_DEPTH = 0.02, 0.40, 100
SHORT_CONTIG, GC_LOW, GC_HIGH = 500, 20, 80
#: Positions of one block of a target.
DEPTH_BLOCK = 1 << 20
SIZE_CLASSES = ((500, "very_short"), (2000, "short"), (5000, "medium"))


def depth_runs(targets: DataFrame, alignments: DataFrame, bin_size: int = 1024) -> DataFrame:
    """(target, pos, length, depth): runs of positions of half-open targets with one depth, 0 where nothing aligns.

    Alignments are clipped to the target they overlap; starts add one and ends take one away, and a running sum over the
    places where something changes gives the depth. Rows made are changes of depth, not bases. The sum is carried over
    blocks of positions, so a long target is not ordered in one task.
    """
    clipped = overlaps(targets.select("target", "chrom", "start", "end"), alignments.select("chrom", "start", "end"), bin_size)
    steps = clipped.select("target", F.inline(F.array(
        F.struct(F.col("overlap_start").cast("bigint").alias("pos"), F.lit(1).alias("step")),
        F.struct(F.col("overlap_end").cast("bigint").alias("pos"), F.lit(-1).alias("step")))))
    bounds = targets.filter(F.col("start") < F.col("end")).select("target", F.inline(F.array(
        F.struct(F.col("start").cast("bigint").alias("pos"), F.lit(0).alias("step")),
        F.struct(F.col("end").cast("bigint").alias("pos"), F.lit(0).alias("step")))))
    changes = steps.unionByName(bounds).groupBy("target", "pos").agg(F.sum("step").alias("step")).withColumn(
        "_block", F.floor(F.col("pos") / DEPTH_BLOCK))
    own = Window.partitionBy("target", "_block").orderBy("pos")
    local = changes.withColumns({"_sum": F.sum("step").over(own.rowsBetween(Window.unboundedPreceding, 0)), "_next": F.lead("pos").over(own)})
    blocks = changes.groupBy("target", "_block").agg(F.sum("step").alias("_total"), F.min("pos").alias("_first"))
    along = Window.partitionBy("target").orderBy("_block")
    edges = blocks.select("target", "_block", (F.sum("_total").over(along) - F.col("_total")).alias("_before"),
                          F.lead("_first").over(along).alias("_behind"))
    upto = F.coalesce("_next", "_behind")
    return local.join(edges, ["target", "_block"]).filter(upto.isNotNull()).select(
        "target", "pos", (upto - F.col("pos")).alias("length"), (F.col("_sum") + F.col("_before")).alias("depth"))


def target_depth(targets: DataFrame, alignments: DataFrame, bin_size: int = 1024) -> DataFrame:
    """Depth of every position of half-open targets, 0 where nothing aligns: ``depth_runs`` spelled out."""
    runs = depth_runs(targets, alignments, bin_size)
    return runs.select("target", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("length") - 1)).alias("pos"), "depth")


def coverage_statistics(runs: DataFrame, key: str = "target") -> DataFrame:
    """QC-11: mean, median, least, greatest, CV percent (population) and share of positions at 20, 100, 500x.

    Runs are first reduced to positions per depth. Sums of depths and of their squares are exact, so the deviation does not
    depend on the order of rows; the median is taken from the counts.
    """
    counts = runs.groupBy(key, "depth").agg(F.sum("length").alias("_c"))
    n = F.sum("_c")
    depths, squares = F.sum(F.col("depth") * F.col("_c")), F.sum(F.col("depth").cast("decimal(19,0)") * F.col("depth") * F.col("_c"))
    out = counts.groupBy(key).agg(
        n.alias("positions"), depths.alias("_s"), squares.cast("decimal(25,0)").alias("_q"), F.min("depth").alias("min_coverage"),
        F.max("depth").alias("max_coverage"),
        *[percent(F.sum(F.when(F.col("depth") >= d, F.col("_c")).otherwise(0)), n).alias(f"pct_{d}x") for d in DEPTH_LIMITS],
        F.percentile("depth", 0.5, F.col("_c")).alias("median_coverage"))
    mean = ratio(F.col("_s"), F.col("positions"))
    whole = F.col("_s").cast("decimal(18,0)")
    spread = F.sqrt((F.col("positions").cast("decimal(12,0)") * F.col("_q") - whole * whole).cast("double")) / F.col("positions")
    return out.withColumns({"mean_coverage": mean, "cv_pct": F.coalesce(ratio(spread * 100.0, mean), F.lit(0.0))}).drop("_s", "_q")


def duplicate_rate(alignments: DataFrame, keys: list[str]) -> DataFrame:
    """QC-12, WIN-15: share of alignments beyond the first at the same (chromosome, start, strand)."""
    places = alignments.groupBy(*keys).agg(F.count("*").alias("_n"))
    return places.agg(F.sum("_n").alias("total"), F.sum(F.col("_n") - 1).alias("duplicates"),
                      percent(F.sum(F.col("_n") - 1), F.sum("_n")).alias("duplicate_rate"))


def contamination(bases: DataFrame, keys: list[str], base: str, min_depth: int = MINOR_DEPTH) -> DataFrame:
    """QC-13: median minor-allele percent over all sites deep enough, 0 when no site qualifies.

    The second most frequent base of a site is its minor allele; sites with a share in (0.02, 0.40) count.
    """
    counts = bases.groupBy(*keys, base).agg(F.count("*").alias("_n"))
    sites = counts.groupBy(*keys).agg(F.sum("_n").alias("_depth"), F.sort_array(F.collect_list("_n"), False).alias("_by"))
    share = ratio(F.try_element_at("_by", F.lit(2)), F.col("_depth"))
    minor = (sites.filter(F.col("_depth") >= min_depth).select(share.alias("share"))
             .filter((F.col("share") > MINOR_LOW) & (F.col("share") < MINOR_HIGH)))
    median = exact_medians(minor, [], "share")
    count = minor.agg(F.count("*").alias("sites"))
    return count.join(F.broadcast(median), F.lit(True), "left").select(
        "sites", (F.coalesce("median", F.lit(0.0)) * 100).alias("contamination_pct"))


def alignment_statistics(alignments: DataFrame) -> DataFrame:
    """QC-14: mapped share, MAPQ, length, strand, edit distance, score and GC of alignments."""
    from strandlake.functions.sequence import count_of
    n = F.count("*")
    mapped = F.col("flag").bitwiseAND(4) == 0
    bases = F.sum(F.length("seq").cast("bigint"))

    def tag(name):
        return F.avg(F.try_element_at("tags", F.lit(name)).try_cast("double"))

    return alignments.agg(
        n.alias("alignments"), percent(F.count_if(mapped), n).alias("mapped_pct"), F.avg("mapq").alias("mean_mapq"),
        ratio(bases, n).alias("mean_length"), percent(F.count_if(F.col("strand") == "-"), n).alias("reverse_pct"),
        tag("NM").alias("mean_edit_distance"), tag("AS").alias("mean_score"),
        percent(F.sum(count_of(F.col("seq"), "GCgc").cast("bigint")), bases).alias("gc_pct"))


def nx(lengths: DataFrame, keys: list[str], length: str = "length", share: float = 0.5, block: int = 1000) -> DataFrame:
    """QC-15: N50 (or another Nx): greatest length such that contigs at least as long hold the share of bases.

    Contigs become counts per length, summed from the longest down in blocks of lengths.
    """
    counts = (lengths.groupBy(*keys, length).agg(F.count("*").alias("_c"))
              .withColumns({"_neg": -F.col(length), "_bases": F.col(length).cast("bigint") * F.col("_c")}))
    upto = running(counts, keys, ["_neg"], F.floor(F.col("_neg") / block), {"_sum": F.col("_bases")})
    totals = counts.groupBy(*keys).agg(F.sum("_bases").alias("_total"))
    joined = upto.join(totals, keys) if keys else upto.join(F.broadcast(totals))
    return (joined.filter(F.col("_sum") >= F.col("_total") * F.lit(share)).groupBy(*keys)
            .agg(F.max(length).alias(f"n{int(share * 100)}")))


def assembly_qc(contigs: DataFrame, keys: list[str]) -> DataFrame:
    """QC-15: counts, bases, N50, short contigs, extreme GC, length-GC correlation, per assembly.

    ``contigs`` holds length and gc_content in percent; ``keys`` names the assembly column(s).
    """
    n = F.count("*")
    stats = contigs.groupBy(*keys).agg(
        n.alias("sequences"), F.sum(F.col("length").cast("bigint")).alias("total_bases"),
        F.max("length").alias("longest"), F.min("length").alias("shortest"), ratio(F.sum(F.col("length").cast("bigint")), n).alias("mean_length"),
        F.count_if(F.col("length") < SHORT_CONTIG).alias("short"),
        F.count_if((F.col("gc_content") < GC_LOW) | (F.col("gc_content") > GC_HIGH)).alias("extreme_gc"),
        F.corr(F.col("length").cast("double"), F.col("gc_content")).alias("length_gc_corr"))
    medians = quantile_columns(contigs, keys, "length", {"median_length": 0.5})
    return stats.join(nx(contigs, keys), keys).join(medians, keys)


def size_class(length):
    """QC-15: half-open size classes; 5000 and more is long."""
    out = F
    for limit, label in SIZE_CLASSES:
        out = out.when(length < limit, label)
    return out.otherwise("long")


def size_libraries(contigs: DataFrame, keys: list[str]) -> DataFrame:
    return contigs.groupBy(*keys, size_class(F.col("length")).alias("size_class")).agg(
        F.count("*").alias("sequences"), F.sum(F.col("length").cast("bigint")).alias("total_bases"))


def variant_summary(rows: DataFrame) -> DataFrame:
    """QC-17: total, chromosomes, and counts per variant type and filter in long form."""
    from strandlake.functions.variant import allele_types
    typed = rows.select("CHROM", "FILTER", allele_types(F.col("REF"), F.col("ALT")).alias("kind"))
    cells = F.array(F.struct(F.lit("total").alias("metric"), F.lit("").alias("value")),
                    F.struct(F.lit("chromosome").alias("metric"), F.col("CHROM").alias("value")),
                    F.struct(F.lit("type").alias("metric"), F.col("kind").alias("value")),
                    F.struct(F.lit("filter").alias("metric"), F.col("FILTER").alias("value")))
    return typed.select(F.inline(cells)).groupBy("metric", "value").agg(F.count("*").alias("n"))

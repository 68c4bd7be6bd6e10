"""Classes, rates and derived attributes as reusable column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandlake.functions.numeric import ratio

# Class limits and labels used by the reports.
QUALITY_CLASSES = ((50.0, "HIGH"), (30.0, "MEDIUM"))
FREQUENCY_CLASSES = ((0.001, "Singleton"), (0.01, "Rare"), (0.05, "Low frequency"))
COVERAGE_CLASSES = ((30.0, "Low"), (80.0, "Medium"), (120.0, "High"))
ORGANISM_GROUPS = {"Homo sapiens": "Human", "Mus musculus": "Mouse"}
CENTER_TYPES = {"Academic": ("Broad Institute", "Sanger", "NIH"), "Commercial": ("BGI", "Illumina")}
INSTRUMENT_TIERS = (("%NovaSeq X%", "Current generation"), ("%NovaSeq%", "Previous generation"),
                    ("%HiSeq%", "Legacy"), ("%PacBio%", "Long-read"), ("%Nanopore%", "Long-read"))
RECENT_YEAR = 2022
ASSAY_CATEGORIES = ("Single-cell RNA-seq", "Bulk RNA-seq", "DNA-seq", "Epigenomics")
DNA_STRATEGIES, EPIGENOMIC_STRATEGIES = ("WGS", "WES"), ("ChIP-Seq", "ATAC-seq", "CUT&RUN")


def first_match(arms, default) -> Column:
    """CASE WHEN over (condition, label) pairs; ``default`` also takes NULL conditions."""
    out = F
    for condition, label in arms:
        out = out.when(condition, label)
    return out.otherwise(default)


def at_least(col: Column, steps, default: str) -> Column:
    """First label whose lower limit is reached."""
    return first_match([(col >= limit, label) for limit, label in steps], default)


def below(col: Column, steps, default: str) -> Column:
    """First label whose upper limit is not reached."""
    return first_match([(col < limit, label) for limit, label in steps], default)


def first_like(col: Column, patterns, default: str) -> Column:
    """First label whose LIKE pattern fits (PRJ-09)."""
    return first_match([(col.like(pattern), label) for pattern, label in patterns], default)


def quality_class(col: Column) -> Column:
    """PRJ-04."""
    return at_least(col, QUALITY_CLASSES, "LOW")


def frequency_class(col: Column) -> Column:
    """PRJ-05; a missing frequency counts as Common."""
    return below(col, FREQUENCY_CLASSES, "Common")


def coverage_class(col: Column) -> Column:
    """UDF-04."""
    return below(col, COVERAGE_CLASSES, "Very High")


def organism_group(col: Column) -> Column:
    return first_match([(col == name, label) for name, label in ORGANISM_GROUPS.items()], "Other")


def center_type(col: Column) -> Column:
    return first_match([(col.isin(*names), label) for label, names in CENTER_TYPES.items()], "Other")


def assay_category(instrument: Column, strategy: Column, source: Column) -> Column:
    """PRJ-09: the first kind of assay whose condition holds."""
    conditions = (instrument.like("%10x Genomics%"), (strategy == "RNA-Seq") & source.like("%TRANSCRIPTOMIC%"),
                  strategy.isin(*DNA_STRATEGIES) & (source == "GENOMIC"), strategy.isin(*EPIGENOMIC_STRATEGIES))
    return first_match(zip(conditions, ASSAY_CATEGORIES), "Other")


def instrument_tier(col: Column) -> Column:
    return first_like(col, INSTRUMENT_TIERS, "Other")


def is_recent(year: Column) -> Column:
    return F.coalesce(year >= RECENT_YEAR, F.lit(False))


def mapping_rate(mapped: Column, total: Column) -> Column:
    """UDF-03/UDF-12: percent of reads mapped."""
    return ratio(mapped * 100.0, total)


def duplicate_rate_of_mapped(duplicates: Column, mapped: Column) -> Column:
    """UDF-12: duplicates over mapped reads, percent."""
    return ratio(duplicates * 100.0, mapped)


def duplicate_rate_of_total(duplicates: Column, total: Column) -> Column:
    """UDF-12: duplicates over all reads, percent."""
    return ratio(duplicates * 100.0, total)


def years_from_days(days: Column) -> Column:
    """PRJ-10."""
    return days / F.lit(365.25)

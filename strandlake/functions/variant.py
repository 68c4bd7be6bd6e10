"""Variant functions: INFO fields and variant types."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def info_map(info: Column) -> Column:
    """STR-08: ``k=v;flag`` text as a map; a flag has value ``true``; ``.`` gives an empty map."""
    kept = F.filter(F.split(info, ";"), lambda kv: (kv != "") & (kv != "."))
    pairs = F.transform(kept, lambda kv: F.struct(
        F.substring_index(kv, "=", 1).alias("k"),
        F.when(F.contains(kv, F.lit("=")), F.substring(kv, F.instr(kv, "=") + 1, F.length(kv)))
        .otherwise(F.lit("true")).alias("v")))
    # The last of repeated keys stands, as in a dictionary; only rows with repeats pay for finding it.
    names = F.transform(pairs, lambda p: p["k"])
    last = F.filter(pairs, lambda p, i: ~F.array_contains(
        F.slice(names, i + 2, F.greatest(F.size(names) - i - 1, F.lit(0))), p["k"]))
    return F.when(F.size(F.array_distinct(names)) == F.size(names), F.map_from_entries(pairs)).otherwise(
        F.map_from_entries(last))


def info_field(info: Column, key: str) -> Column:
    """STR-08: one field, straight from the text; a missing field or the value ``.`` gives NULL.

    The last of repeated keys stands. For one or two fields this is far cheaper than the whole map.
    """
    pattern = rf"^(?:.*;)?{re.escape(key)}=([^;]*)"
    return F.nullif(F.when(info.rlike(pattern), F.regexp_extract(info, pattern, 1)), F.lit("."))


def info_flag(info: Column, key: str) -> Column:
    """STR-08: whether the key is present, with or without a value."""
    return F.coalesce(info.rlike(rf"(^|;){re.escape(key)}(=|;|$)"), F.lit(False))


def allele_type(ref: Column, alt: Column) -> Column:
    """STR-09: type of one alternative allele."""
    return (F.when(alt == ".", "NO_VARIATION")
            .when((F.length(ref) == 1) & (F.length(alt) == 1), "SNP")
            .when(F.length(ref) > F.length(alt), "DELETION")
            .when(F.length(ref) < F.length(alt), "INSERTION")
            .otherwise("MNP"))


def allele_types(ref: Column, alts: Column) -> Column:
    """STR-09: comma-joined types of all alternative alleles."""
    return F.array_join(F.transform(F.split(alts, ","), lambda a: allele_type(ref, a)), ",")


def variant_type(ref: Column, alt: Column) -> Column:
    """STR-10: SNV, insertion, deletion, MNV; ``unknown`` when an allele is missing."""
    return (F.when(ref.isNull() | alt.isNull(), "unknown")
            .when((F.length(ref) == 1) & (F.length(alt) == 1), "SNV")
            .when(F.length(ref) < F.length(alt), "insertion")
            .when(F.length(ref) > F.length(alt), "deletion")
            .otherwise("MNV"))

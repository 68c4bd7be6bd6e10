"""Sequence and base-quality functions.

All work is a fixed number of linear passes over the text, so one very long
sequence costs time in proportion to its length.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard genetic code in TCAG order, the quality offset, the complement pairs.
CODON_BASES = "TCAG"
CODON_AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
STOP_CODONS = ("TAA", "TAG", "TGA")
START_CODON = "ATG"
PHRED_OFFSET = 33
COMPLEMENT_FROM, COMPLEMENT_TO = "ACGT", "TGCA"


def codon_table() -> dict[str, str]:
    codons = ("".join(c) for c in itertools.product(CODON_BASES, repeat=3))
    return dict(zip(codons, CODON_AMINO_ACIDS))


def count_of(seq: Column, letters: str) -> Column:
    """Occurrences of any of ``letters``."""
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def gc_fraction(seq: Column) -> Column:
    """SEQ-01: share of G and C in any case; 0 for an empty sequence."""
    return F.coalesce(F.try_divide(count_of(seq, "GCgc").cast("double"), F.length(seq).cast("double")), F.lit(0.0))


def n_count(seq: Column) -> Column:
    return count_of(seq, "N")


def n_fraction(seq: Column) -> Column:
    """SEQ-03: share of N in any case."""
    return F.try_divide(count_of(seq, "Nn").cast("double"), F.length(seq).cast("double"))


def phred_scores(qual: Column) -> Column:
    """SEQ-02: per-base scores."""
    return F.transform(letters(qual), lambda c: F.ascii(c) - F.lit(PHRED_OFFSET))


def phred_sum(qual: Column) -> Column:
    return F.aggregate(letters(qual), F.lit(0).cast("bigint"),
                       lambda acc, c: acc + F.ascii(c) - F.lit(PHRED_OFFSET))


def phred_mean(qual: Column) -> Column:
    """SEQ-02: mean score; NULL for an empty quality string."""
    return F.try_divide(phred_sum(qual).cast("double"), F.length(qual).cast("double"))


def phred_min(qual: Column) -> Column:
    return F.array_min(phred_scores(qual))


def phred_max(qual: Column) -> Column:
    return F.array_max(phred_scores(qual))


def letters(text: Column) -> Column:
    """Characters of a text as an array."""
    return F.split(text, "")


def low_quality_letters(threshold: int) -> str:
    """Quality characters below a threshold."""
    return "".join(chr(c) for c in range(PHRED_OFFSET, PHRED_OFFSET + threshold))


def trimmed_quality(qual: Column, threshold: int = 15) -> Column:
    """SEQ-04: quality string without trailing characters below the threshold."""
    return F.rtrim(qual, F.lit(low_quality_letters(threshold)))


def cut_to(text: Column, length: Column) -> Column:
    return F.substring(text, F.lit(1), length)


def before_adapter(seq: Column, adapter: str, first_bases: int | None = None) -> Column:
    """SEQ-05: text before the first match of the adapter (or of its first bases)."""
    return F.substring_index(seq, adapter[:first_bases] if first_bases else adapter, 1)


def reverse_complement(seq: Column) -> Column:
    """SEQ-06: letters other than A, C, G, T become N."""
    known = F.regexp_replace(seq, f"[^{COMPLEMENT_FROM}]", "N")
    return F.reverse(F.translate(known, COMPLEMENT_FROM, COMPLEMENT_TO))


def transcribe(seq: Column) -> Column:
    """SEQ-07: T to U."""
    return F.translate(seq, "Tt", "Uu")


def back_transcribe(seq: Column) -> Column:
    """SEQ-07: U to T."""
    return F.translate(seq, "Uu", "Tt")


def codons(seq: Column) -> Column:
    """Whole codons from the first base; a trailing partial codon is left out."""
    return F.regexp_extract_all(seq, F.lit("(?s).{3}"), F.lit(0))


def amino_acid(codon: Column) -> Column:
    entries = [F.lit(x) for pair in codon_table().items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), codon), F.lit("X"))


def protein(seq: Column, to_stop: bool = False) -> Column:
    """SEQ-08: translation; codons outside the table give X; optionally cut at the first stop."""
    text = F.array_join(F.transform(codons(F.upper(back_transcribe(seq))), amino_acid), "")
    return to_first_stop(text) if to_stop else text


def to_first_stop(protein_text: Column) -> Column:
    """SEQ-08: a protein up to its first stop."""
    return F.substring_index(protein_text, "*", 1)


def kmers(seq: Column, k: int) -> Column:
    """SEQ-13: all overlapping k-letter words, in one pass."""
    return F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))


def motif_positions(seq: Column, motif: str, width: int | None = None) -> Column:
    """SEQ-09: 1-based starts of a literal, or of a pattern of fixed ``width``, overlaps included."""
    words = kmers(seq, width or len(motif))
    if width is None:
        return F.filter(F.transform(words, lambda w, i: F.when(w == motif, i + 1)), lambda p: p.isNotNull())
    return F.filter(F.transform(words, lambda w, i: F.when(w.rlike(f"^{motif}$"), i + 1)),
                    lambda p: p.isNotNull())


def one_hot(seq: Column, alphabet: str = "ACGT") -> Column:
    """SEQ-12: one 0/1 array per letter of the sequence; other letters give all zeros."""
    return F.transform(letters(seq), lambda c: F.array(*[(c == a).cast("int") for a in alphabet]))


def matches_over(a: Column, b: Column, length: Column) -> Column:
    """Equal letters over the first ``length`` positions of two arrays."""
    pairs = F.zip_with(F.slice(a, F.lit(1), length), F.slice(b, F.lit(1), length),
                       lambda x, y: (x == y).cast("int"))
    return F.aggregate(pairs, F.lit(0), lambda acc, v: acc + v)


def hamming(a: Column, b: Column) -> Column:
    """SEQ-14: differing positions; texts of unequal length are an error."""
    same = matches_over(letters(a), letters(b), F.length(a))
    return F.when(F.length(a) == F.length(b), F.length(a) - same).otherwise(
        F.raise_error(F.lit("sequences differ in length")).cast("int"))


def p_distance(a: Column, b: Column) -> Column:
    """SEQ-17: share of differing positions over the shared length."""
    shared = F.least(F.length(a), F.length(b))
    return F.when(shared > 0, F.lit(1.0) - matches_over(letters(a), letters(b), shared) / shared)


#: Letters of one packed word: seven bytes, so that sums of bytes never reach the sign.
PACKED = 7
_LOW_BITS, _HIGH_BITS = int("7f" * PACKED, 16), int("80" * PACKED, 16)


def packed_words(text: Column) -> Column:
    """For each letter of an ASCII text a number that holds it and the next six; places past the end are 0."""
    codes = F.transform(letters(text), lambda c: F.ascii(c).cast("bigint"))

    def word(i):
        out = F.lit(0).cast("bigint")
        for k in range(PACKED):
            out = out.bitwiseOR(F.shiftleft(F.coalesce(F.get(codes, i + k), F.lit(0).cast("bigint")), 8 * k))
        return out

    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(0), F.length(text) - 1), word)).otherwise(F.array().cast("array<bigint>"))


def packed_word(text: Column, i: int) -> Column:
    """The i-th seven letters of an ASCII text as one number; NULL past its end."""
    return F.conv(F.hex(F.substring(text, i * PACKED + 1, PACKED)), 16, 10).cast("bigint")


def differing_letters(a: Column, b: Column) -> Column:
    """Places at which two packed words of ASCII letters differ."""
    return F.bit_count((a.bitwiseXOR(b) + F.lit(_LOW_BITS)).bitwiseAND(F.lit(_HIGH_BITS)))


def insert_size(read1: Column, read2: Column, min_overlap: int = 10, min_rate: float = 0.85,
                default: int = 300) -> Column:
    """SEQ-15: 2L minus the longest overlap of read 1's end with read 2's reverse complement.

    Overlaps run from ``min_overlap`` to L-1 (and to the mate's length) and need a match rate above ``min_rate``. Both reads
    are packed once, in memory that is linear in their length, and an overlap is compared seven letters at a time.
    """
    bound = F.struct(packed_words(read1).alias("a"), packed_words(reverse_complement(read2)).alias("b"),
                     F.length(read1).alias("n"), F.length(read2).alias("m"))

    def size(s):
        def good(n):
            def differing(total, t):
                return total + differing_letters(F.get(s["a"], s["n"] - n + t * PACKED), F.get(s["b"], t * PACKED))

            words = F.ceil(n / PACKED).cast("int")
            wrong = F.aggregate(F.sequence(F.lit(0), words - 1), F.lit(0), differing)
            # past the overlap's end read 1 has nothing, so every letter of the mate there counts as a difference
            beyond = F.least(words * PACKED, s["m"]) - n
            return (n - wrong + beyond) / n > F.lit(min_rate)

        last = F.least(s["n"] - 1, s["m"])
        candidates = F.when(last >= min_overlap, F.sequence(F.lit(min_overlap), last))
        return F.coalesce(2 * s["n"] - F.array_max(F.filter(candidates, good)), F.lit(default))

    return F.transform(F.array(bound), size)[0]

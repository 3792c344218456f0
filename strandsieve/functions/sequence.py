"""Sequence expressions: Column in, Column out, no Python in the plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bases, the IUPAC codes and their complements.
BASES, BASES_COMPLEMENT = "ACGT", "TGCA"
IUPAC, IUPAC_COMPLEMENT = "ACGTRYKMSWBDHVN", "TGCAYRMKSWVHDBN"
#: Start positions of a sequence that one row holds before it is cut into windows.
TILE = 1 << 16


def normalize(sequence: Column) -> Column:
    """Upper case, with U as T."""
    return F.translate(F.upper(sequence), "U", "T")


def reverse_complement(sequence: Column) -> Column:
    """Of bases and IUPAC codes."""
    return F.reverse(F.translate(sequence, IUPAC, IUPAC_COMPLEMENT))


def canonical(sequence: Column) -> Column:
    """The smaller, in ASCII order, of a sequence and its reverse complement."""
    return F.least(sequence, reverse_complement(sequence))


def tiles(sequence: Column, k: int, size: int = TILE) -> Column:
    """Pieces of `size` window starts each, overlapping by k-1, so that a chromosome is not one row of windows.

    One pass of a regular expression: taking the pieces by position would cost time square in the length.
    """
    return F.regexp_extract_all(sequence, F.lit(f"(?s)(?=(.{{1,{size + k - 1}}})).{{1,{size}}}"), F.lit(1))


def windows(sequence: Column, k: int) -> Column:
    """All overlapping windows of k characters, in one pass; none if the sequence is shorter."""
    return F.regexp_extract_all(sequence, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))


def is_dna(sequence: Column) -> Column:
    return sequence.rlike("^[ACGT]+$")


def scaled_entropy(kmer: Column) -> Column:
    """Shannon entropy of the four base frequencies over its maximum of two bits, from 0 to 1."""
    n = F.length(kmer)
    total = F.lit(0.0)
    for base in BASES:
        share = (n - F.length(F.replace(kmer, F.lit(base)))) / n
        total = total - F.when(share > 0, share * F.log2(share)).otherwise(0.0)
    return F.abs(total / 2)


def padded_id(prefix: str, number: Column) -> Column:
    """`prefix_000001`; longer numbers are not cut."""
    return F.format_string(f"{prefix}_%06d", number)


def representative_id(read: Column) -> Column:
    """The name shared by all reads with this sequence or its reverse complement."""
    return F.concat(F.lit("sequence_"), F.sha2(canonical(F.upper(read)), 256))


def stripped_integer(value: Column) -> Column:
    """A double as text without a trailing `.0`."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def score_text(score: Column) -> Column:
    """A decimal in plain form without trailing zeros; blank for null."""
    return F.coalesce(F.regexp_replace(score.cast("decimal(38,10)").cast("string"), r"\.?0+$", ""), F.lit(""))


def subsequence(sequence: Column, start: Column, end: Column) -> Column:
    """1-based, both ends included."""
    return F.substring(sequence, start.cast("int"), (end - start + 1).cast("int"))

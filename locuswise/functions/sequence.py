"""Bases and sequences as string expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# IUPAC one-letter codes and the bases each one stands for.
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T",
    "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}

BASES = "ACGT"


def complement(seq: Column) -> Column:
    return F.translate(seq, "ACGTRYKMBVDHacgt", "TGCAYRMKVBHDtgca")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(complement(seq))


def count_base(seq: Column, base: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))


def iupac_mask(code: Column) -> Column:
    """Bit set over A=1, C=2, G=4, T=8 for an IUPAC code; 0 for unknown letters."""
    bit = {b: 1 << i for i, b in enumerate(BASES)}
    pairs = [(F.lit(k), F.lit(sum(bit[b] for b in v))) for k, v in IUPAC.items()]
    table = F.create_map(*[x for p in pairs for x in p])
    return F.coalesce(F.try_element_at(table, F.upper(code)), F.lit(0))


def iupac_match(a: Column, b: Column) -> Column:
    return iupac_mask(a).bitwiseAND(iupac_mask(b)) != 0


def gc_fraction(seq: Column) -> Column:
    up = F.upper(seq)
    known = reduce(lambda x, y: x + y, [count_base(up, b) for b in BASES])
    return F.try_divide((count_base(up, "G") + count_base(up, "C")).cast("double"), known.cast("double"))


def homopolymer_run(seq: Column, base: Column) -> Column:
    """Length of the run of ``base`` at the start of ``seq``."""
    return F.length(seq) - F.length(F.ltrim(seq, base))


def mismatches(a: Column, b: Column, upto: int | None = None) -> Column:
    """Number of differing positions over the shared length; ``upto`` says that it is at most that, which makes one compiled sum of it."""
    n = F.least(F.length(a), F.length(b))
    if upto is not None:
        differ = lambda i: ((n >= i) & (F.substr(a, F.lit(i), F.lit(1)) != F.substr(b, F.lit(i), F.lit(1)))).cast("int")
        return sum((differ(i) for i in range(1, upto + 1)), F.lit(0))
    return F.when(n <= 0, F.lit(0)).otherwise(
        F.aggregate(
            F.sequence(F.lit(1), n),
            F.lit(0),
            lambda acc, i: acc + (F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1))).cast("int"),
        )
    )

"""Phred qualities and log-space helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET = 33
MAX_USABLE_QUALITY = 93


def phred(p: Column) -> Column:
    return F.lit(-10.0) * F.log10(p)


def rescale(quals: Column, from_offset: int = 64, to_offset: int = OFFSET) -> Column:
    """Shift every quality character from one offset to another."""
    moved = F.transform(
        F.split(quals, ""), lambda c: F.char(F.ascii(c) - F.lit(from_offset - to_offset))
    )
    return F.array_join(moved, "")


def cap_quality(q: Column, mapq: Column, minimum: int) -> Column:
    """Base quality capped at the mapping quality; below ``minimum`` it counts as 0."""
    capped = F.least(q, mapq)
    return F.when(capped < minimum, F.lit(0)).otherwise(capped)

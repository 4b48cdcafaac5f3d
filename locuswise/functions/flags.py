"""SAM flag bits as boolean columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# SAM flag bits.
BITS = {
    "paired": 0x1, "proper": 0x2, "unmapped": 0x4, "mate_unmapped": 0x8,
    "reverse": 0x10, "mate_reverse": 0x20, "first": 0x40, "second": 0x80,
    "secondary": 0x100, "fails_qc": 0x200, "duplicate": 0x400, "supplementary": 0x800,
}


def has(flag: Column, name: str) -> Column:
    return flag.bitwiseAND(F.lit(BITS[name])) != 0


def expand(df, flag: str = "flag"):
    """One boolean column ``is_<name>`` per flag bit."""
    return df.withColumns({f"is_{n}": has(F.col(flag), n) for n in BITS})

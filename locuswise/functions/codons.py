"""Standard genetic code as a lookup column."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amino acids of the standard code for codons in TCAG order, * for stop.
STANDARD = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"

CODON_TO_AA = dict(zip(("".join(c) for c in product("TCAG", repeat=3)), STANDARD))

# Start codons and three-letter amino acid names.
START_CODONS = ("ATG", "CTG", "TTG")
THREE_LETTER = {
    "A": "Ala", "C": "Cys", "D": "Asp", "E": "Glu", "F": "Phe", "G": "Gly", "H": "His",
    "I": "Ile", "K": "Lys", "L": "Leu", "M": "Met", "N": "Asn", "P": "Pro", "Q": "Gln",
    "R": "Arg", "S": "Ser", "T": "Thr", "V": "Val", "W": "Trp", "Y": "Tyr", "*": "*",
}


def _lookup(table: dict, key: Column, default: str) -> Column:
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(m, key), F.lit(default))


def amino_acid(codon: Column) -> Column:
    """One-letter amino acid; ``?`` when the codon has an unknown base."""
    return _lookup(CODON_TO_AA, F.upper(codon), "?")


def amino_acid_name(aa: Column) -> Column:
    return _lookup(THREE_LETTER, aa, "?")


def is_stop(codon: Column) -> Column:
    return amino_acid(codon) == "*"


def is_start(codon: Column) -> Column:
    return F.upper(codon).isin(*START_CODONS)

"""Variant types, allele trimming and genotype index arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from locuswise.functions.lambdas import record
from locuswise.functions.sequence import mismatches


def is_symbolic(allele: Column) -> Column:
    return allele.startswith("<") | allele.contains("[") | allele.contains("]")


def variant_type(ref: Column, alt: Column) -> Column:
    """SNP, MNP, INS, DEL, InDel, BND or SYMBOLIC of one alternate allele against the reference allele."""
    lr, la = F.length(ref), F.length(alt)
    return (
        F.when(alt.contains("[") | alt.contains("]"), F.lit("BND"))
        .when(is_symbolic(alt), F.lit("SYMBOLIC"))
        .when((lr == la) & (mismatches(ref, alt) > 1), F.lit("MNP"))
        .when(lr == la, F.lit("SNP"))
        .when(lr > la, F.when(F.startswith(ref, alt), F.lit("DEL")).otherwise(F.lit("InDel")))
        .otherwise(F.when(F.startswith(alt, ref), F.lit("INS")).otherwise(F.lit("InDel")))
    )


def site_type(ref: Column, alts: Column) -> Column:
    """Type shared by all alternate alleles, MIXED when they differ, NO_VARIATION when there is none."""
    kinds = F.array_distinct(F.transform(alts, lambda a: variant_type(ref, a)))
    return (
        F.when(F.size(alts) == 0, F.lit("NO_VARIATION")).when(F.size(kinds) > 1, F.lit("MIXED")).otherwise(F.get(kinds, F.lit(0)))
    )


def is_transition(ref: Column, alt: Column) -> Column:
    return F.concat(F.upper(ref), F.upper(alt)).isin("AG", "GA", "CT", "TC")


def in_mode(ref: Column, alt: Column, mode: str) -> Column:
    """Whether an allele belongs to the SNP, INDEL or BOTH class; MNPs count as SNP class."""
    same = (F.length(ref) == F.length(alt)) & ~is_symbolic(alt)
    return {"SNP": same, "INDEL": ~same, "BOTH": F.lit(True)}[mode]


def shared_suffix(a: Column, b: Column, keep: int = 1) -> Column:
    """Length of the common suffix, leaving at least ``keep`` bases on both sides."""
    most = F.least(F.length(a), F.length(b)) - keep
    fits = F.filter(
        F.when(most >= 1, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>")),
        lambda n: F.right(a, n) == F.right(b, n),
    )
    return F.coalesce(F.array_max(fits), F.lit(0))


def shared_prefix(a: Column, b: Column, keep: int = 1) -> Column:
    most = F.least(F.length(a), F.length(b)) - keep
    fits = F.filter(
        F.when(most >= 1, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>")),
        lambda n: F.left(a, n) == F.left(b, n),
    )
    return F.coalesce(F.array_max(fits), F.lit(0))


def trim_alleles(df, pos: str = "pos", ref: str = "ref", alt: str = "alt"):
    """Drop the shared suffix, then the shared prefix, and move the start past the prefix."""
    d = df.withColumn("_n", shared_suffix(F.col(ref), F.col(alt)))
    d = d.withColumns(
        {
            ref: F.left(F.col(ref), F.length(ref) - F.col("_n")),
            alt: F.left(F.col(alt), F.length(alt) - F.col("_n")),
        }
    ).withColumn("_n", shared_prefix(F.col(ref), F.col(alt)))
    return d.withColumns(
        {
            pos: F.col(pos) + F.col("_n"),
            ref: F.substr(F.col(ref), F.col("_n") + 1),
            alt: F.substr(F.col(alt), F.col("_n") + 1),
        }
    ).drop("_n")


def genotype_index(i: Column, j: Column) -> Column:
    """Place of genotype i/j in a PL list: k(k+1)/2 + l for k >= l."""
    hi, lo = F.greatest(i, j), F.least(i, j)
    return (hi * (hi + 1) / 2).cast("int") + lo


def genotype_pairs(n_alleles: Column) -> Column:
    """All (lo, hi) allele pairs in PL order."""
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), n_alleles - 1),
            lambda hi: F.transform(F.sequence(F.lit(0), hi), lambda lo: record(lo=lo, hi=hi)),
        )
    )


def remap_pl(pl: Column, old: Column, new: Column, fallback: str = "<NON_REF>") -> Column:
    """PLs reordered to the allele list ``new``; alleles missing in ``old`` use ``fallback``."""
    place = lambda a: F.when(
        F.array_position(old, a) > 0, F.array_position(old, a) - 1
    ).otherwise(F.array_position(old, F.lit(fallback)) - 1)
    picked = F.transform(
        genotype_pairs(F.size(new)),
        lambda g: F.get(
            pl, genotype_index(place(F.get(new, g["lo"])).cast("int"), place(F.get(new, g["hi"])).cast("int"))
        ),
    )
    return F.when(pl.isNotNull(), picked)

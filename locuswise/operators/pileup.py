"""Bases of reads by genome position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswise.functions import cigar as cg


def explode_bases(reads: DataFrame) -> DataFrame:
    """One row per base of ungapped reads: offset, pos, base, qual, and ref_base if reads have ref_bases; other read columns are kept."""
    keep = [c for c in reads.columns if c not in ("pos", "bases", "quals", "ref_bases")]
    has_ref = "ref_bases" in reads.columns
    more = [F.split("ref_bases", "").alias("ref")] if has_ref else []
    split = F.arrays_zip(F.split("bases", "").alias("base"), F.split("quals", "").alias("qual"), *more)
    return reads.select(*keep, F.col("pos").alias("_start"), F.posexplode(split).alias("offset", "_b")).select(
        *keep,
        (F.col("_start") + F.col("offset")).alias("pos"),
        "offset",
        F.col("_b.base").alias("base"),
        (F.ascii("_b.qual") - 33).alias("qual"),
        *([F.col("_b.ref").alias("ref_base")] if has_ref else []),
    )


def pileup(reads: DataFrame, tile: int | None = None) -> DataFrame:
    """One row per (read, reference position) from cigar strings.

    With ``tile`` whole reads are exchanged, to each tile of so many bases that they touch: the bases of a tile lie in one task, and ``_tile``
    is kept for groups that need no further exchange.
    Deleted bases have ``is_del`` and null base and quality. ``next_ins`` holds the bases inserted
    after the position, ``next_del`` the length of a deletion that directly follows it.
    """
    if tile:
        stop = F.greatest(F.col("pos"), cg.alignment_end(F.col("pos"), F.col("cigar")))
        reads = reads.withColumn("_tile", F.explode(F.sequence(F.floor(F.col("pos") / tile), F.floor(stop / tile)))).repartition("chrom", "_tile")
    keep = [c for c in reads.columns if c not in ("pos", "bases", "quals", "cigar")]
    blocks = cg.aligned_blocks(F.col("pos"), F.col("cigar"))
    aligned = F.filter(blocks, lambda b: F.instr(F.lit("MD=X"), b["op"]) > 0)
    after = lambda b, op: F.get(
        F.filter(F.col("_all"), lambda n: (n["op"] == op) & (n["ref"] == b["ref"] + b["len"])), F.lit(0)
    )
    d = reads.withColumn("_all", blocks).withColumn("_b", F.explode(aligned))
    d = d.withColumns({"_ins": after(F.col("_b"), "I"), "_gap": after(F.col("_b"), "D")})
    d = d.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_b.len") - 1)))
    d = d.filter(F.floor((F.col("_b.ref") + F.col("_i")) / tile) == F.col("_tile")) if tile else d
    is_del = F.col("_b.op") == "D"
    at = F.col("_b.read") + F.col("_i") + 1
    last = (F.col("_i") == F.col("_b.len") - 1) & ~is_del
    return d.select(
        *keep,
        (F.col("_b.ref") + F.col("_i")).alias("pos"),
        F.when(~is_del, at - 1).alias("offset"),
        F.when(~is_del, F.substr("bases", at, F.lit(1))).alias("base"),
        F.when(~is_del, F.ascii(F.substr("quals", at, F.lit(1))) - 33).alias("qual"),
        is_del.alias("is_del"),
        F.when(last & F.col("_ins").isNotNull(), F.substr("bases", F.col("_ins.read") + 1, F.col("_ins.len"))).alias("next_ins"),
        F.when(last & F.col("_gap").isNotNull() & F.col("_ins").isNull(), F.col("_gap.len")).alias("next_del"),
    )


def passes_base_filter(mapq: Column, qual: Column, is_del: Column, min_mapq: int, min_qual: int) -> Column:
    """Mapping quality high enough and either a deletion or a base of enough quality."""
    return (mapq >= min_mapq) & (is_del | (qual >= min_qual))


def usable_for_rank_test(mapq: Column, qual: Column, is_del: Column, min_qual: int = 6) -> Column:
    return ~is_del & ~mapq.isin(0, 255) & (qual >= min_qual)

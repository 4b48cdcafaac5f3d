"""Duplicate marking and choice of the best read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SCORED_QUALITY = 15  # fixed value: only bases of at least this quality add to a read's score


NOT_PRIMARY = 0x900  # fixed value: flag bits of secondary and supplementary lines


def read_score(quals: Column, offset: int = 33) -> Column:
    """Sum of base qualities of at least 15."""
    return F.aggregate(
        F.transform(F.split(quals, ""), lambda c: (F.ascii(c) - offset).cast("long")),
        F.lit(0).cast("long"),
        lambda acc, q: acc + F.when(q >= MIN_SCORED_QUALITY, q).otherwise(F.lit(0)),
    )


def fragment_ends(reads: DataFrame) -> DataFrame:
    """One row per (library, read_name): the ordered 5' ends, orientation and score of its fragment.

    Needs library, read_name, chrom, end5 (unclipped 5' coordinate), is_reverse and quals.
    """
    end = F.struct("chrom", "end5", "is_reverse")
    return (
        reads.withColumn("_score", read_score(F.col("quals")))
        .groupBy("library", "read_name")
        .agg(F.min(end).alias("lo"), F.max(end).alias("hi"), F.sum("_score").alias("score"), F.count("*").alias("ends"))
        .select(
            "library",
            "read_name",
            "score",
            F.col("lo.chrom").alias("chrom1"),
            F.col("lo.end5").alias("pos1"),
            F.when(F.col("ends") > 1, F.col("hi.chrom")).alias("chrom2"),
            F.when(F.col("ends") > 1, F.col("hi.end5")).alias("pos2"),
            F.when(F.col("ends") == 1, F.when(F.col("lo.is_reverse"), "R").otherwise("F"))
            .otherwise(
                F.concat(
                    F.when(F.col("lo.is_reverse"), "R").otherwise("F"), F.when(F.col("hi.is_reverse"), "R").otherwise("F")
                )
            )
            .alias("orientation"),
        )
    )


def mark_duplicates(reads: DataFrame) -> DataFrame:
    """Adds ``is_duplicate``: every mapped primary read whose fragment is not the best of its cluster.

    A cluster is (library, both 5' ends, orientation); the best has the highest score, then the
    smallest name. The best is an aggregate, so a cluster of any size is reduced on the map side,
    and the join back runs on the read name, which is spread evenly however large one cluster is.
    Unmapped, secondary and supplementary lines pass through unmarked; supplementary ones are told
    by a column ``is_supplementary`` or by the bits of ``flag``.
    """
    usable = ~F.col("is_unmapped") & ~F.col("is_secondary")
    if "is_supplementary" in reads.columns:
        usable &= ~F.col("is_supplementary")
    if "flag" in reads.columns:
        usable &= F.col("flag").bitwiseAND(NOT_PRIMARY) == 0
    ends = fragment_ends(reads.filter(usable))
    best = (
        ends.groupBy("library", "chrom1", "pos1", "chrom2", "pos2", "orientation")
        .agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("read_name").alias("name"))).alias("best"))
        .select("library", F.col("best.name").alias("read_name"), F.lit(True).alias("_best"))
    )
    return (
        reads.join(best, ["library", "read_name"], "left")
        .withColumn("is_duplicate", usable & F.col("_best").isNull())
        .drop("_best")
    )


def best_read(reads: DataFrame, keys=("sample", "read_name", "mate_no"), flag: str = "flag") -> DataFrame:
    """One alignment per read: highest mapping quality, then largest flag."""
    rest = [c for c in reads.columns if c not in keys]
    return (
        reads.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct("mapq", flag, F.xxhash64(*rest))).alias("_r"))
        .select(*keys, "_r.*")
        .select(*reads.columns)
    )


def fix_mates(reads: DataFrame) -> DataFrame:
    """Mate contig, position, strand and insert size taken from the mate row of the same read name.

    Columns added: mate_chrom, mate_pos, mate_reverse, mate_unmapped, insert_size. One aggregate
    over (sample, read_name) holds both mates; its rows have at most two entries.
    """
    mine = F.struct(
        "chrom", "pos", "is_reverse", "is_unmapped", (F.col("pos") + F.col("read_len") - 1).alias("end")
    )
    both = reads.groupBy("sample", "read_name").agg(
        F.max(F.when(F.col("mate_no") == 1, mine)).alias("_m1"), F.max(F.when(F.col("mate_no") == 2, mine)).alias("_m2")
    )
    j = reads.join(both, ["sample", "read_name"])
    j = j.withColumn("_m", F.when(F.col("mate_no") == 1, F.col("_m2")).otherwise(F.col("_m1")))
    five = lambda s, e, r: F.when(r, e).otherwise(s)
    mine5 = five(F.col("pos"), F.col("pos") + F.col("read_len") - 1, F.col("is_reverse"))
    mate5 = five(F.col("_m.pos"), F.col("_m.end"), F.col("_m.is_reverse"))
    span = mate5 - mine5
    insert = F.when(
        (F.col("chrom") == F.col("_m.chrom")) & ~F.col("is_unmapped") & ~F.col("_m.is_unmapped"),
        F.when(span >= 0, span + 1).otherwise(span - 1),
    ).otherwise(F.lit(0))
    return j.withColumns(
        {
            "mate_chrom": F.col("_m.chrom"),
            "mate_pos": F.col("_m.pos"),
            "mate_reverse": F.col("_m.is_reverse"),
            "mate_unmapped": F.col("_m.is_unmapped"),
            "insert_size": insert.cast("long"),
        }
    ).drop("_m", "_m1", "_m2")


def pair_reads(reads: DataFrame) -> DataFrame:
    """Mates side by side: one row per (sample, read_name) with the columns of mate 1 and mate 2."""
    rest = [c for c in reads.columns if c not in ("sample", "read_name", "mate_no")]
    return (
        reads.groupBy("sample", "read_name")
        .agg(*[F.first(F.when(F.col("mate_no") == m, F.struct(*rest)), ignorenulls=True).alias(f"_{m}") for m in (1, 2)])
        .select("sample", "read_name", *[F.col(f"_{m}.{c}").alias(f"{c}_{m}") for m in (1, 2) for c in rest])
    )

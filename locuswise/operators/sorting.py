"""Sorts and layouts. Range partitioning samples the keys, so hot ranges get more partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_contig_order(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Adds ``contig_idx`` from a contig dictionary (chrom, idx); unknown contigs come last.

    The dictionary is broadcast: it has one row per contig of the reference.
    """
    d = df.join(F.broadcast(contigs.select("chrom", F.col("idx").alias("contig_idx"))), "chrom", "left")
    return d.withColumn("contig_idx", F.coalesce("contig_idx", F.lit(2**31 - 1)))


def sort_coordinate(df: DataFrame, contigs: DataFrame, pos: str = "pos", ties: Sequence[str] = ()) -> DataFrame:
    """Global order by contig index and position."""
    return with_contig_order(df, contigs).orderBy("contig_idx", pos, *ties)


def sort_by_sample(df: DataFrame, order: Sequence[str] = ("chrom", "pos"), partitions: int | None = None) -> DataFrame:
    """Rows ranged by sample and position and sorted inside partitions; one sample may span several."""
    keys = ["sample", *order]
    d = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return d.sortWithinPartitions(*keys)


def window_sorted(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of one key together, ordered inside: ranged, so that a hot key is split between partitions."""
    return df.repartitionByRange(*key, *order).sortWithinPartitions(*key, *order)


def only_unmapped(reads: DataFrame) -> DataFrame:
    return reads.filter("is_unmapped")


def top1(df: DataFrame, by: Sequence[str], score, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the highest score per key as an aggregate: reduced on the map side."""
    rest = [c for c in df.columns if c not in by]
    best = F.max_by(F.struct(*rest), F.struct(score.alias("_s"), *[F.col(t) for t in ties]))
    return df.groupBy(*by).agg(best.alias("_r")).select(*by, "_r.*").select(*df.columns)

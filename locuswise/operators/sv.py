"""Structural variants from discordant read pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswise.functions.stats import log_poisson_tail
from locuswise.operators.scan import TILE, islands, previous, with_row

# Default limits of the structural-variant job.
MAX_INSERT = 2000
MIN_DISTANCE = 50
MAX_SCORE = 99


def classify_pairs(reads: DataFrame, min_mapq: int = 35, max_size: int = 1_000_000, keep_cross: bool = False) -> DataFrame:
    """Adds ``pair_type``: FR, RF, FF_RR or, when kept, Diff for a mate on another contig.

    Low quality, duplicate, half-mapped and too distant pairs are dropped.
    """
    forward_first = F.col("pos") < F.col("mate_pos")
    kind = (
        F.when(F.col("mate_chrom") != F.col("chrom"), "Diff")
        .when(F.col("is_reverse") == F.col("mate_reverse"), "FF_RR")
        .when(forward_first, F.when(F.col("is_reverse"), "RF").otherwise("FR"))
        .otherwise(F.when(F.col("is_reverse"), "FR").otherwise("RF"))
    )
    ok = (F.col("mapq") > min_mapq) & ~F.col("is_dup") & (F.abs("insert_size") < max_size)
    for c in ("is_unmapped", "mate_unmapped"):
        if c in reads.columns:
            ok = ok & ~F.col(c)
    d = reads.filter(ok).withColumn("pair_type", kind)
    return d if keep_cross else d.filter("pair_type <> 'Diff'")


def insert_size_model(reads: DataFrame, min_mapq: int = 35, times: float = 3.0, mean: int | None = None, sd: float | None = None) -> DataFrame:
    """One row: mean (the most common insert size), one-sided deviations and the normal range.

    Computed from a histogram of at most 2,000 sizes. A given ``mean`` or ``sd`` is used as it is.
    """
    use = reads.filter(F.col("is_proper") & F.col("insert_size").between(1, MAX_INSERT) & (F.col("mapq") >= min_mapq))
    hist = use.groupBy("insert_size").agg(F.count("*").alias("n"))
    mode = F.lit(mean) if mean is not None else F.max_by("insert_size", F.struct("n", -F.col("insert_size")))
    top = hist.agg(mode.alias("mean"), F.collect_list(F.struct("insert_size", "n")).alias("_h"))
    side = lambda keep: F.filter("_h", keep)

    def dev(rows):
        n = F.aggregate(rows, F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
        s = F.aggregate(rows, F.lit(0.0), lambda acc, x: acc + F.pow((x["insert_size"] - F.col("mean")).cast("double"), 2) * x["n"])
        return F.sqrt(F.try_divide(s, (n - 1).cast("double")))

    low = F.lit(sd) if sd is not None else dev(side(lambda x: x["insert_size"] < F.col("mean")))
    up = F.lit(sd) if sd is not None else dev(side(lambda x: x["insert_size"] >= F.col("mean")))
    d = top.withColumns({"low_sd": F.coalesce(low, F.lit(0.0)), "up_sd": F.coalesce(up, F.lit(0.0))})
    return d.select(
        "mean", "low_sd", "up_sd", (F.col("mean") - times * F.col("low_sd")).alias("lower"), (F.col("mean") + times * F.col("up_sd")).alias("upper")
    )


def with_model(df: DataFrame, model: DataFrame) -> DataFrame:
    """Attach the one-row model to every row."""
    return with_row(df, model)


def sv_type() -> Column:
    """DEL, INS, INV, ITX or CTX from pair type and insert size; null for normal pairs."""
    size = F.abs("insert_size")
    return (
        F.when(F.col("pair_type") == "FR", F.when(size > F.col("upper"), "DEL").when(size < F.col("lower"), "INS"))
        .when(F.col("pair_type") == "RF", "ITX")
        .when(F.col("pair_type") == "FF_RR", "INV")
        .when(F.col("pair_type") == "Diff", "CTX")
    )


def discordant_reads(classified: DataFrame, model: DataFrame) -> DataFrame:
    """Reads with their variant type, and the break distance and covered length of their contig."""
    d = with_model(classified, model).withColumn("sv_type", sv_type())
    contig = d.groupBy("chrom").agg(
        F.greatest(F.min(F.col("mean") - 2 * F.col("read_len")), F.lit(MIN_DISTANCE)).cast("double").alias("_d"),
        (F.max(F.col("pos") + F.col("read_len") - 1) - F.min("pos") + 1).alias("ref_length"),
        F.count_if((F.col("pair_type") == "FR") & F.col("sv_type").isNotNull()).alias("_indels"),
    )
    share = F.try_divide(F.col("ref_length").cast("double"), F.col("_indels").cast("double"))
    dist = F.greatest(F.when(F.col("_indels") == 0, F.col("_d")).otherwise(F.least(F.col("_d"), share)), F.lit(float(MIN_DISTANCE)))
    # one row per contig of the reference
    return d.filter("sv_type IS NOT NULL").join(F.broadcast(contig.select("chrom", "ref_length", dist.alias("dist"))), "chrom")


def cluster_discordant(reads: DataFrame, max_coverage: float = 1000.0, min_length: int = 0, tile: float = TILE) -> DataFrame:
    """Adds ``cluster`` (its first position) and ``cluster_length``; reads of rejected clusters are dropped.

    A cluster ends where the next start lies more than ``dist`` away. Clusters are found on distinct
    positions and reach the reads by a join on the position.
    """
    spots = reads.groupBy("chrom", "pos").agg(
        F.max("dist").alias("dist"), F.max(F.col("pos") + F.col("read_len") - 1).alias("_end"), F.sum("read_len").alias("_bases")
    )
    s = previous(spots, ["chrom"], "pos", {"_pp": "pos"}, tile)
    s = islands(s, ["chrom"], "pos", F.col("_pp").isNull() | (F.col("pos") - F.col("_pp") > F.col("dist")), "cluster", tile)
    size = s.groupBy("chrom", "cluster").agg((F.max("_end") - F.min("pos") + 1).alias("cluster_length"), F.sum("_bases").alias("_b"))
    coverage = F.col("_b") / F.col("cluster_length")
    good = size.filter((coverage > 0) & (coverage < max_coverage) & (F.col("cluster_length") > min_length)).drop("_b")
    labels = s.select("chrom", "pos", "cluster").join(good, ["chrom", "cluster"])
    return reads.join(labels, ["chrom", "pos"])


def link_clusters(reads: DataFrame) -> DataFrame:
    """Read names seen in exactly two clusters, with both clusters."""
    c = F.struct("chrom", "cluster", "cluster_length")
    g = reads.groupBy("read_name").agg(
        F.min(c).alias("a"), F.max(c).alias("b"), F.count_distinct("chrom", "cluster").alias("_n"),
        F.min(F.struct("sv_type", "library", "insert_size", "mean", "ref_length")).alias("_r"),
    )
    return g.filter("_n = 2").select("read_name", "a", "b", "_r.*")


LINK = ["chrom1", "start1", "length1", "chrom2", "start2", "length2"]


def summarise_links(links: DataFrame, min_pairs: int = 2) -> DataFrame:
    """Majority type per linked pair of clusters with pair count, mean size and counts per library.

    Libraries are counted first; a link then has one row per (type, library). Ties go to the first type by name.
    """
    per = links.select(
        F.col("a.chrom").alias("chrom1"), F.col("a.cluster").alias("start1"), F.col("a.cluster_length").alias("length1"),
        F.col("b.chrom").alias("chrom2"), F.col("b.cluster").alias("start2"), F.col("b.cluster_length").alias("length2"),
        "sv_type", "library", F.abs(F.col("insert_size") - F.col("mean")).cast("long").alias("_size"), "ref_length",
    ).groupBy(*LINK, "sv_type", "library").agg(F.count("*").alias("n"), F.sum("_size").alias("_size"), F.max("ref_length").alias("ref_length"))
    typ = per.groupBy(*LINK, "sv_type").agg(
        F.sum("n").alias("pairs"), F.sum("_size").alias("_size"), F.max("ref_length").alias("ref_length"),
        F.sort_array(F.collect_list(F.struct("library", "n"))).alias("libraries"),
    )
    best = typ.groupBy(*LINK).agg(F.min(F.struct((-F.col("pairs")).alias("o"), "sv_type", "pairs", "_size", "ref_length", "libraries")).alias("_b"))
    return best.select(*LINK, "_b.sv_type", "_b.pairs", (F.col("_b._size") / F.col("_b.pairs")).alias("size"), "_b.ref_length", "_b.libraries").filter(
        F.col("pairs") >= min_pairs
    )


def sv_score(links: DataFrame, min_score: int = 0) -> DataFrame:
    """Adds ``score``: phred of the summed log Poisson tails over libraries, at most 99."""
    region = (F.col("length1") + F.col("length2")).cast("double")
    log_p = F.aggregate(
        "libraries", F.lit(0.0), lambda acc, x: acc + log_poisson_tail(x["n"], region * x["n"] / F.col("ref_length"))
    )
    phred = -10.0 * log_p / F.log(F.lit(10.0))
    score = F.when(phred > MAX_SCORE, F.lit(MAX_SCORE)).otherwise((phred + 0.5).cast("int"))
    return links.withColumn("score", score).filter(F.col("score") >= min_score)

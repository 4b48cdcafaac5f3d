"""Interval operators on 1-based closed coordinates: joins, merges, tiles, segments, neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locuswise.operators.scan import TILE, following, islands, running

BIN = 1024
# Rows of an array of the packed side, and the least stretch of starts that share one.
PACK, FINE = 512, 32


def _bins(start: str, end: str, size: int):
    return F.sequence(F.floor(F.col(start) / size), F.floor(F.col(end) / size))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    how: str = "inner",
    left_on: Sequence[str] = ("chrom", "start", "end"),
    right_on: Sequence[str] = ("chrom", "start", "end"),
    bin_size: int = BIN,
    salt: int = 1,
    keep_bin: bool = False,
) -> DataFrame:
    """Overlap join as an equi join on genome bins.

    Inner and left return the columns of both sides (right coordinates renamed to ``r_*`` when
    the names clash); semi and anti return left rows once. A pair that shares several bins is kept
    in the first shared one. The right rows of a bin are packed by place into short arrays, so that a left row
    meets the arrays it may overlap and not every row of the bin. ``salt`` > 1 spreads each bin of the left side over that many tasks
    and copies the right side as often; adaptive skew join handles the remaining imbalance. With ``keep_bin`` an inner join keeps the
    bin of a pair as ``_bin`` and leaves the pairs of a bin in one task, so that grouping by bin needs no second exchange.
    """
    if how in ("semi", "anti"):
        return _covered(left, right, how, left_on, right_on, bin_size, salt)
    if how not in ("inner", "left"):
        raise ValueError(f"unknown interval join: {how}")
    if keep_bin and (how != "inner" or salt > 1):
        raise ValueError("the bin is kept by an inner join without salt only")
    lc, ls, le = left_on
    clash = {c: f"r_{c}" for c in right.columns if c in left.columns}
    right = right.withColumnsRenamed(clash)
    rc, rs, re_ = [clash.get(c, c) for c in right_on]

    bins = _bins(ls, le, bin_size)
    if how == "left":
        # a row that meets nothing stays in one bin and matches nothing there; one join serves both kinds of rows, as the parts of a
        # union would share the tasks by bytes and not by pairs
        a = covered_flag(left, right, "_hit", left_on, (rc, rs, re_), bin_size, salt)
        a = a.withColumn("_bin", F.explode(F.when(F.col("_hit"), bins).otherwise(F.array(F.floor(F.col(ls) / bin_size)))))
    else:
        a = left.withColumn("_bin", F.explode(bins)).filter(F.col("_bin").isNotNull())
        a = a.repartition(lc, "_bin") if keep_bin else a
    b = _packed(right, rc, rs, re_, bin_size)
    on = (F.col(lc) == F.col("_rchrom")) & (F.col("_bin") == F.col("_rbin"))
    if salt > 1:
        a = a.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salt)).cast("int"))
        b = b.withColumn("_rsalt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        on = on & (F.col("_salt") == F.col("_rsalt"))
    near = (F.col(ls) <= F.col("_last")) & (F.col(le) >= F.col("_first"))
    overlap = (F.col(ls) <= F.col(re_)) & (F.col(le) >= F.col(rs))
    at = F.greatest(F.col(ls), F.col(rs))
    first_shared = (at >= F.col("_bin") * bin_size) & (at < (F.col("_bin") + 1) * bin_size)
    if how == "inner":
        j = a.join(b, on & near, "inner").select(*left.columns, "_bin", F.inline("_rows")).filter(overlap & first_shared)
    else:
        j = a.join(b, on & near & F.col("_hit"), "left").select(*left.columns, "_hit", "_bin", F.inline_outer("_rows"))
        j = j.filter(~F.col("_hit") | F.coalesce(overlap & first_shared, F.lit(False)))
    return j.select(*left.columns, *right.columns, *(["_bin"] if keep_bin else []))


def _packed(right: DataFrame, chrom: str, start: str, end: str, bin_size: int) -> DataFrame:
    """Rows of a bin as arrays of at most ``PACK`` rows that start close to each other, with the places they span."""
    fine = max(FINE, bin_size // 16)
    b = right.withColumn("_rbin", F.explode(_bins(start, end, bin_size)))
    b = b.withColumn("_sub", F.floor(F.greatest(F.col(start), F.col("_rbin") * bin_size) / fine))
    part = ["_rchrom", "_rbin", "_sub"]
    b = b.withColumn("_rchrom", F.col(chrom))
    number = F.row_number().over(Window.partitionBy(*part).orderBy(start)) - 1
    return b.withColumn("_pack", F.floor(number / PACK)).groupBy(*part, "_pack").agg(
        F.min(start).alias("_first"), F.max(end).alias("_last"), F.collect_list(F.struct(*right.columns)).alias("_rows")
    ).drop("_sub", "_pack")


def coverage_index(
    regions: DataFrame, on: Sequence[str] = ("chrom", "start", "end"), bin_size: int = BIN, merged: bool = False
) -> DataFrame:
    """One row per genome bin up to the last region: covered spans in it and the next covered base after it."""
    c, s, e = on
    flat = regions.select(F.col(c).alias("chrom"), F.col(s).alias("start"), F.col(e).alias("end"))
    flat = flat if merged else merge_intervals(flat, gap=1)
    cut = flat.select(
        "chrom", "start", "end", F.explode(_bins("start", "end", bin_size)).alias("bin")
    ).select(
        "chrom",
        "bin",
        F.greatest(F.col("start"), F.col("bin") * bin_size).alias("s"),
        F.least(F.col("end"), F.col("bin") * bin_size + bin_size - 1).alias("e"),
    )
    # every bin up to the last region gets a row, also without a span in it
    empty = flat.groupBy("chrom").agg(F.max("end").alias("last")).select(
        "chrom", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("last") / bin_size))).alias("bin")
    )
    grid = (
        cut.unionByName(empty, allowMissingColumns=True)
        .groupBy("chrom", "bin")
        .agg(F.collect_list(F.when(F.col("s").isNotNull(), F.struct("s", "e"))).alias("spans"), F.min("s").alias("first"))
    )
    return running(grid, ["chrom"], "bin", {"next_start": ("min", F.col("first"))}, reverse=True, inclusive=False).drop(
        "first"
    )


def covered_flag(
    left: DataFrame,
    regions: DataFrame,
    out: str,
    left_on: Sequence[str] = ("chrom", "start", "end"),
    right_on: Sequence[str] = ("chrom", "start", "end"),
    bin_size: int = BIN,
    salt: int = 1,
    merged: bool = False,
) -> DataFrame:
    """Adds a boolean: does the row overlap any region? Rows are neither copied nor lost.

    The regions are merged to disjoint spans first (skipped with ``merged``), so a row is covered
    when a span in the bin of its start overlaps it or when the next covered base after that bin
    lies before its end. One row looks up one bin.
    """
    lc, ls, le = left_on
    idx = coverage_index(regions, right_on, bin_size, merged).withColumnsRenamed({"chrom": "_chrom", "bin": "_rbin"})
    a = left.withColumn("_bin", F.floor(F.col(ls) / bin_size))
    on = (F.col(lc) == F.col("_chrom")) & (F.col("_bin") == F.col("_rbin"))
    if salt > 1:
        a = a.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salt)).cast("int"))
        idx = idx.withColumn("_rsalt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        on = on & (F.col("_salt") == F.col("_rsalt"))
    here = F.exists("spans", lambda x: (x["e"] >= F.col(ls)) & (x["s"] <= F.col(le)))
    hit = F.coalesce(here, F.lit(False)) | F.coalesce(F.col("next_start") <= F.col(le), F.lit(False))
    return a.join(idx, on, "left").select(*left.columns, hit.alias(out))


def _covered(left, right, how, left_on, right_on, bin_size, salt):
    flagged = covered_flag(left, right, "_hit", left_on, right_on, bin_size, salt)
    return flagged.filter("_hit" if how == "semi" else "NOT _hit").drop("_hit")


def merge_intervals(
    df: DataFrame,
    keys: Sequence[str] = ("chrom",),
    start: str = "start",
    end: str = "end",
    gap: int = 0,
    pad: int = 0,
    tile: float = TILE,
) -> DataFrame:
    """Union of intervals; neighbours at most ``gap`` bases apart are joined, each widened by ``pad``.

    ``gap=1`` joins intervals that touch. Output: keys, start, end, n (intervals merged).
    """
    keys = list(keys)
    by_start = (
        df.select(*keys, (F.col(start) - pad).alias("start"), (F.col(end) + pad).alias("end"))
        .groupBy(*keys, "start")
        .agg(F.max("end").alias("end"), F.count("*").alias("n"))
    )
    reach = running(by_start, keys, "start", {"_reach": ("max", F.col("end"))}, tile=tile, inclusive=False)
    fresh = F.col("_reach").isNull() | (F.col("start") > F.col("_reach") + gap)
    labelled = islands(reach, keys, "start", fresh, "_island", tile=tile)
    return labelled.groupBy(*keys, "_island").agg(F.max("end").alias("end"), F.sum("n").alias("n")).select(
        *keys, F.col("_island").alias("start"), "end", "n"
    )


def runs(df: DataFrame, keys: Sequence[str], pos: str = "pos", tile: float = TILE) -> DataFrame:
    """Runs of consecutive positions. Input may repeat positions. Output: keys, start, end."""
    points = df.select(*keys, F.col(pos).alias("start"), F.col(pos).alias("end"))
    return merge_intervals(points, keys, gap=1, tile=tile).drop("n")


def uncovered_runs(covered: DataFrame, sites: DataFrame, keys: Sequence[str] = ("chrom",), pos: str = "pos"):
    """Runs of ``sites`` positions that do not occur in ``covered``."""
    keys = list(keys)
    seen = covered.select(*keys, pos).distinct()
    return runs(sites.select(*keys, pos).join(seen, keys + [pos], "left_anti"), keys, pos)


def assign_windows(
    df: DataFrame, size: int, extend: int = 0, pos: str = "pos", end: str | None = None
) -> DataFrame:
    """Copy each row to its own tile and to tiles reached by extending it on both sides.

    Adds ``window`` and ``is_owner`` (true in the tile of the start).
    """
    stop = F.col(end or pos)
    own = F.floor(F.col(pos) / size)
    reached = F.array_distinct(
        F.array(own, F.floor(F.greatest(F.col(pos) - extend, F.lit(0)) / size), F.floor((stop + extend) / size))
    )
    return df.withColumn("window", F.explode(reached)).withColumn("is_owner", F.col("window") == own)


def explode_windows(df: DataFrame, size: int, start: str = "start", end: str = "end") -> DataFrame:
    """Copy each block to every tile it spans."""
    return df.withColumn("window", F.explode(_bins(start, end, size)))


def window_scaffold(contigs: DataFrame, size: int, samples: DataFrame | None = None) -> DataFrame:
    """Every tile of every contig, for each sample if given; tiles are cut at the contig end.

    ``samples`` is broadcast because a cohort's sample list is a header-sized dimension.
    """
    tiles = contigs.select(
        "chrom",
        "length",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))).alias("window"),
    ).select(
        "chrom",
        "window",
        (F.col("window") * size + 1).alias("start"),
        F.least((F.col("window") + 1) * size, F.col("length")).alias("end"),
    )
    if samples is None:
        return tiles
    names = samples.select("sample").distinct().agg(F.sort_array(F.collect_set("sample")).alias("_names"))
    keyed = tiles.withColumn("_k", F.lit(0))
    return (
        keyed.join(names.withColumn("_k", F.lit(0)).hint("broadcast"), "_k")
        .withColumn("sample", F.explode("_names"))
        .drop("_k", "_names")
    )


def segments(df: DataFrame, keys: Sequence[str] = ("chrom",), start: str = "start", end: str = "end") -> DataFrame:
    """Cut the axis at every start and after every end; consecutive cuts give segments.

    Output: keys, start, end for each piece between two neighbouring cuts.
    """
    keys = list(keys)
    cuts = (
        df.select(*keys, F.explode(F.array(F.col(start), F.col(end) + 1)).alias("start"))
        .distinct()
    )
    nxt = following(cuts, keys, "start", {"_next": "start"})
    return nxt.filter(F.col("_next").isNotNull()).select(*keys, "start", (F.col("_next") - 1).alias("end"))


def interval_intersect(a: DataFrame, b: DataFrame, salt: int = 1) -> DataFrame:
    """Overlapping part of every overlapping pair of (chrom, start, end) rows."""
    j = interval_join(a, b.select("chrom", "start", "end"), salt=salt)
    return j.withColumns(
        {"start": F.greatest("start", "r_start"), "end": F.least("end", "r_end")}
    ).drop("r_chrom", "r_start", "r_end")


def linear_coord(contigs: DataFrame) -> DataFrame:
    """Offset of each contig on one axis. The dictionary has one row per contig, so one window is enough."""
    w = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    return contigs.withColumn("offset", F.coalesce(F.sum("length").over(w), F.lit(0).cast("long")))


def closest_gene(
    points: DataFrame,
    genes: DataFrame,
    coding: str | None = None,
    tile: float = TILE,
) -> DataFrame:
    """Nearest gene of each (chrom, pos): distance 0 inside, else bases to the nearer edge.

    Ties prefer coding genes, then the name. Works on distinct positions: inside hits come from an
    interval join, the nearest gene before and after from running scans over gene ends and starts.
    """
    cod = F.col(coding) if coding else F.lit(True)
    g = genes.select("chrom", "start", "end", "name", cod.alias("_cod"))
    spots = points.select("chrom", "pos").distinct()
    inside = interval_join(
        spots.withColumns({"start": F.col("pos"), "end": F.col("pos")}), g.withColumnRenamed("chrom", "gchrom"),
        right_on=("gchrom", "start", "end"),
    ).groupBy("chrom", "pos").agg(
        F.min(F.struct(F.lit(0).cast("long").alias("d"), (~F.col("_cod")).alias("n"), F.col("name").alias("name"))).alias("hit")
    )

    def edge(col, kind):
        # one row per edge position: the preferred gene there
        return g.groupBy("chrom", F.col(col).alias("p")).agg(
            F.min(F.struct((~F.col("_cod")).alias("n"), F.col("name").alias("name"))).alias("best")
        ).withColumn("side", F.lit(kind))

    def nearest(col, reverse):
        marks = spots.select("chrom", F.col("pos").alias("p"), F.lit(True).alias("is_spot")).unionByName(
            edge(col, "g").select("chrom", "p", "best"), allowMissingColumns=True
        ).groupBy("chrom", "p").agg(F.max("is_spot").alias("is_spot"), F.max("best").alias("best"))
        val = F.when(F.col("best").isNotNull(), F.struct(F.col("p").alias("p"), F.col("best.n").alias("n"), F.col("best.name").alias("name")))
        seen = running(marks, ["chrom"], "p", {"near": ("min" if reverse else "max", val)}, tile=tile, reverse=reverse, inclusive=False)
        return seen.filter("is_spot").select(
            "chrom",
            F.col("p").alias("pos"),
            F.when(
                F.col("near").isNotNull(),
                F.struct(F.abs(F.col("near.p") - F.col("p")).alias("d"), F.col("near.n").alias("n"), F.col("near.name").alias("name")),
            ).alias("after" if reverse else "before"),
        )

    best = (
        nearest("end", False)
        .join(nearest("start", True), ["chrom", "pos"], "full")
        .join(inside, ["chrom", "pos"], "left")
        .select("chrom", "pos", F.coalesce(F.col("hit"), F.least("before", "after")).alias("best"))
    )
    return points.join(
        best.select("chrom", "pos", F.col("best.name").alias("gene"), F.col("best.d").alias("distance")),
        ["chrom", "pos"],
        "left",
    )

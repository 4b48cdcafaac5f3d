"""Depth, coverage, target and region reports.

Depth is kept as segments (start, end, depth...) made from +1/-1 events, not as one row per base,
so the work follows the number of reads and not the number of bases. All spans are 1-based closed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswise.functions import cigar as cg
from locuswise.functions.sequence import mismatches
from locuswise.operators.intervals import covered_flag, interval_join, merge_intervals, runs
from locuswise.operators.reference import MASKED, ref_blocks, reference_in_reads, stretches
from locuswise.operators.scan import TILE, following, scan, with_row

LEVELS = (1, 4, 10, 20, 30, 50, 100)  # fixed values: depth thresholds of the target report


def aligned_spans(reads: DataFrame) -> DataFrame:
    """Reference spans of each read: aligned stretches and, with ``is_del``, deletions."""
    keep = [c for c in reads.columns if c not in ("bases", "quals", "cigar")]
    blocks = F.filter(cg.aligned_blocks(F.col("pos"), F.col("cigar")), lambda b: F.instr(F.lit("MD=X"), b["op"]) > 0)
    return reads.withColumn("_b", F.explode(blocks)).select(
        *keep,
        F.col("_b.ref").alias("start"),
        (F.col("_b.ref") + F.col("_b.len") - 1).alias("end"),
        (F.col("_b.op") == "D").alias("is_del"),
    )


def depth_segments(
    spans: DataFrame, keys: Sequence[str], counts: Mapping[str, Column] | None = None, tile: float = TILE
) -> DataFrame:
    """Stretches of constant depth. ``counts`` maps a depth name to the spans it counts.

    Output: keys, start, end and one bigint per count; stretches where every count is 0 are left out.
    """
    keys = list(keys)
    counts = dict(counts or {"depth": F.lit(True)})
    one = {n: F.when(c, F.lit(1)).otherwise(F.lit(0)) for n, c in counts.items()}
    flagged = spans.select(*keys, "start", "end", *[v.alias(n) for n, v in one.items()])
    events = flagged.select(
        *keys,
        F.explode(F.array(F.struct(F.col("start").alias("p"), F.lit(1).alias("s")), F.struct((F.col("end") + 1).alias("p"), F.lit(-1).alias("s")))).alias("_e"),
        *counts,
    )
    steps = events.groupBy(*keys, F.col("_e.p").alias("start")).agg(
        *[F.sum(F.col(n) * F.col("_e.s")).alias(f"_d_{n}") for n in counts]
    )
    specs = {n: ("sum", F.col(f"_d_{n}"), False, True) for n in counts}
    ended = scan(steps, keys, "start", specs | {"_next": ("min", F.col("start"), True, False)}, tile)
    some = None
    for n in counts:
        some = (F.col(n) > 0) if some is None else some | (F.col(n) > 0)
    return ended.filter(some & F.col("_next").isNotNull()).select(
        *keys, "start", (F.col("_next") - 1).alias("end"), *[F.col(n).cast("long").alias(n) for n in counts]
    )


def depth_positions(segments: DataFrame) -> DataFrame:
    """One row per covered position; only for places where single positions are wanted."""
    rest = [c for c in segments.columns if c not in ("start", "end")]
    return segments.select(*rest, F.explode(F.sequence("start", "end")).alias("pos"))


STANDARD_COUNTS = {
    "depth": "NOT is_del",
    "dedup": "NOT is_del AND NOT is_duplicate",
    "deleted": "is_del",
}


def standard_depth(spans: DataFrame, keys: Sequence[str], min_mapq: int = 20) -> DataFrame:
    """Raw, duplicate-removed, mapq-limited and sex-prediction depth in one pass.

    Sex depth counts reads with mapping quality above 20 that are not duplicates.
    """
    counts = {n: F.expr(e) for n, e in STANDARD_COUNTS.items()}
    counts["mapq_depth"] = ~F.col("is_del") & (F.col("mapq") >= min_mapq)
    counts["sex_depth"] = ~F.col("is_del") & (F.col("mapq") > 20) & ~F.col("is_duplicate")
    return depth_segments(spans, keys, counts)


def _length() -> Column:
    return F.col("end") - F.col("start") + 1


def coverage_report(segments: DataFrame, contigs: DataFrame, unknown: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Coverage per contig and, as contig ``total``, over the genome.

    ``segments`` has depth, dedup and deleted; ``contigs`` has chrom and length; ``unknown`` holds
    runs of N. The contig dictionary is broadcast: it has one row per contig of the reference.
    """
    keys = list(keys)
    depth_of = {"covered": (F.col("depth") > 0) | (F.col("deleted") > 0)}
    depth_of |= {f"ge{k}": (F.col("depth") > 0) & (F.col("dedup") >= k) for k in (4, 10, 30)}
    plain = segments.groupBy(*keys, "chrom").agg(
        *[F.sum(F.when(c, _length()).otherwise(0)).alias(n) for n, c in depth_of.items()],
        F.sum(F.col("depth") * _length()).alias("depth_sum"),
        F.sum(F.when(F.col("depth") > 0, F.col("dedup") * _length()).otherwise(0)).alias("dedup_sum"),
    )
    on_n = interval_join(segments, unknown.select("chrom", "start", "end"))
    part = F.least("end", "r_end") - F.greatest("start", "r_start") + 1
    lost = on_n.groupBy(*keys, "chrom").agg(*[F.sum(F.when(c, part).otherwise(0)).alias(f"_n_{n}") for n, c in depth_of.items()])
    known = contigs.join(
        unknown.groupBy("chrom").agg(F.sum(_length()).alias("_n")), "chrom", "left"
    ).select("chrom", "length", (F.col("length") - F.coalesce("_n", F.lit(0).cast("long"))).alias("known_length"))
    per = (
        plain.join(lost, keys + ["chrom"], "left")
        .join(F.broadcast(known), "chrom", "left")
        .withColumns({f"known_{n}": F.col(n) - F.coalesce(f"_n_{n}", F.lit(0).cast("long")) for n in depth_of})
    )
    sums = [*depth_of, *[f"known_{n}" for n in depth_of], "depth_sum", "dedup_sum", "length", "known_length"]
    both = per.select(*keys, F.explode(F.array(F.col("chrom"), F.lit("total"))).alias("chrom"), *sums)
    total = both.groupBy(*keys, "chrom").agg(*[F.sum(c).alias(c) for c in sums])
    rate = lambda a, b: F.try_divide(F.col(a) * 100.0, F.col(b).cast("double"))
    return total.select(
        *keys,
        "chrom",
        *sums,
        F.try_divide(F.col("depth_sum").cast("double"), F.col("covered").cast("double")).alias("mean_depth"),
        F.try_divide(F.col("dedup_sum").cast("double"), F.col("covered").cast("double")).alias("mean_dedup_depth"),
        *[rate(n, "length").alias(f"{n}_rate") for n in depth_of],
        *[rate(f"known_{n}", "known_length").alias(f"known_{n}_rate") for n in depth_of],
    )


def mismatch_counts(reads: DataFrame, ref: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mismatching bases per ungapped read against the reference; bases outside the reference don't count. Each read is compared in its row."""
    d = reference_in_reads(reads, ref)
    beyond = F.length("ref_bases") - F.length(F.replace("ref_bases", F.lit(MASKED), F.lit("")))
    differ = (mismatches(F.col("bases"), F.col("ref_bases")) - beyond).cast("long")
    return d.select(*keys, "read_name", "mate_no", differ.alias("_n")).groupBy(*keys, "read_name", "mate_no").agg(F.sum("_n").alias("mismatches"))


def basic_report(reads: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Totals and percentages of mapped, unique, duplicate, paired, clipped, indel and mismatch reads.

    Needs is_unmapped, is_unique, is_duplicate, is_first, mate_unmapped, cigar, mismatches, read_len.
    """
    mapped = ~F.col("is_unmapped")
    tests = {
        "mapped": mapped,
        "unique": mapped & F.col("is_unique"),
        "duplicate": mapped & F.col("is_duplicate"),
        "paired": mapped & F.col("is_first") & ~F.col("mate_unmapped"),
        "clipped": mapped & cg.contains(F.col("cigar"), "SH"),
        "indel": mapped & cg.contains(F.col("cigar"), "ID"),
        "mismatch": mapped & (F.coalesce("mismatches", F.lit(0).cast("long")) > 0),
    }
    d = reads.groupBy(*keys).agg(
        F.count("*").alias("total"),
        *[F.count_if(t).alias(n) for n, t in tests.items()],
        F.sum(F.when(mapped, F.col("read_len")).otherwise(0)).cast("long").alias("mapped_bases"),
        F.sum(F.when(mapped, F.coalesce("mismatches", F.lit(0).cast("long"))).otherwise(0)).alias("mismatch_bases"),
    )
    return d.withColumns({f"{n}_rate": F.col(n) * 100.0 / F.col("total") for n in tests})


def target_report(
    reads: DataFrame, segments: DataFrame, regions: DataFrame, flank: int = 200, salt: int = 8
) -> DataFrame:
    """One row: reads and bases on target and flank, depth thresholds, X / Y depth, specificity.

    ``reads`` has chrom, start, end, is_unique and read_len. Targets are merged first, so the depth
    join meets disjoint spans and a base counts once.
    """
    target = merge_intervals(regions, gap=1).drop("n")
    wide = merge_intervals(regions, gap=1, pad=flank).drop("n")

    flagged = covered_flag(covered_flag(reads, target, "_t", salt=salt, merged=True), wide, "_f", salt=salt, merged=True)
    counts = flagged.agg(
        F.count_if("_t").alias("target_reads"),
        F.count_if(F.col("_t") & F.col("is_unique")).alias("target_unique_reads"),
        F.count_if("_f").alias("flank_reads"),
        F.count_if("is_unique").alias("unique_reads"),
        F.sum("read_len").cast("long").alias("mapped_bases"),
    )
    both = target.withColumn("_on", F.lit(True)).unionByName(wide.withColumn("_on", F.lit(False)))
    hit = interval_join(segments, both).withColumn("_len", F.least("end", "r_end") - F.greatest("start", "r_start") + 1)
    on = F.col("_on")
    sex = lambda c: on & F.lower("chrom").isin(c, f"chr{c}")
    of = lambda c, v: F.coalesce(F.sum(F.when(c, v)), F.lit(0).cast("long"))
    bases = hit.agg(
        *[of(on & (F.col(d) >= k), F.col("_len")).alias(f"target_{d}_ge{k}") for d in ("depth", "dedup") for k in LEVELS],
        of(on, F.col("depth") * F.col("_len")).alias("target_depth_sum"),
        of(on, F.col("dedup") * F.col("_len")).alias("target_dedup_sum"),
        of(sex("x"), F.col("depth") * F.col("_len")).alias("x_depth_sum"),
        of(sex("y"), F.col("depth") * F.col("_len")).alias("y_depth_sum"),
        of(~on, F.col("depth") * F.col("_len")).alias("flank_depth_sum"),
    )
    size = target.agg(F.sum(_length()).alias("target_size"))

    one = None
    for d in (counts, bases, size):
        one = d if one is None else with_row(one, d)  # every side is one row
    return one.withColumns(
        {
            "mean_target_depth": F.try_divide(F.col("target_depth_sum").cast("double"), F.col("target_depth_ge1").cast("double")),
            "target_coverage": F.try_divide(F.col("target_depth_ge1") * 100.0, F.col("target_size").cast("double")),
            "capture_specificity": F.try_divide(F.col("target_unique_reads") * 100.0, F.col("unique_reads").cast("double")),
            "capture_efficiency": F.try_divide(F.col("target_depth_sum") * 100.0, F.col("mapped_bases").cast("double")),
        }
    )


def region_gc(regions: DataFrame, ref: DataFrame, window: int = 200) -> DataFrame:
    """GC share of the reference around each region, widened to at least ``window`` bases."""
    size = _length()
    extend = F.when(size < window, F.floor((window - size) / 2) + 1).otherwise(F.lit(0))
    wide = regions.select("chrom", F.greatest(F.col("start") - extend, F.lit(1)).alias("start"), (F.col("end") + extend).alias("end"), "name")
    wide = wide.select("chrom", F.col("start").cast("long").alias("lo"), F.col("end").cast("long").alias("hi"), "name")
    found = stretches(wide.select("chrom", "lo", "hi").distinct(), ref_blocks(ref.select("chrom", "pos", F.upper("base").alias("base"))))
    among = lambda letters: F.length("bases") - F.length(F.translate("bases", letters, ""))
    counted = found.select("chrom", "lo", "hi", among("GC").alias("_gc"), among("ACGT").alias("_all"))
    return wide.join(counted, ["chrom", "lo", "hi"]).groupBy("name").agg(
        F.try_divide(F.sum("_gc").cast("double"), F.sum("_all").cast("double")).alias("gc")
    )


def region_stats(segments: DataFrame, regions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Covered bases, thresholds, sums, medians and means per region.

    Medians weigh each depth by the bases it spans and count uncovered bases as 0, so positions
    are never listed one by one. ``name`` identifies a region.
    """
    keys = list(keys)
    named = regions.select(F.col("chrom").alias("rc"), F.col("start").alias("rs"), F.col("end").alias("re"), "name")
    part = F.least("end", "re") - F.greatest("start", "rs") + 1
    hit = interval_join(segments, named, right_on=("rc", "rs", "re")).select(*keys, "name", "depth", "dedup", part.alias("_len"))
    base = regions.select("name", "chrom", "start", "end", _length().alias("size"))
    if keys:
        samples = segments.select(*keys).distinct().agg(F.collect_set(F.struct(*keys)).alias("_s"))
        base = base.withColumn("_k", F.lit(0)).join(samples.withColumn("_k", F.lit(0)).hint("broadcast"), "_k").withColumn(
            "_s", F.explode("_s")
        ).select("*", "_s.*").drop("_k", "_s")
    seen = hit.groupBy(*keys, "name").agg(F.sum("_len").alias("_seen"))
    rest = base.join(seen, keys + ["name"], "left").select(
        *keys, "name", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("dedup"),
        (F.col("size") - F.coalesce("_seen", F.lit(0).cast("long"))).alias("_len"),
    ).filter("_len > 0")
    on = F.col("dedup") > 0
    of = lambda c, v: F.sum(F.when(c, v).otherwise(F.lit(0)))
    stats = (
        hit.unionByName(rest)
        .groupBy(*keys, "name")
        .agg(
            of(on, F.col("_len")).alias("covered"),
            *[of(F.col("dedup") >= k, F.col("_len")).alias(f"ge{k}") for k in (4, 10, 30)],
            of(on, F.col("depth") * F.col("_len")).alias("depth_sum"),
            of(on, F.col("dedup") * F.col("_len")).alias("dedup_sum"),
            F.percentile("depth", F.lit(0.5), F.col("_len")).alias("median_depth"),
            F.percentile("dedup", F.lit(0.5), F.col("_len")).alias("median_dedup"),
        )
    )
    d = base.join(stats, keys + ["name"])
    d = d.withColumns(
        {
            "mean_depth": F.coalesce(F.try_divide(F.col("depth_sum").cast("double"), F.col("covered").cast("double")), F.lit(0.0)),
            "mean_dedup": F.coalesce(F.try_divide(F.col("dedup_sum").cast("double"), F.col("covered").cast("double")), F.lit(0.0)),
        }
    )
    auto = ~F.lower(F.regexp_replace("chrom", "^(?i)chr", "")).isin("x", "y", "m")
    whole = d.groupBy(*keys).agg(
        F.try_divide(F.sum(F.when(auto, F.col("depth_sum"))).cast("double"), F.sum(F.when(auto, F.col("size"))).cast("double")).alias("_all")
    )
    j = d.join(whole, keys) if keys else with_row(d, whole)
    return j.withColumn("normalised_depth", F.try_divide(F.try_divide(F.col("depth_sum"), F.col("size").cast("double")), F.col("_all"))).drop("_all")


def depth_histogram(segments: DataFrame, depth: str = "dedup", keys: Sequence[str] = ()) -> DataFrame:
    return segments.groupBy(*keys, F.col(depth).alias("depth")).agg(F.sum(_length()).alias("bases"))


def insert_size_histogram(reads: DataFrame, limit: int = 2000, keys: Sequence[str] = ()) -> DataFrame:
    """First-of-pair insert sizes below ``limit``, with and without duplicates."""
    size = F.abs("insert_size")
    return (
        reads.filter(F.col("is_first") & (size < limit))
        .groupBy(*keys, size.alias("insert_size"))
        .agg(F.count("*").alias("pairs"), F.count_if(~F.col("is_duplicate")).alias("unique_pairs"))
    )


def lane_depth(spans: DataFrame, regions: DataFrame, lane: str = "read_group", salt: int = 8) -> DataFrame:
    """Depth per lane at every covered position of the regions."""
    target = merge_intervals(regions, gap=1).drop("n")
    seg = depth_segments(spans, [lane, "chrom"])
    j = interval_join(seg, target, salt=salt)
    cut = j.select(lane, "chrom", F.greatest("start", "r_start").alias("start"), F.least("end", "r_end").alias("end"), "depth")
    return depth_positions(cut)


def gaps(covered: DataFrame, contigs: DataFrame) -> DataFrame:
    """Uncovered runs of each contig; a contig without coverage is one run."""
    ends = contigs.select("chrom", F.explode(F.array(F.lit(0).cast("long"), F.col("length") + 1)).alias("start"))
    spans = covered.select("chrom", "start", "end").unionByName(ends.select("chrom", "start", F.col("start").alias("end")))
    flat = merge_intervals(spans, gap=1)
    nxt = following(flat, ["chrom"], "start", {"_next": "start"})
    return nxt.filter(F.col("_next").isNotNull()).select(
        "chrom", (F.col("end") + 1).alias("start"), (F.col("_next") - 1).alias("end")
    )


def unknown_runs(ref: DataFrame) -> DataFrame:
    return runs(ref.filter(F.upper("base") == "N"), ["chrom"])


def trimmed_mean(df: DataFrame, keys: Sequence[str], value: str, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Mean of the rows between two rank shares, by counting equal values instead of sorting rows.

    Rows floor(n*low) up to floor(n*high)+1 (exclusive, 0-based) of the sorted values are used.
    """
    from pyspark.sql import Window

    keys = list(keys)
    per = df.groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*(keys or [F.lit(0)]))
    upto = w.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = per.withColumns({"_n": F.sum("_c").over(w), "_to": F.sum("_c").over(upto)})
    lo = F.floor(F.col("_n") * F.lit(low))
    hi = F.least(F.col("_n"), F.floor(F.col("_n") * F.lit(high)) + 1)
    used = F.greatest(F.lit(0).cast("long"), F.least("_to", hi) - F.greatest(F.col("_to") - F.col("_c"), lo))
    return (
        d.withColumn("_used", used)
        .groupBy(*keys)
        .agg(F.sum("_used").alias("n"), F.try_divide(F.sum(F.col("_v") * F.col("_used")), F.sum("_used").cast("double")).alias("trimmed_mean"))
    )


def _is(name: str, chrom: Column) -> Column:
    return F.lower(chrom).isin(name, f"chr{name}")


def usable_regions(stats: DataFrame, depth_low: float = 0.0, depth_high: float = 1e9) -> DataFrame:
    """Regions fit for sex prediction: depth inside the window, half covered, 10 bases, GC .1 to .9."""
    return stats.filter(
        (F.col("mean_depth") > depth_low)
        & (F.col("mean_depth") < depth_high)
        & (F.col("covered") / F.col("size") >= 0.5)
        & (F.col("size") >= 10)
        & F.col("gc").between(0.1, 0.9)
    )


def gc_weights(stats: DataFrame, span: float = 0.01) -> DataFrame:
    """Depth weight per GC bin: mean depth of all regions over the median of the autosomal bin."""
    bin_no = F.floor(F.round(F.col("gc") / span, 6))
    auto = stats.filter(~_is("x", F.col("chrom")) & ~_is("y", F.col("chrom")))
    med = auto.groupBy(bin_no.alias("gc_bin")).agg(F.median("mean_depth").alias("bin_depth"))
    mean = stats.agg(F.avg("mean_depth").alias("all_depth"))
    return (
        with_row(med, mean)
        .select("gc_bin", F.try_divide(F.col("all_depth"), F.col("bin_depth")).alias("weight"))
    )


def corrected_depth(stats: DataFrame, weights: DataFrame, span: float = 0.01) -> DataFrame:
    """Depth times the weight of its GC bin; a bin without autosomal regions keeps its depth.

    The weight table is broadcast: it has at most 1 / span rows.
    """
    bin_no = F.floor(F.round(F.col("gc") / span, 6))
    return stats.withColumn("gc_bin", bin_no).join(F.broadcast(weights), "gc_bin", "left").withColumn(
        "corrected", F.round(F.col("mean_depth") * F.coalesce("weight", F.lit(1.0)), 9)
    )


def predict_sex(stats: DataFrame, depth_low: float = 0.0, depth_high: float = 1e9, span: float = 0.01) -> DataFrame:
    """One row: ratios of X and Y depth to autosomal depth and the predicted sex.

    Fewer than 10 usable regions, no sex contig or a conflict between X and Y give ``unknown``.
    """
    use = usable_regions(stats, depth_low, depth_high)
    fixed = corrected_depth(use, gc_weights(use, span), span)
    per = trimmed_mean(fixed, ["chrom"], "corrected")
    x, y = _is("x", F.col("chrom")), _is("y", F.col("chrom"))
    auto = ~x & ~y
    out = per.agg(
        F.try_divide(F.sum(F.when(auto, F.col("trimmed_mean") * F.col("n"))), F.sum(F.when(auto, F.col("n"))).cast("double")).alias("autosome_depth"),
        F.max(F.when(x & (F.col("n") > 5), F.col("trimmed_mean"))).alias("x_depth"),
        F.max(F.when(y & (F.col("n") > 5), F.col("trimmed_mean"))).alias("y_depth"),
    )
    n = use.agg(F.count("*").alias("regions"))
    d = with_row(out, n)
    d = d.withColumns(
        {
            "x_ratio": F.try_divide("x_depth", "autosome_depth"),
            "y_ratio": F.try_divide("y_depth", "autosome_depth"),
        }
    )
    by_x = F.when(F.col("x_ratio").isNotNull(), F.when(F.col("x_ratio") > 0.75, "F").otherwise("M"))
    by_y = F.when(F.col("y_ratio").isNotNull(), F.when(F.col("y_ratio") < 0.25, "F").otherwise("M"))
    sex = (
        F.when(F.col("regions") < 10, "unknown")
        .when(by_x.isNull() & by_y.isNull(), "unknown")
        .when(by_x.isNotNull() & by_y.isNotNull() & (by_x != by_y), "unknown")
        .otherwise(F.coalesce(by_x, by_y))
    )
    return d.withColumn("sex", sex)


def smooth_gc_curve(curve: DataFrame, share: float = 0.1, iterations: int = 5) -> DataFrame:
    """LOWESS over the GC curve (gc_bin, bin_depth).

    The curve has at most 1 / span points however large the input, so one task fits it.
    """
    import numpy as np
    import pandas as pd

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("gc_bin")
        x, y = pdf["gc_bin"].to_numpy(float), pdf["bin_depth"].to_numpy(float)
        n = len(x)
        k = int(min(n, max(2, round(share * n))))
        robust, out = np.ones(n), y.copy()
        for _ in range(iterations + 1):
            for i in range(n):
                dist = np.abs(x - x[i])
                reach = np.sort(dist)[k - 1]
                w = np.where(dist <= reach, (1 - (dist / reach) ** 3) ** 3 if reach > 0 else 1.0, 0.0) * robust
                if w.sum() <= 0:
                    continue
                mx = np.average(x, weights=w)
                var = np.average((x - mx) ** 2, weights=w)
                my = np.average(y, weights=w)
                slope = np.average((x - mx) * (y - my), weights=w) / var if var > 1e-12 else 0.0
                out[i] = my + slope * (x[i] - mx)
            scale = 6 * np.median(np.abs(y - out))
            if scale <= 0:
                break
            u = np.clip((y - out) / scale, -1, 1)
            robust = (1 - u**2) ** 2
        return pdf.assign(bin_depth=out)

    return curve.groupBy(F.lit(0).alias("_k")).applyInPandas(fit, curve.schema)

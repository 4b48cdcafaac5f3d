"""Cohort merging of per-sample records with reference blocks, and joint genotyping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuswise.functions.alleles import genotype_index, remap_pl, trim_alleles
from locuswise.functions.lambdas import let, record
from locuswise.functions.stats import excess_het_p
from locuswise.operators.allele_counts import allele_count_likelihoods
from locuswise.operators.calling import THETA_SNP, af_prior
from locuswise.operators.intervals import interval_join, segments
from locuswise.operators.scan import running

NON_REF = "<NON_REF>"
SPAN_DEL = "*"
# INFO keys that are computed again after genotyping, the depth (summed) and the end (of a record, not of a site)
STALE_INFO = ("AC", "AF", "AN", "DP", "END", "MLEAC", "MLEAF")


def true_alts(alts: Column) -> Column:
    return F.filter(alts, lambda a: ~a.isin(NON_REF, SPAN_DEL))


def variant_loci(records: DataFrame) -> DataFrame:
    """Positions at which some sample has a real alternate allele."""
    return records.filter(F.size(true_alts(F.col("alts"))) > 0).select("chrom", F.col("start").alias("pos")).distinct()


def records_at(records: DataFrame, loci: DataFrame, salt: int = 1) -> DataFrame:
    """The record of each sample at each locus: the one that starts last among those that span it."""
    spots = loci.select(F.col("chrom").alias("lc"), "pos", F.col("pos").alias("pe"))
    j = interval_join(records, spots, right_on=("lc", "pos", "pe"), salt=salt)
    rest = [c for c in records.columns if c not in ("sample", "chrom")]
    picked = j.groupBy("chrom", "pos", "sample").agg(F.max_by(F.struct(*rest), F.struct("start", "end")).alias("_r"))
    return picked.select("chrom", "pos", "sample", "_r.*")


def _site_aggs() -> list[Column]:
    here = F.col("start") == F.col("pos")
    real = true_alts(F.col("alts"))
    depth = F.coalesce("dp", "min_dp", F.lit(0))
    return [
        F.max(F.when(here, F.struct(F.length("ref").alias("n"), F.col("ref").alias("ref")))).alias("_ref"),
        F.collect_set(F.when(here & (F.size(real) > 0), F.struct("ref", real.alias("alts")))).alias("_alleles"),
        F.bool_or((~here & (F.size(real) > 0)) | F.array_contains("alts", SPAN_DEL)).alias("_span"),
        F.bool_or(here & (F.size(real) > 0)).alias("_event"),
        F.sum(depth).alias("dp"),
        F.collect_set(F.when(here, F.col("id"))).alias("_ids"),
        F.count("*").alias("samples"),
    ]


def _finish_site(g: DataFrame, keep_non_ref: bool) -> DataFrame:
    ref = F.col("_ref.ref")
    longer = lambda a, r: F.concat(a, F.substr(ref, F.length(r) + 1))
    alts = F.array_sort(
        F.array_distinct(F.flatten(F.transform("_alleles", lambda x: F.transform(x["alts"], lambda a: longer(a, x["ref"])))))
    )
    tail = F.array_compact(
        F.array(
            F.when(F.col("_span") & (F.col("_event") | F.lit(keep_non_ref)), F.lit(SPAN_DEL)),
            F.when(F.lit(keep_non_ref), F.lit(NON_REF)),
        )
    )
    return g.select(
        "chrom", "pos", ref.alias("ref"), F.concat(alts, tail).alias("alts"), "dp", F.array_join(F.array_sort("_ids"), ",").alias("id"), "samples"
    )


def info_counts(at: DataFrame, info: str, *by: Column) -> DataFrame:
    """chrom, pos, ``by``, key, value, n: how often a number stands under an INFO key of the records that start at the locus."""
    here = at.filter(F.col("start") == F.col("pos"))
    d = here.select("chrom", "pos", *by, F.explode(info).alias("key", "text")).filter(~F.col("key").isin(*STALE_INFO))
    value = F.col("text").try_cast("double")
    d = d.withColumn("value", value).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return d.groupBy(*[c for c in d.columns if c != "text"]).agg(F.count("*").alias("n"))


def info_medians(counts: DataFrame) -> DataFrame:
    """chrom, pos, info: the upper median of each INFO key, from ``info_counts`` of the cohort or of its batches.

    Counts of equal values are summed before a key of a site meets in one task; there the distinct values pass a window, which
    spills. The map of a site has one entry per INFO key of the header.
    """
    site = ["chrom", "pos", "key"]
    c = counts.groupBy(*site, "value").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*site)
    upto = F.sum("n").over(w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    c = c.select(*site, "value", upto.alias("_upto"), F.sum("n").over(w).alias("_all")).filter(F.col("_upto") > F.floor(F.col("_all") / 2))
    m = c.groupBy(*site).agg(F.min("value").alias("value"))
    return m.groupBy("chrom", "pos").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("info"))


def merge_sites(at: DataFrame, keep_non_ref: bool = True, info: str | None = None) -> DataFrame:
    """One row per locus: longest reference allele, union of alternate alleles padded to it, summed depth, ids.

    Alleles are collected as sets, whose size follows the distinct alleles of a site and not the cohort. ``info`` names a column
    of ``map<string,string>``: its numbers come back as a map of medians (null where no record that starts at the locus has one).
    """
    sites = _finish_site(at.groupBy("chrom", "pos").agg(*_site_aggs()), keep_non_ref)
    return sites if info is None else sites.join(info_medians(info_counts(at, info)), ["chrom", "pos"], "left")


def merge_sites_two_level(at: DataFrame, batches: int, keep_non_ref: bool = True, info: str | None = None) -> DataFrame:
    """The same rows by merging batches of samples first and batch results second."""
    batch = F.pmod(F.xxhash64("sample"), F.lit(batches)).alias("_batch")
    part = at.groupBy("chrom", "pos", batch).agg(*_site_aggs())
    g = part.groupBy("chrom", "pos").agg(
        F.max("_ref").alias("_ref"), F.array_distinct(F.flatten(F.collect_list("_alleles"))).alias("_alleles"), F.bool_or("_span").alias("_span"),
        F.bool_or("_event").alias("_event"), F.sum("dp").alias("dp"), F.array_distinct(F.flatten(F.collect_list("_ids"))).alias("_ids"), F.sum("samples").alias("samples"),
    )
    sites = _finish_site(g, keep_non_ref)
    return sites if info is None else sites.join(info_medians(info_counts(at, info, batch)), ["chrom", "pos"], "left")


def merge_genotypes(at: DataFrame, sites: DataFrame) -> DataFrame:
    """Genotype rows with PLs in the merged allele order.

    Alleles the sample does not list take its NON_REF likelihoods. A record that does not start
    here counts its own alternate alleles as spanning deletion.
    """
    s = sites.select("chrom", "pos", F.col("ref").alias("_mref"), F.col("alts").alias("_malts"))
    j = at.join(s, ["chrom", "pos"])
    here = F.col("start") == F.col("pos")
    own = F.transform(
        "alts",
        lambda a: F.when(a.isin(NON_REF, SPAN_DEL), a)
        .when(here, F.concat(a, F.substr(F.col("_mref"), F.length("ref") + 1)))
        .otherwise(F.lit(SPAN_DEL)),
    )
    j = j.withColumns({"_old": F.concat(F.array("_mref"), own), "_new": F.concat(F.array("_mref"), F.col("_malts"))})
    return j.select(
        "chrom", "pos", "sample", F.col("_mref").alias("ref"), F.col("_malts").alias("alts"), remap_pl(F.col("pl"), F.col("_old"), F.col("_new")).alias("pl"),
        F.coalesce("dp", "min_dp").alias("dp"), "min_dp", here.alias("starts_here"),
    )


def merge_ref_blocks(blocks: DataFrame, salt: int = 1) -> DataFrame:
    """Reference blocks of a cohort cut at every boundary: samples, depth and smallest GQ band per piece."""
    cut = segments(blocks.select("chrom", "start", "end"))
    j = interval_join(cut, blocks.select(F.col("chrom").alias("bc"), F.col("start").alias("bs"), F.col("end").alias("be"), "sample", "min_dp", "gq_band"), right_on=("bc", "bs", "be"), salt=salt)
    return j.groupBy("chrom", "start", "end").agg(
        F.count_distinct("sample").alias("samples"), F.sum("min_dp").alias("dp"), F.min("gq_band").alias("gq_band")
    ).withColumn("gt", F.lit("./."))


def joint_genotype(genotypes: DataFrame, theta: float = THETA_SNP, call: float = 30.0, keep_non_variants: bool = False) -> DataFrame:
    """Cohort calls from merged genotypes: one row per site with quality, alleles, AC, AN, DP and excess heterozygosity.

    Every real alternate allele is tested against the reference with the exact allele-count model
    on its three likelihoods; alleles below ``call`` are dropped and genotypes picked among the
    rest. Samples of one site are gathered in one array, bounded by the size of the cohort.
    """
    g = genotypes.groupBy("chrom", "pos", "ref", "alts").agg(
        F.sort_array(F.collect_list(F.struct("sample", "pl", "dp"))).alias("g"), F.sum("dp").alias("dp")
    ).filter(F.col("dp") > 0)
    real = F.filter(F.transform("alts", lambda a, i: record(a=a, i=i + 1)), lambda x: ~x["a"].isin(NON_REF, SPAN_DEL))
    per = g.select("*", F.explode(real).alias("_x"))
    i = F.col("_x.i")
    three = F.transform(
        F.filter("g", lambda s: s["pl"].isNotNull()),
        lambda s: F.struct(
            (-F.get(s["pl"], F.lit(0)) / 10.0).alias("rr"),
            (-F.get(s["pl"], genotype_index(F.lit(0), i)) / 10.0).alias("ra"),
            (-F.get(s["pl"], genotype_index(i, i)) / 10.0).alias("aa"),
        ),
    )
    per = per.withColumn("_l", allele_count_likelihoods(three))
    post = let(F.zip_with("_l", af_prior(theta, F.size("_l") - 1), lambda x, p: x * p), lambda v: F.get(v, F.lit(0)) / F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x))
    per = per.withColumn("_q", -10.0 * F.log10(F.greatest(post, F.lit(1e-300))))
    per = per.withColumn("_mle", F.array_position("_l", F.array_max("_l")) - 1)
    good = per.filter((F.col("_q") >= call) & (F.col("_mle") > 0))
    site = good.groupBy("chrom", "pos", "ref").agg(
        F.sort_array(F.collect_list("_x")).alias("_kept"), F.max("_q").alias("qual"), F.first("g").alias("g"), F.first("dp").alias("dp")
    )
    # genotype = the best PL among the kept alleles
    keep = F.concat(F.array(F.struct(F.col("ref").alias("a"), F.lit(0).alias("i"))), F.transform("_kept", lambda x: record(a=x["a"], i=x["i"])))
    site = site.withColumn("_keep", keep)
    pairs = F.flatten(
        F.transform(
            "_keep", lambda x, p: F.transform(F.slice(F.col("_keep"), F.lit(1), p + 1), lambda y, r: record(lo=y["i"], hi=x["i"], nlo=r, nhi=p))
        )
    )
    site = site.withColumn("_pairs", pairs)
    calls = F.transform(
        F.filter("g", lambda s: s["pl"].isNotNull()),
        lambda s: F.array_min(F.transform("_pairs", lambda x: F.struct(F.get(s["pl"], genotype_index(x["lo"], x["hi"])).alias("pl"), x["nlo"].alias("a"), x["nhi"].alias("b")))),
    )
    site = site.withColumn("_calls", calls)
    count = lambda k: F.aggregate("_calls", F.lit(0), lambda acc, c: acc + (c["a"] == k).cast("int") + (c["b"] == k).cast("int"))
    of = lambda f: F.size(F.filter("_calls", f))
    het, hr = of(lambda c: c["a"] != c["b"]), of(lambda c: (c["a"] == 0) & (c["b"] == 0))
    out = site.select(
        "chrom", "pos", "ref", F.transform("_kept", lambda x: x["a"]).alias("alts"), "qual", "dp",
        F.transform(F.sequence(F.lit(1), F.size("_kept")), count).alias("ac"), (2 * F.size("_calls")).alias("an"),
        (-10.0 * F.log10(F.greatest(excess_het_p(het, hr, F.size("_calls") - het - hr), F.lit(1e-320)))).alias("excess_het"),
        F.try_divide("qual", F.col("dp").cast("double")).alias("qd"),
    )
    return out if keep_non_variants else out.filter(F.aggregate("ac", F.lit(0), lambda a, x: a + x) > 0)


def trim_sites(sites: DataFrame) -> DataFrame:
    """Biallelic sites with shared bases removed; others unchanged."""
    one = trim_alleles(sites.filter(F.size("alts") == 1).withColumn("alt", F.get("alts", F.lit(0))))
    return one.withColumn("alts", F.array("alt")).drop("alt").unionByName(sites.filter(F.size("alts") != 1))


def cleanup_genotypes(genotypes: DataFrame, as_reference: bool = False) -> DataFrame:
    """Fields after regenotyping: DP from MIN_DP, AD from depth when missing, 1|1 phasing for hom-var.

    Needs gt, gq, dp, min_dp, ad, pgt, pl and alts. ``as_reference`` turns the row into a reference
    call: RGQ takes GQ, depth and GQ above zero give 0/0, and PLs go.
    """
    depth = F.coalesce("min_dp", "dp", F.lit(0))
    hom_var = F.forall("gt", lambda a: a > 0) & (F.size(F.array_distinct("gt")) == 1)
    d = genotypes.withColumns(
        {
            "dp": F.coalesce("min_dp", "dp"),
            "pgt": F.when(hom_var & F.col("pgt").isNotNull(), F.lit("1|1")).otherwise(F.col("pgt")),
            "ad": F.coalesce("ad", F.concat(F.array(depth), F.transform("alts", lambda _a: F.lit(0)))),
        }
    )
    if as_reference:
        sure = (depth > 0) & (F.coalesce("gq", F.lit(0)) > 0)
        d = d.withColumns({"rgq": F.col("gq"), "gt": F.when(sure, F.array(F.lit(0), F.lit(0))).otherwise(F.col("gt"))}).withColumns(
            {"gq": F.lit(None).cast("int"), "pl": F.lit(None).cast("array<int>")}
        )
    return d.drop("min_dp", "sb")


def balanced_ranges(df: DataFrame, n: int, keys: Sequence[str] = (), pos: str = "pos", tile: float = 4096) -> DataFrame:
    """Cut the axis into ``n`` ranges with about equal row counts: range number, first and last position, rows."""
    per = df.groupBy(*keys, pos).agg(F.count("*").alias("_n"))
    c = running(per, keys, pos, {"_upto": ("sum", F.col("_n"))}, tile=tile)
    total = per.groupBy(*keys).agg(F.sum("_n").alias("_all")).withColumn("_k", F.lit(0))
    c = c.withColumn("_k", F.lit(0)).join(total.hint("broadcast") if not keys else total, [*keys, "_k"])
    r = F.floor((F.col("_upto") - 1) * n / F.col("_all")).cast("int")
    return c.groupBy(*keys, r.alias("range")).agg(F.min(pos).alias("first"), F.max(pos).alias("last"), F.sum("_n").alias("rows"))

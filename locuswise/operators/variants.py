"""Variant and genotype operators: statistics, filters, ids, concordance, table forms.

Genotypes are long: one row per (chrom, pos, ref, alts, sample) with ``gt`` an array of allele
numbers, 0 the reference allele and -1 a no-call.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswise.functions.alleles import in_mode, is_symbolic, is_transition, site_type, variant_type
from locuswise.operators.scan import scan


def is_no_call(gt: Column) -> Column:
    return F.exists(gt, lambda a: a < 0)


def is_hom_ref(gt: Column) -> Column:
    return F.forall(gt, lambda a: a == 0)


def is_het(gt: Column) -> Column:
    return ~is_no_call(gt) & (F.size(F.array_distinct(gt)) > 1)


def called_alts(gt: Column, alts: Column) -> Column:
    """Alternate alleles of a genotype, in order, spanning-deletion alleles left out."""
    named = F.transform(F.filter(gt, lambda a: a > 0), lambda a: F.element_at(alts, a))
    return F.filter(named, lambda x: x != "*")


def norm_contig(chrom: Column) -> Column:
    return F.regexp_replace(chrom, "^chr", "")


def _times(kinds: str, name: str) -> Column:
    return F.size(F.filter(kinds, lambda t: t == name))


TYPES = ("SNP", "MNP", "MIXED", "INS", "DEL", "InDel", "BND")


def variant_stats(genotypes: DataFrame) -> DataFrame:
    """Counts per sample and for sample ``total``.

    Needs sample, ref, alts, gt, is_filtered and id. Transitions are counted per called allele, so
    a homozygous SNP counts twice; a MIXED genotype also counts the type of each of its alleles.
    """
    called = called_alts(F.col("gt"), F.col("alts"))
    d = genotypes.withColumn("_a", called).withColumn("_t", F.transform("_a", lambda a: variant_type(F.col("ref"), a)))
    kind = F.when(F.size(F.array_distinct("_t")) > 1, F.lit("MIXED")).otherwise(F.get("_t", F.lit(0)))
    passed = ~F.col("is_filtered")
    var = passed & ~is_no_call(F.col("gt")) & ~is_hom_ref(F.col("gt"))
    ti = F.size(F.filter("_a", lambda a: is_transition(F.col("ref"), a)))
    # everything needed per row is reduced to scalars before the shuffle
    d = d.select(
        "sample",
        passed.alias("passed"),
        (passed & is_no_call(F.col("gt"))).alias("nocall"),
        (passed & is_hom_ref(F.col("gt"))).alias("homref"),
        var.alias("var"),
        is_het(F.col("gt")).alias("het"),
        F.col("id").isNotNull().alias("known"),
        kind.alias("kind"),
        F.when(kind == "SNP", ti).otherwise(0).alias("ti"),
        F.when(kind == "SNP", F.size("_a") - ti).otherwise(0).alias("tv"),
        *[
            (F.when(kind == "MIXED", _times("_t", n)).otherwise(0) + (kind == n).cast("int")).alias(f"n_{n}")
            for n in TYPES
        ],
    )
    v, het = F.col("var"), F.col("het")
    total = lambda c, v: F.coalesce(F.sum(F.when(c, v)), F.lit(0).cast("long"))
    aggs = [
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count_if("nocall").alias("no_call"),
        F.count_if("homref").alias("hom_ref"),
        F.count_if(v & het).alias("het"),
        F.count_if(v & ~het).alias("hom"),
        F.count_if(v & F.col("known")).alias("known"),
        total(v, F.col("ti")).alias("ti"),
        total(v, F.col("tv")).alias("tv"),
        total(v & F.col("known"), F.col("ti")).alias("known_ti"),
        total(v & F.col("known"), F.col("tv")).alias("known_tv"),
        total(v & ~F.col("known"), F.col("ti")).alias("novel_ti"),
        total(v & ~F.col("known"), F.col("tv")).alias("novel_tv"),
    ]
    for n in TYPES:
        aggs += [total(v & het, F.col(f"n_{n}")).alias(f"het_{n.lower()}"), total(v & ~het, F.col(f"n_{n}")).alias(f"hom_{n.lower()}")]
    per = d.groupBy("sample").agg(*aggs)
    names = [c for c in per.columns if c != "sample"]
    both = per.select(F.explode(F.array(F.col("sample"), F.lit("total"))).alias("sample"), *names)
    return both.groupBy("sample").agg(*[F.sum(c).alias(c) for c in names])


def variant_stats_ratios(stats: DataFrame) -> DataFrame:
    div = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    c = F.col
    kind = lambda n: c(f"het_{n}") + c(f"hom_{n}")
    return stats.select(
        "sample",
        div(c("ti"), c("tv")).alias("ti_tv"),
        div(c("known_ti"), c("known_tv")).alias("known_ti_tv"),
        div(c("novel_ti"), c("novel_tv")).alias("novel_ti_tv"),
        div(c("het"), c("hom")).alias("het_hom"),
        *[div(c(f"het_{n}"), c(f"hom_{n}")).alias(f"{n}_het_hom") for n in ("snp", "mnp", "ins", "del")],
        div(kind("ins"), kind("del")).alias("ins_del"),
        div(kind("ins") + kind("del"), kind("snp") + kind("mnp")).alias("indel_snp_mnp"),
        div(c("known"), c("passed") - c("no_call") - c("hom_ref")).alias("known_share"),
    )


def allele_length_histogram(genotypes: DataFrame) -> DataFrame:
    """Longer of reference and alternate length per called allele, by sample and type."""
    d = genotypes.filter(~F.col("is_filtered") & ~is_no_call(F.col("gt")))
    d = d.select("sample", "ref", F.explode(called_alts(F.col("gt"), F.col("alts"))).alias("alt"))
    return d.groupBy(
        "sample",
        variant_type(F.col("ref"), F.col("alt")).alias("type"),
        F.greatest(F.length("ref"), F.length("alt")).alias("length"),
    ).agg(F.count("*").alias("n"))


def _site_flags(sites: DataFrame) -> dict[str, Column]:
    ref, alts = F.col("ref"), F.col("alts")
    plain = F.filter(alts, lambda a: ~is_symbolic(a))
    return {
        "snp": F.exists(plain, lambda a: (F.length(a) == F.length(ref)) & (F.length(ref) == 1)),
        "mnp": F.exists(plain, lambda a: (F.length(a) == F.length(ref)) & (F.length(ref) > 1)),
        "insertion": F.exists(plain, lambda a: F.length(a) > F.length(ref)),
        "deletion": F.exists(plain, lambda a: F.length(a) < F.length(ref)),
    }


def site_stats(sites: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Site counts by class; transitions and transversions over biallelic SNP sites."""
    f = _site_flags(sites)
    ti = is_transition(F.col("ref"), F.get("alts", F.lit(0)))
    one = f["snp"] & (F.size("alts") == 1)
    return sites.groupBy(*keys).agg(
        F.count_if(F.size("alts") > 0).alias("variants"),
        *[F.count_if(c).alias(f"{n}s") for n, c in f.items()],
        F.count_if(f["insertion"] | f["deletion"]).alias("indels"),
        F.count_if(one & ti).alias("transitions"),
        F.count_if(one & ~ti).alias("transversions"),
    )


def callset_summary(sites: DataFrame) -> DataFrame:
    """SNP and indel counts, Ti/Tv and the number of contigs that have a SNP / an indel."""
    kind = site_type(F.col("ref"), F.col("alts"))
    d = sites.select("chrom", kind.alias("kind"), (F.size("alts") == 1).alias("one"), is_transition(F.col("ref"), F.get("alts", F.lit(0))).alias("ti"))
    snp, indel = F.col("kind") == "SNP", F.col("kind").isin("INS", "DEL", "InDel")
    per = d.groupBy("chrom").agg(
        F.count_if(snp).alias("snps"), F.count_if(indel).alias("indels"),
        F.count_if(snp & F.col("one") & F.col("ti")).alias("ti"), F.count_if(snp & F.col("one") & ~F.col("ti")).alias("tv"),
    )
    return per.agg(
        F.sum("snps").alias("snps"),
        F.sum("indels").alias("indels"),
        F.try_divide(F.sum("ti").cast("double"), F.sum("tv").cast("double")).alias("ti_tv"),
        F.count_if(F.col("snps") > 0).alias("snp_contigs"),
        F.count_if(F.col("indels") > 0).alias("indel_contigs"),
    )


def hard_filter(sites: DataFrame, name: str, snp_expr: str | None = None, indel_expr: str | None = None) -> DataFrame:
    """Add ``<name>snp`` / ``<name>indel`` to ``filters`` where the class expression holds.

    An expression over a missing value does not fail the site; no filter at all gives PASS.
    """
    kind = site_type(F.col("ref"), F.col("alts"))
    hit = lambda e: F.coalesce(F.expr(e), F.lit(False)) if e else F.lit(False)
    added = F.array_compact(
        F.array(
            F.when((kind == "SNP") & hit(snp_expr), F.lit(f"{name}snp")),
            F.when(kind.isin("INS", "DEL", "InDel") & hit(indel_expr), F.lit(f"{name}indel")),
        )
    )
    old = F.filter(F.coalesce("filters", F.array().cast("array<string>")), lambda x: (x != "PASS") & (x != "."))
    both = F.array_union(old, added)
    return sites.withColumn("filters", F.when(F.size(both) == 0, F.array(F.lit("PASS"))).otherwise(both))


def eval_filter(sites: DataFrame, mode: str = "BOTH") -> DataFrame:
    """Sites that enter a call-set comparison: variant, unfiltered, not symbolic, of the chosen class."""
    kind = site_type(F.col("ref"), F.col("alts"))
    ok = (F.size("alts") > 0) & ~F.col("is_filtered") & ~F.exists("alts", is_symbolic)
    if mode == "SNP":
        ok = ok & (kind == "SNP")
    elif mode == "INDEL":
        ok = ok & kind.isin("INS", "DEL", "InDel")
    return sites.filter(ok)


def annotate_ids(sites: DataFrame, known: DataFrame) -> DataFrame:
    """``id`` of the first known record (by ``order``) with the same span and a shared alternate allele.

    The known side is unfolded by allele and reduced to its first id per (span, allele), so the
    join is an equi join with at most one match per allele.
    """
    first = known.select("chrom", "pos", "end", F.explode("alts").alias("_alt"), "order", F.col("id").alias("_id")).groupBy(
        "chrom", "pos", "end", "_alt"
    ).agg(F.min(F.struct("order", "_id")).alias("_k"))
    own = [c for c in sites.columns if c != "id"]
    key = ["chrom", "pos", "end", "ref", "alts"]
    found = (
        sites.select(*key, F.explode("alts").alias("_alt"))
        .join(first, ["chrom", "pos", "end", "_alt"])
        .groupBy(*key)
        .agg(F.min("_k").alias("_k"))
    )
    old = F.col("id") if "id" in sites.columns else F.lit(None).cast("string")
    return sites.join(found, key, "left").withColumn("id", F.coalesce(F.col("_k._id"), old)).select(*own, "id")


def split_multiallelic(rows: DataFrame, per_alt: Sequence[str], alts: str = "alts") -> DataFrame:
    """One row per alternate allele. A comma list with one value per allele is split, others repeat."""
    d = rows.select("*", F.posexplode(alts).alias("_i", "alt"))
    n = F.size(alts)
    pick = lambda c: F.when(
        (F.size(F.split(F.col(c), ",")) == n) & F.col(c).contains(","), F.get(F.split(F.col(c), ","), F.col("_i"))
    ).otherwise(F.col(c))
    return d.withColumns({c: pick(c) for c in per_alt}).drop("_i", alts)


def rename_samples(df: DataFrame, mapping: DataFrame, strict: bool = True) -> DataFrame:
    """Replace ``sample`` by the mapped name (mapping: sample, new_name), cleaned of odd characters.

    A sample without a mapping is an error when strict.
    """
    j = df.join(mapping.select("sample", F.regexp_replace("new_name", r"[^A-Za-z0-9_.-]", "_").alias("_new")), "sample", "left")
    missing = F.raise_error(F.concat(F.lit("no new name for sample "), F.col("sample"))).cast("string")
    new = F.coalesce(F.col("_new"), missing if strict else F.col("sample"))
    return j.withColumn("sample", new).drop("_new")


def _alt_set(gt: str, alts: str) -> Column:
    return F.array_sort(F.array_distinct(called_alts(F.col(gt), F.col(alts))))


def compare_calls(test: DataFrame, truth: DataFrame) -> DataFrame:
    """Full outer join of two call sets on (contig, start, end, first alt, sample).

    Only samples in both sets are compared. ``test_alts`` / ``truth_alts`` are the sorted sets of
    called non-reference alleles, null where the call set has no variant genotype there.
    """
    both = common_samples(test, truth)

    def side(d, name):
        alts = _alt_set("gt", "alts")
        called = ~is_no_call(F.col("gt")) & (F.size(alts) > 0)
        return d.join(both, "sample", "left_semi").select(
            norm_contig(F.col("chrom")).alias("chrom"), "pos", (F.col("pos") + F.length("ref") - 1).alias("end"),
            F.get("alts", F.lit(0)).alias("alt"), "sample", F.when(called, alts).alias(f"{name}_alts"),
        )

    return side(test, "test").join(side(truth, "truth"), ["chrom", "pos", "end", "alt", "sample"], "full")


def common_samples(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("sample").intersect(b.select("sample"))


def concordance_counts(test: DataFrame, truth: DataFrame) -> DataFrame:
    """test, truth and matched variant genotypes per sample, for ``total``, and site counts as ``REF``."""
    c = compare_calls(test, truth)
    t, b = F.col("test_alts").isNotNull(), F.col("truth_alts").isNotNull()
    per = c.groupBy("sample").agg(
        F.count_if(t).alias("test"), F.count_if(b).alias("truth"), F.count_if(F.coalesce(F.col("test_alts") == F.col("truth_alts"), F.lit(False))).alias("matched")
    )
    names = ["test", "truth", "matched"]
    per = per.select(F.explode(F.array(F.col("sample"), F.lit("total"))).alias("sample"), *names).groupBy("sample").agg(
        *[F.sum(x).alias(x) for x in names]
    )

    def sites(d, name):
        return d.select(
            norm_contig(F.col("chrom")).alias("chrom"), "pos", (F.col("pos") + F.length("ref") - 1).alias("end"), F.get("alts", F.lit(0)).alias("alt"),
            F.concat_ws(",", F.col("ref"), F.array_sort("alts")).alias(name),
        ).distinct()

    s = sites(test, "x").join(sites(truth, "y"), ["chrom", "pos", "end", "alt"], "full").agg(
        F.lit("REF").alias("sample"), F.count("x").alias("test"), F.count("y").alias("truth"), F.count_if(F.col("x") == F.col("y")).alias("matched")
    )
    return per.unionByName(s)


def concordance_report(counts: DataFrame) -> DataFrame:
    """Percentages with two decimals: concordance, precision, sensitivity, F-measure."""
    pct = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    d = counts.withColumn("total", F.col("test") + F.col("truth") - F.col("matched"))
    p, s = pct(F.col("matched"), F.col("test")), pct(F.col("matched"), F.col("truth"))
    return d.select(
        "sample", "total", "test", "truth", "matched",
        F.round(pct(F.col("matched"), F.col("total")) * 100, 2).alias("concordance"),
        F.round(p * 100, 2).alias("precision"),
        F.round(s * 100, 2).alias("sensitivity"),
        F.round(F.try_divide(2 * p * s, p + s) * 100, 2).alias("f_measure"),
    )


def diff_calls(test: DataFrame, truth: DataFrame) -> DataFrame:
    """(sample, chrom, pos) where one side lacks the variant or the genotypes differ."""
    c = compare_calls(test, truth)
    t, b = F.col("test_alts"), F.col("truth_alts")
    differs = (t.isNotNull() | b.isNotNull()) & ~t.eqNullSafe(b)
    return c.filter(differs).select("sample", "chrom", "pos", "end", "alt")


def variant_warehouse(genotypes: DataFrame) -> DataFrame:
    """One row per non-hom-ref (site, sample), keyed ``chrom-pos-sample``.

    ALT lists the genotype's alleles in order of first use, GT packs their new numbers in four bits
    each, QUAL has two decimals with ``.00`` removed.
    """
    gt = F.col("gt")
    shown = F.transform(gt, lambda a: F.when(a < 0, F.lit(".")).when(a == 0, F.lit("")).otherwise(F.get(F.col("alts"), a - 1)))
    d = genotypes.filter(F.size("alts") > 0).withColumn("_shown", shown)
    d = d.withColumn("_alts", F.array_distinct(F.filter("_shown", lambda x: x != "")))
    packed = F.aggregate(
        F.transform("_shown", lambda x: F.when(x == "", 0).otherwise(F.array_position("_alts", x)).cast("int")),
        F.lit(0),
        lambda acc, i: F.shiftleft(acc, 4).bitwiseOR(i.bitwiseAND(15)),
    )
    return d.filter(F.size("_alts") > 0).select(
        F.concat_ws("-", "chrom", F.col("pos").cast("string"), "sample").alias("row_key"),
        "ref",
        F.array_join("_alts", ",").alias("alt"),
        F.regexp_replace(F.format_string("%.2f", "qual"), r"\.00$", "").alias("qual"),
        packed.alias("gt"),
        F.array_join(F.transform("ad", lambda x: x.cast("string")), ",").alias("ad"),
        "dp",
    )


def info_keys(sites: DataFrame) -> list[str]:
    """Sorted INFO keys in use; the result is as large as a header, not as the data."""
    rows = sites.select(F.explode(F.map_keys("info")).alias("k")).distinct().agg(F.sort_array(F.collect_set("k")).alias("k"))
    return rows.first()["k"]


def flatten_info(sites: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per alternate allele, every INFO key a column, ``.`` where it is missing."""
    keys = list(keys) if keys is not None else info_keys(sites)
    return sites.select(
        norm_contig(F.col("chrom")).alias("chrom"), "pos", "ref", F.explode("alts").alias("alt"),
        *[F.coalesce(F.try_element_at("info", F.lit(k)), F.lit(".")).alias(k) for k in keys],
    )


def mendelian_violations(genotypes: DataFrame, trios: DataFrame, min_gq: int = 0) -> DataFrame:
    """Per family: complete sites, and those whose child alleles the parents cannot give.

    With one parent uncalled only opposite homozygotes of the other parent and the child count.

    ``trios`` has family, father, mother, child. Roles are joined to the genotypes and the three
    rows of a site meet in one aggregate with bounded state.
    """
    roles = trios.select("family", F.explode(F.create_map(F.lit("f"), "father", F.lit("m"), "mother", F.lit("c"), "child")).alias("role", "sample"))
    good = genotypes.filter(F.col("gq") >= min_gq)
    slots = good.join(roles, "sample").groupBy("family", "chrom", "pos").agg(
        *[F.first(F.when(F.col("role") == r, F.col("gt")), ignorenulls=True).alias(r) for r in "fmc"]
    )
    f, m, c = F.col("f"), F.col("m"), F.col("c")
    one, two = F.get(c, F.lit(0)), F.get(c, F.lit(1))
    fits = (F.array_contains(m, one) & F.array_contains(f, two)) | (F.array_contains(m, two) & F.array_contains(f, one))
    hom_var = lambda g: F.forall(g, lambda a: a > 0) & ~is_het(g)
    opposed = lambda p: (is_hom_ref(p) & hom_var(c)) | (hom_var(p) & is_hom_ref(c))
    violated = (
        F.when(is_no_call(c), F.lit(False)).when(is_no_call(m), opposed(f)).when(is_no_call(f), opposed(m)).otherwise(~fits)
    )
    return slots.filter("f IS NOT NULL AND m IS NOT NULL AND c IS NOT NULL").groupBy("family").agg(
        F.count("*").alias("sites"), F.count_if(violated).alias("violations")
    )


def near_variants(variants: DataFrame, reach: int = 5, keys: Sequence[str] = ("sample", "chrom")) -> DataFrame:
    """Adds ``has_near``: another variant of the sample starts within ``reach`` after this end, or ends within it before this start."""
    keys = list(keys)
    spots = variants.groupBy(*keys, "pos").agg(F.max("end").alias("end"), F.count("*").alias("_n"))
    s = scan(
        spots, keys, "pos",
        {"_before": ("max", F.col("end"), False, False), "_after": ("min", F.col("pos"), True, False)},
    )
    near = (F.col("_n") > 1) | F.coalesce(F.col("_after") - F.col("end") <= reach, F.lit(False)) | F.coalesce(
        F.col("pos") - F.col("_before") <= reach, F.lit(False)
    )
    return variants.join(s.select(*keys, "pos", near.alias("has_near")), keys + ["pos"])


def merge_samples(*tables: DataFrame) -> DataFrame:
    """Sample names of many inputs with dense numbers in name order and the first source of each."""
    names = tables[0].select("sample", "source")
    for t in tables[1:]:
        names = names.unionByName(t.select("sample", "source"))
    one = names.groupBy("sample").agg(F.min("source").alias("source"), F.count_distinct("source").alias("sources"))
    from pyspark.sql import Window

    # a cohort header: one row per sample
    return one.withColumn("idx", F.row_number().over(Window.orderBy("sample")) - 1)


def union_sources(**tables: DataFrame) -> DataFrame:
    """Union by name with the argument name as ``source``."""
    out = None
    for name, t in tables.items():
        t = t.withColumn("source", F.lit(name))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def distinct_positions(*tables: DataFrame) -> DataFrame:
    out = tables[0].select("chrom", "pos")
    for t in tables[1:]:
        out = out.union(t.select("chrom", "pos"))
    return out.distinct()


def in_class(sites: DataFrame, mode: str) -> DataFrame:
    return sites.filter(F.exists("alts", lambda a: in_mode(F.col("ref"), a, mode)))

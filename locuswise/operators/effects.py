"""Functional effects of variants and database annotation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuswise.functions.codons import amino_acid, is_start, is_stop
from locuswise.functions.lambdas import record
from locuswise.functions.sequence import complement, reverse_complement
from locuswise.operators.intervals import interval_join
from locuswise.operators.scan import with_row

# Effect types from the most to the least severe.
EFFECTS = (
    "CHROMOSOME_LARGE_DELETION", "CHROMOSOME_LARGE_INVERSION", "CHROMOSOME_LARGE_DUPLICATION", "GENE_REARRANGEMENT", "GENE_DELETED",
    "TRANSCRIPT_DELETED", "EXON_DELETED", "EXON_DELETED_PARTIAL", "GENE_FUSION", "GENE_FUSION_REVERESE", "GENE_FUSION_HALF", "FRAME_SHIFT",
    "STOP_GAINED", "STOP_LOST", "START_LOST", "SPLICE_SITE_ACCEPTOR", "SPLICE_SITE_DONOR", "RARE_AMINO_ACID", "EXON_DUPLICATION",
    "EXON_DUPLICATION_PARTIAL", "EXON_INVERSION", "EXON_INVERSION_PARTIAL", "PROTEIN_PROTEIN_INTERACTION_LOCUS",
    "PROTEIN_STRUCTURAL_INTERACTION_LOCUS", "NON_SYNONYMOUS_CODING", "NON_SYNONYMOUS_STOP", "NON_SYNONYMOUS_START", "GENE_DUPLICATION",
    "TRANSCRIPT_DUPLICATION", "UTR_5_DELETED", "UTR_3_DELETED", "SPLICE_SITE_BRANCH_U12", "SPLICE_SITE_REGION", "SPLICE_SITE_BRANCH",
    "SYNONYMOUS_CODING", "SYNONYMOUS_START", "SYNONYMOUS_STOP", "GENE_INVERSION", "TRANSCRIPT_INVERSION", "CODON_CHANGE", "CODON_INSERTION",
    "CODON_CHANGE_PLUS_CODON_INSERTION", "CODON_DELETION", "CODON_CHANGE_PLUS_CODON_DELETION", "UTR_5_PRIME", "UTR_3_PRIME", "START_GAINED",
    "MOTIF", "MOTIF_DELETED", "REGULATION", "MICRO_RNA", "FEATURE_FUSION", "UPSTREAM", "DOWNSTREAM", "NEXT_PROT", "INTRON_CONSERVED",
    "INTRON", "INTRAGENIC",
    "INTERGENIC_CONSERVED", "INTERGENIC", "CDS", "EXON", "TRANSCRIPT", "GENE", "SEQUENCE", "CHROMOSOME_ELONGATION", "CUSTOM", "CHROMOSOME",
    "GENOME", "NONE",
)

# Impact classes; effects not named here are MODIFIER.
HIGH = (
    "CHROMOSOME_LARGE_DELETION", "EXON_DELETED", "EXON_DELETED_PARTIAL", "EXON_DUPLICATION", "EXON_DUPLICATION_PARTIAL", "EXON_INVERSION",
    "EXON_INVERSION_PARTIAL", "FRAME_SHIFT", "GENE_DELETED", "GENE_FUSION", "GENE_FUSION_REVERESE", "GENE_FUSION_HALF",
    "GENE_REARRANGEMENT",
    "PROTEIN_PROTEIN_INTERACTION_LOCUS", "PROTEIN_STRUCTURAL_INTERACTION_LOCUS", "RARE_AMINO_ACID", "SPLICE_SITE_ACCEPTOR",
    "SPLICE_SITE_DONOR", "START_LOST", "STOP_GAINED", "STOP_LOST", "TRANSCRIPT_DELETED",
)
MODERATE = (
    "CHROMOSOME_LARGE_INVERSION", "CODON_CHANGE_PLUS_CODON_DELETION", "CODON_CHANGE_PLUS_CODON_INSERTION", "CODON_DELETION",
    "CODON_INSERTION", "GENE_DUPLICATION", "GENE_INVERSION", "NON_SYNONYMOUS_CODING", "SPLICE_SITE_BRANCH_U12", "TRANSCRIPT_DUPLICATION",
    "TRANSCRIPT_INVERSION", "UTR_3_DELETED", "UTR_5_DELETED",
)
LOW = (
    "CHROMOSOME_LARGE_DUPLICATION", "CODON_CHANGE", "FEATURE_FUSION", "NON_SYNONYMOUS_START", "NON_SYNONYMOUS_STOP", "SPLICE_SITE_REGION",
    "SPLICE_SITE_BRANCH", "START_GAINED", "SYNONYMOUS_CODING", "SYNONYMOUS_START", "SYNONYMOUS_STOP", "MOTIF", "MOTIF_DELETED",
)


def effect_rank(effect: Column) -> Column:
    return F.array_position(F.array(*[F.lit(e) for e in EFFECTS]), effect).cast("int")


def effect_impact(effect: Column) -> Column:
    return (
        F.when(effect.isin(*HIGH), "HIGH").when(effect.isin(*MODERATE), "MODERATE").when(effect.isin(*LOW), "LOW").otherwise("MODIFIER")
    )


def expand_features(
    genes: DataFrame, exons: DataFrame, upstream: int = 0, downstream: int = 0, splice: int = 2, splice_region: int = 8
) -> DataFrame:
    """Feature rows (chrom, start, end, kind, gene, transcript, is_minus) from genes and exons.

    ``genes`` has name, chrom, start, end, is_minus; ``exons`` has transcript, gene, chrom, start,
    end, cds_start, cds_end, is_minus. Introns lie between neighbouring exons; donor and acceptor
    sites are their first and last ``splice`` bases in reading direction.
    """
    none = F.lit(None).cast("string")
    minus, s, e = F.col("is_minus"), F.col("start"), F.col("end")

    def unfold(df, spans):
        """All spans of a row in one pass; empty ones are dropped."""
        parts = F.array(*[F.struct(F.lit(k).alias("kind"), a.cast("long").alias("start"), z.cast("long").alias("end")) for k, a, z in spans])
        return df.select("chrom", "gene", "transcript", "is_minus", F.explode(parts).alias("_f")).filter("_f.start <= _f.end").select(
            "chrom", "_f.start", "_f.end", "_f.kind", "gene", "transcript", "is_minus"
        )

    up = (F.when(minus, e + 1).otherwise(s - upstream), F.when(minus, e + upstream).otherwise(s - 1))
    down = (F.when(minus, s - downstream).otherwise(e + 1), F.when(minus, s - 1).otherwise(e + downstream))
    g = genes.select("chrom", "start", "end", F.col("name").alias("gene"), none.alias("transcript"), "is_minus")
    gene_rows = unfold(g, [("GENE", s, e), ("UPSTREAM", *up), ("DOWNSTREAM", *down)])

    cs, ce = F.col("cds_start"), F.col("cds_end")
    left, right = (s, F.least(e, cs - 1)), (F.greatest(s, ce + 1), e)
    by_strand = lambda plus, other: tuple(F.when(minus, y).otherwise(x) for x, y in zip(plus, other))
    exon_rows = unfold(
        exons,
        [("EXON", s, e), ("CDS", F.greatest(s, cs), F.least(e, ce)), ("UTR_5_PRIME", *by_strand(left, right)), ("UTR_3_PRIME", *by_strand(right, left))],
    )

    # a transcript has a bounded number of exons
    w = Window.partitionBy("transcript").orderBy("start")
    intron = exons.withColumn("_next", F.lead("start").over(w)).filter("_next IS NOT NULL").withColumns({"start": e + 1, "end": F.col("_next") - 1}).filter("start <= end")
    first, last = (s, F.least(e, s + splice - 1)), (F.greatest(s, e - splice + 1), e)
    intron_rows = unfold(
        intron,
        [
            ("INTRON", s, e), ("SPLICE_SITE_DONOR", *by_strand(first, last)), ("SPLICE_SITE_ACCEPTOR", *by_strand(last, first)),
            ("SPLICE_SITE_REGION", s + splice, F.least(e, s + splice_region - 1)),
            ("SPLICE_SITE_REGION", F.greatest(s + splice_region, e - splice_region + 1), e - splice),
        ],
    )
    return gene_rows.unionByName(exon_rows).unionByName(intron_rows)


def feature_effects(variants: DataFrame, features: DataFrame, salt: int = 1) -> DataFrame:
    """One row per variant and overlapped feature; INTERGENIC where there is none. Adds rank and impact."""
    f = features.withColumnsRenamed({"chrom": "fc", "start": "fs", "end": "fe", "is_minus": "f_minus"})
    v = variants if "start" in variants.columns else variants.withColumn("start", F.col("pos"))
    j = interval_join(v, f, "left", right_on=("fc", "fs", "fe"), salt=salt)
    effect = F.coalesce("kind", F.lit("INTERGENIC"))
    return j.withColumn("effect", effect).withColumns({"rank": effect_rank(F.col("effect")), "impact": effect_impact(F.col("effect"))}).drop(
        "fc", "fs", "fe", "f_minus", "kind"
    )


def worst_effect(effects: DataFrame, keys: Sequence[str] = ("chrom", "pos", "ref", "alt")) -> DataFrame:
    """The most severe effect per variant; ties go to the first gene and transcript by name."""
    return effects.groupBy(*keys).agg(F.min(F.struct("rank", "gene", "transcript", "effect", "impact")).alias("_w")).select(*keys, "_w.*")


def cds_sequences(cds: DataFrame, ref: DataFrame) -> DataFrame:
    """Coding sequence and length per transcript, in reading direction, from (transcript, chrom, start, end, is_minus).

    The group is one transcript, bounded by its coding length.
    """
    spots = cds.select("transcript", "chrom", "is_minus", F.explode(F.sequence("start", "end")).alias("pos"))
    j = spots.join(ref.select("chrom", "pos", F.upper("base").alias("base")), ["chrom", "pos"])
    g = j.groupBy("transcript", "is_minus").agg(F.sort_array(F.collect_list(F.struct("pos", "base"))).alias("_b"))
    seq = F.array_join(F.transform("_b", lambda x: x["base"]), "")
    return g.select("transcript", F.when(F.col("is_minus"), reverse_complement(seq)).otherwise(seq).alias("cds"))


def cds_offsets(cds: DataFrame) -> DataFrame:
    """Coding bases before each coding piece in reading direction."""
    rank = F.when(F.col("is_minus"), -F.col("start")).otherwise(F.col("start"))
    w = Window.partitionBy("transcript").orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    return cds.withColumn("before", F.coalesce(F.sum(F.col("end") - F.col("start") + 1).over(w), F.lit(0).cast("long")))


def codon_effects(variants: DataFrame, cds: DataFrame, ref: DataFrame, salt: int = 1) -> DataFrame:
    """Effect on the protein for variants (chrom, pos, ref, alt) that start in a coding piece.

    SNPs compare the codon before and after. Indels are a frame shift unless their length is a
    multiple of three; then an event at a codon border inserts or deletes codons, elsewhere it
    changes one as well.
    """
    pieces = cds_offsets(cds).join(cds_sequences(cds, ref), "transcript")
    p = pieces.withColumnsRenamed({"chrom": "cc", "start": "cs", "end": "ce"})
    v = variants.withColumns({"start": F.col("pos"), "end": F.col("pos")})
    j = interval_join(v, p, right_on=("cc", "cs", "ce"), salt=salt).drop("start", "end")
    minus = F.col("is_minus")
    at = F.col("before") + F.when(minus, F.col("ce") - F.col("pos")).otherwise(F.col("pos") - F.col("cs"))
    j = j.withColumn("cds_pos", at).withColumns({"codon_num": F.floor(F.col("cds_pos") / 3), "codon_index": (F.col("cds_pos") % 3).cast("int")})
    codon = F.substr("cds", (F.col("codon_num") * 3 + 1).cast("int"), F.lit(3))
    base = F.when(minus, complement(F.col("alt"))).otherwise(F.col("alt"))
    j = j.withColumn("codon_ref", codon)
    snp = (F.length("ref") == 1) & (F.length("alt") == 1)
    changed = F.concat(F.left("codon_ref", F.col("codon_index")), base, F.substr("codon_ref", F.col("codon_index") + 2))
    j = j.withColumn("codon_alt", F.when(snp, changed))
    old, new = F.col("codon_ref"), F.col("codon_alt")
    a, b = amino_acid(old), amino_acid(new)
    first = (F.col("codon_num") == 0) & is_start(old)
    same = (
        F.when(first, F.when(is_start(new), "SYNONYMOUS_START").otherwise("START_LOST"))
        .when(is_stop(old), "SYNONYMOUS_STOP").otherwise("SYNONYMOUS_CODING")
    )
    other = (
        F.when(first, F.when(is_start(new), "NON_SYNONYMOUS_START").otherwise("START_LOST"))
        .when(is_stop(old), "STOP_LOST").when(is_stop(new), "STOP_GAINED").otherwise("NON_SYNONYMOUS_CODING")
    )
    size = F.length("alt") - F.length("ref")
    border = F.col("codon_index") == F.when(minus, 0).otherwise(2)  # the event follows the anchor base
    indel = (
        F.when(size % 3 != 0, "FRAME_SHIFT")
        .when(size > 0, F.when(border, "CODON_INSERTION").otherwise("CODON_CHANGE_PLUS_CODON_INSERTION"))
        .when(size < 0, F.when(border, "CODON_DELETION").otherwise("CODON_CHANGE_PLUS_CODON_DELETION"))
        .otherwise("CODON_CHANGE")
    )
    out = j.withColumns(
        {
            "aa_ref": F.when(snp, a), "aa_alt": F.when(snp, b),
            "effect": F.when(~snp, indel).when(F.length("codon_ref") < 3, "CODON_CHANGE").when(a == b, same).otherwise(other),
        }
    )
    return out.withColumns({"rank": effect_rank(F.col("effect")), "impact": effect_impact(F.col("effect")), "cds_len": F.length("cds")}).drop(
        "cds", "before", "cc", "cs", "ce"
    )


def rare_codons(cds: DataFrame, ref: DataFrame, max_share: float = 0.01) -> DataFrame:
    """Amino acids used in less than ``max_share`` of all codons, with the places of their codons."""
    c = cds_sequences(cds, ref).select(
        "transcript", F.posexplode(F.regexp_extract_all("cds", F.lit("(.{3})"), F.lit(1))).alias("codon_num", "codon")
    ).withColumn("aa", amino_acid(F.col("codon")))
    n = c.groupBy("aa").agg(F.count("*").alias("n"))  # at most 22 rows
    total = n.agg(F.sum("n").alias("_all"))
    share = with_row(n, total).select("aa", (F.col("n") / F.col("_all")).alias("share"))
    return c.join(F.broadcast(share.filter(F.col("share") < max_share)), "aa")


def effect_counts(effects: DataFrame, by: str = "effect", score: str = "rank") -> DataFrame:
    return effects.groupBy(by).agg(F.count("*").alias("n"), F.min(score).alias("min"), F.max(score).alias("max"), F.avg(score).alias("mean"))


# ---- databases ------------------------------------------------------------------------------

# Key shapes a database can be joined by.
KEY_SHAPES = {
    "locus": ["chrom", "pos", "end"],
    "span": ["chrom", "start", "end"],
    "alleles": ["chrom", "pos", "end", "ref", "alt"],
    "position_alt": ["chrom", "pos", "alt"],
    "gene": ["gene"],
    "transcript": ["transcript"],
}


def annotate_db(variants: DataFrame, db: DataFrame, shape: str, fields: Sequence[str], prefix: str = "") -> DataFrame:
    """Left join of database fields by one of the key shapes; several records of a key are joined with commas.

    Locus and span shapes keep records whose ``alt`` list contains the variant's allele when both
    sides have one. Each key is looked up by itself, so one missing key does not empty the others.
    """
    key = KEY_SHAPES[shape]
    by_alt = shape in ("locus", "span") and "alt" in db.columns and "alt" in variants.columns
    on = key + (["alt"] if by_alt else [])
    d = db.withColumn("alt", F.explode(F.split(F.upper("alt"), ","))) if by_alt else db
    one = d.groupBy(*on).agg(*[F.array_join(F.array_sort(F.collect_set(F.col(f).cast("string"))), ",").alias(f"{prefix}{f}") for f in fields])
    return variants.join(one, on, "left")


def annotate_bed(variants: DataFrame, bed: DataFrame, out: str, salt: int = 1) -> DataFrame:
    """Names of the overlapping database intervals, sorted and joined with commas."""
    key = ["chrom", "pos", "ref", "alt"]
    v = variants.select(*key).distinct().withColumns({"start": F.col("pos"), "end": F.col("pos") + F.length("ref") - 1})
    b = bed.select(F.col("chrom").alias("bc"), F.col("start").alias("bs"), F.col("end").alias("be"), F.col("name").alias("_n"))
    hit = interval_join(v, b, right_on=("bc", "bs", "be"), salt=salt).groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set("_n")), ",").alias(out))
    return variants.join(hit, key, "left")


def annotate_gene(variants: DataFrame, genes: DataFrame, fields: Sequence[str], column: str = "genes") -> DataFrame:
    """Fields of the listed genes (``column`` is an array); variants without a known gene are dropped."""
    key = ["chrom", "pos", "ref", "alt"]
    j = variants.select(*key, F.explode(column).alias("gene")).join(genes.select("gene", *fields), "gene")
    g = j.groupBy(*key).agg(*[F.array_join(F.array_sort(F.collect_set(F.col(f).cast("string"))), ",").alias(f) for f in fields])
    return variants.join(g, key)


def annotate_with_cache(variants: DataFrame, cache: DataFrame, compute, key: Sequence[str] = ("chrom", "pos", "ref", "alt")):
    """Variants with cached annotations where present, computed ones elsewhere; all columns of ``variants`` stay.

    Returns (all rows, new rows of the cache); the caller appends the latter to the cache table.
    """
    key = list(key)
    known = variants.join(cache, key)
    new = compute(variants.join(cache.select(*key), key, "left_anti")).select(*known.columns)
    return known.unionByName(new), new.select(*cache.columns).distinct()


def group_loci(variants: DataFrame) -> DataFrame:
    """Variants of all files at one (chrom, start, end) as one unit: files, alleles and samples.

    Sets of distinct values are gathered; their size follows the alleles and samples of a locus.
    """
    return variants.groupBy("chrom", "pos", "end").agg(
        F.array_sort(F.collect_set("source")).alias("sources"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("alts")))).alias("alts"),
        F.array_sort(F.collect_set("sample")).alias("samples"),
    )


def sample_allele_columns(genotypes: DataFrame) -> DataFrame:
    """Per sample and alternate allele: depth, ratio, zygosity and filter tag.

    Needs ref, alts, gt, ad, dp, pl, is_filtered and has_near. FAIL: allele depth at most 2 or a
    doubtful PL; PASS: depth 8 or more, a clear PL and an unfiltered site; else DUBIOUS. A near
    variant lowers PASS to DUBIOUS.
    """
    gt, pl = F.col("gt"), F.col("pl")
    nc = F.exists(gt, lambda a: a < 0)
    lo, hi = F.array_min(gt), F.array_max(gt)
    zyg = (
        F.when(nc, "noCall").when((lo > 0) & (lo != hi), "het-alt").when(lo != hi, "het-ref").when(lo > 0, "hom-alt").otherwise(".")
    )
    at = (hi * (hi + 1) / 2).cast("int") + lo
    own = F.get(pl, at)
    others = F.filter(F.transform(pl, lambda x, i: record(i=i, x=x)), lambda s: s["i"] != at)
    clear = (
        F.when(pl.isNull() | nc, F.lit(1))
        .when((own > 3) | F.exists(others, lambda s: s["x"] == 0), F.lit(-1))
        .when((own > 0) | F.exists(others, lambda s: s["x"] < 10), F.lit(0))
        .otherwise(F.lit(1))
    )
    total = F.aggregate("ad", F.lit(0), lambda acc, x: acc + x)
    d = genotypes.select("*", zyg.alias("zygosity"), clear.alias("_pl"), total.alias("_sum"), F.posexplode("alts").alias("_i", "alt"))
    depth = F.get("ad", F.col("_i") + 1)
    called = F.array_contains("gt", F.col("_i") + 1)
    tag = (
        F.when((depth <= 2) | (F.col("_pl") < 0), "FAIL")
        .when((depth >= 8) & (F.col("_pl") > 0) & ~F.col("is_filtered"), F.when(F.col("has_near"), "DUBIOUS").otherwise("PASS"))
        .otherwise("DUBIOUS")
    )
    ratio = F.when(F.col("dp") == 0, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(depth.cast("double"), F.col("_sum").cast("double")), F.lit(0.0)))
    return d.select(
        "sample", "chrom", "pos", "ref", "alt", depth.alias("allele_depth"), F.round(ratio, 2).alias("allele_ratio"), "zygosity", F.when(called, tag).alias("filter_tag"),
        F.col("has_near").cast("int").alias("near_flag"), "dp",
    )


# Output field name -> column of an annotated table.
OUTPUT_FIELDS = {
    "Allele": "alt", "Effect": "effect", "Impact": "impact", "Gene": "gene", "Feature": "transcript", "Rank": "rank", "Codon": "codon_change",
    "AA": "aa_change", "CDS.Pos": "cds_pos", "CDS.Len": "cds_len", "AA.Pos": "aa_pos", "Strand": "strand", "Type": "type", "Distance": "distance",
    "Biotype": "biotype", "cDNA.Pos": "cdna_pos", "cDNA.Len": "cdna_len",
}


def select_fields(annotated: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Locus plus the chosen output fields, ``.`` where a field is missing."""
    have = set(annotated.columns)
    cell = lambda n: F.coalesce(F.col(OUTPUT_FIELDS[n]).cast("string"), F.lit(".")) if OUTPUT_FIELDS[n] in have else F.lit(".")
    return annotated.select("chrom", "pos", "ref", *[cell(n).alias(n) for n in fields])


def format_annotations(annotated: DataFrame, fields: Sequence[str]) -> DataFrame:
    """VCF INFO text per variant: ``ANNO=`` and the distinct field groups, joined by bars and commas."""
    s = select_fields(annotated, fields)
    text = F.concat_ws("|", *[F.col(f"`{n}`") for n in fields])
    return s.groupBy("chrom", "pos", "ref").agg(F.concat(F.lit("ANNO="), F.array_join(F.array_sort(F.collect_set(text)), ",")).alias("info"))

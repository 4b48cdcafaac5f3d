"""Functional-effect and database-annotation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from locuswise.functions.codons import CODON_TO_AA
from locuswise.operators import effects as ef
from locuswise.plans import fixtures as fx
from locuswise.plans.registry import query

# two exons per gene, coding part from base 4 of the gene to base -4
fx.SQL["exons"] = """SELECT concat('tr_', name) AS transcript, name AS gene, chrom, is_minus, "start" + 3 AS cds_start, "end" - 3 AS cds_end,
    CASE WHEN k = 0 THEN "start" ELSE "end" - CAST(floor(("end" - "start" + 1) / 3) AS BIGINT) + 1 END AS "start", CASE WHEN k = 0 THEN "start" + CAST(floor(("end" - "start" + 1) / 3) AS BIGINT) - 1 ELSE "end" END AS "end"
  FROM (SELECT *, unnest([0, 1]) AS k FROM regions)"""


def exons(spark, sf_dir):
    return fx.regions(spark, sf_dir).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1)))).selectExpr(
        "concat('tr_', name) AS transcript", "name AS gene", "chrom", "is_minus", "start + 3 AS cds_start", "end - 3 AS cds_end",
        "CASE WHEN k = 0 THEN start ELSE end - CAST(floor((end - start + 1) / 3) AS BIGINT) + 1 END AS start",
        "CASE WHEN k = 0 THEN start + CAST(floor((end - start + 1) / 3) AS BIGINT) - 1 ELSE end END AS end",
    )


_F = 'SELECT chrom, {s} AS "start", {e} AS "end", \'{k}\' AS kind, gene, transcript, is_minus FROM {t}'
_parts = [
    'SELECT chrom, "start", "end", \'GENE\' AS kind, name AS gene, CAST(NULL AS VARCHAR) AS transcript, is_minus FROM regions',
    'SELECT chrom, CASE WHEN is_minus THEN "end" + 1 ELSE "start" - 30 END, CASE WHEN is_minus THEN "end" + 30 ELSE "start" - 1 END, \'UPSTREAM\', name, NULL, is_minus FROM regions',
    'SELECT chrom, CASE WHEN is_minus THEN "start" - 20 ELSE "end" + 1 END, CASE WHEN is_minus THEN "start" - 1 ELSE "end" + 20 END, \'DOWNSTREAM\', name, NULL, is_minus FROM regions',
    _F.format(s='"start"', e='"end"', k="EXON", t="exons"),
    _F.format(s='greatest("start", cds_start)', e='least("end", cds_end)', k="CDS", t="exons"),
    _F.format(s='"start"', e='least("end", cds_start - 1)', k="UTR_5_PRIME", t="exons WHERE NOT is_minus"),
    _F.format(s='greatest("start", cds_end + 1)', e='"end"', k="UTR_5_PRIME", t="exons WHERE is_minus"),
    _F.format(s='"start"', e='least("end", cds_start - 1)', k="UTR_3_PRIME", t="exons WHERE is_minus"),
    _F.format(s='greatest("start", cds_end + 1)', e='"end"', k="UTR_3_PRIME", t="exons WHERE NOT is_minus"),
    _F.format(s="s", e="e", k="INTRON", t="intr"),
    _F.format(s="s", e="least(e, s + 1)", k="SPLICE_SITE_DONOR", t="intr WHERE NOT is_minus"),
    _F.format(s="greatest(s, e - 1)", e="e", k="SPLICE_SITE_DONOR", t="intr WHERE is_minus"),
    _F.format(s="s", e="least(e, s + 1)", k="SPLICE_SITE_ACCEPTOR", t="intr WHERE is_minus"),
    _F.format(s="greatest(s, e - 1)", e="e", k="SPLICE_SITE_ACCEPTOR", t="intr WHERE NOT is_minus"),
    _F.format(s="s + 2", e="least(e, s + 7)", k="SPLICE_SITE_REGION", t="intr"),
    _F.format(s="greatest(s + 8, e - 7)", e="e - 2", k="SPLICE_SITE_REGION", t="intr"),
]
fx.SQL["feats"] = (
    """SELECT * FROM (WITH intr AS (SELECT a.chrom, a."end" + 1 AS s, b."start" - 1 AS e, a.gene, a.transcript, a.is_minus FROM exons a JOIN exons b ON a.transcript = b.transcript AND a."start" < b."start" WHERE a."end" + 1 <= b."start" - 1)
   """
    + " UNION ALL ".join(_parts)
    + ') WHERE "start" <= "end"'
)


def features(spark, sf_dir):
    return ef.expand_features(fx.regions(spark, sf_dir), exons(spark, sf_dir), upstream=30, downstream=20)


@query("expand_features", "feats", "SELECT * FROM feats")
def _(spark, sf_dir):
    return features(spark, sf_dir)


def variants(spark, sf_dir):
    return fx.variants(spark, sf_dir).selectExpr("chrom", "pos", "pos + length(ref) - 1 AS end", "ref", "alt", "rsid")


def _rank(e):
    return "list_position([" + ", ".join(f"'{x}'" for x in ef.EFFECTS) + f"], {e})"


def _impact(e):
    q = lambda xs: ", ".join(f"'{x}'" for x in xs)
    return f"CASE WHEN {e} IN ({q(ef.HIGH)}) THEN 'HIGH' WHEN {e} IN ({q(ef.MODERATE)}) THEN 'MODERATE' WHEN {e} IN ({q(ef.LOW)}) THEN 'LOW' ELSE 'MODIFIER' END"


_EFF = f"""fe AS (SELECT v.chrom, v.pos, v.ref, v.alt, gene, transcript, coalesce(kind, 'INTERGENIC') AS effect FROM variants v LEFT JOIN feats f ON f.chrom = v.chrom AND f."start" <= v.pos + length(v.ref) - 1 AND f."end" >= v.pos),
  fr AS (SELECT *, CAST({_rank('effect')} AS INT) AS rank, {_impact('effect')} AS impact FROM fe)"""


def effects(spark, sf_dir):
    return ef.feature_effects(variants(spark, sf_dir), features(spark, sf_dir)).select(
        "chrom", "pos", "ref", "alt", "gene", "transcript", "effect", "rank", "impact"
    )


@query("feature_effects", "variants feats", _EFF + " SELECT * FROM fr")
def _(spark, sf_dir):
    return effects(spark, sf_dir)


@query(
    "effect_impact",
    "variants feats",
    _EFF + " SELECT * FROM fr QUALIFY row_number() OVER (PARTITION BY chrom, pos, ref, alt ORDER BY rank, gene NULLS FIRST, transcript NULLS FIRST) = 1",
)
def _(spark, sf_dir):
    return ef.worst_effect(effects(spark, sf_dir))


@query("effect_counts", "variants feats", _EFF + " SELECT effect, count(*) AS n, min(rank) AS min, max(rank) AS max, avg(rank) AS mean FROM fr GROUP BY ALL")
def _(spark, sf_dir):
    return ef.effect_counts(effects(spark, sf_dir))


_AA = "CASE upper({}) " + " ".join(f"WHEN '{c}' THEN '{a}'" for c, a in CODON_TO_AA.items()) + " ELSE '?' END"
_START = "upper({}) IN ('ATG', 'CTG', 'TTG')"
_CODON = f"""cd AS (SELECT transcript, chrom, is_minus, greatest("start", cds_start) AS s, least("end", cds_end) AS e FROM exons WHERE greatest("start", cds_start) <= least("end", cds_end)),
  ps AS (SELECT transcript, chrom, is_minus, unnest(range(s, e + 1)) AS pos FROM cd),
  sq AS (SELECT transcript, CASE WHEN any_value(is_minus) THEN reverse(translate(string_agg(base, '' ORDER BY pos), 'ACGT', 'TGCA')) ELSE string_agg(base, '' ORDER BY pos) END AS cds FROM ps JOIN refseq USING (chrom, pos) GROUP BY transcript),
  nb AS (SELECT *, row_number() OVER (PARTITION BY transcript ORDER BY CASE WHEN is_minus THEN -pos ELSE pos END) - 1 AS cds_pos FROM ps),
  hv AS (SELECT v.chrom, v.pos, v.ref, v.alt, nb.transcript, is_minus, cds_pos, cds_pos // 3 AS cn, CAST(cds_pos % 3 AS INT) AS ci, cds, length(ref) = 1 AND length(alt) = 1 AS snp FROM variants v JOIN nb ON nb.chrom = v.chrom AND nb.pos = v.pos JOIN sq USING (transcript)),
  hc AS (SELECT *, substr(cds, CAST(cn * 3 + 1 AS INT), 3) AS o FROM hv),
  hn AS (SELECT *, CASE WHEN snp THEN concat(left(o, ci), CASE WHEN is_minus THEN translate(alt, 'ACGT', 'TGCA') ELSE alt END, substr(o, ci + 2)) END AS n FROM hc),
  ha AS (SELECT *, {_AA.format('o')} AS a, {_AA.format('n')} AS b, cn = 0 AND {_START.format('o')} AS first, length(alt) - length(ref) AS sz, ci = CASE WHEN is_minus THEN 0 ELSE 2 END AS border FROM hn)"""


def cds(spark, sf_dir):
    return exons(spark, sf_dir).selectExpr("transcript", "chrom", "is_minus", "greatest(start, cds_start) AS start", "least(end, cds_end) AS end").filter("start <= end")


@query(
    "codon_effects",
    "variants exons refseq",
    _CODON
    + f""" SELECT chrom, pos, ref, alt, transcript, CAST(cds_pos AS BIGINT) AS cds_pos, o AS codon_ref, n AS codon_alt, CASE WHEN snp THEN a END AS aa_ref, CASE WHEN snp THEN b END AS aa_alt,
    CASE WHEN NOT snp THEN CASE WHEN sz % 3 <> 0 THEN 'FRAME_SHIFT' WHEN sz > 0 THEN CASE WHEN border THEN 'CODON_INSERTION' ELSE 'CODON_CHANGE_PLUS_CODON_INSERTION' END WHEN sz < 0 THEN CASE WHEN border THEN 'CODON_DELETION' ELSE 'CODON_CHANGE_PLUS_CODON_DELETION' END ELSE 'CODON_CHANGE' END
      WHEN length(o) < 3 THEN 'CODON_CHANGE'
      WHEN a = b THEN CASE WHEN first THEN CASE WHEN {_START.format('n')} THEN 'SYNONYMOUS_START' ELSE 'START_LOST' END WHEN a = '*' THEN 'SYNONYMOUS_STOP' ELSE 'SYNONYMOUS_CODING' END
      ELSE CASE WHEN first THEN CASE WHEN {_START.format('n')} THEN 'NON_SYNONYMOUS_START' ELSE 'START_LOST' END WHEN a = '*' THEN 'STOP_LOST' WHEN b = '*' THEN 'STOP_GAINED' ELSE 'NON_SYNONYMOUS_CODING' END END AS effect FROM ha""",
)
def _(spark, sf_dir):
    v = fx.variants(spark, sf_dir).select("chrom", "pos", "ref", "alt")
    out = ef.codon_effects(v, cds(spark, sf_dir), fx.refseq(spark, sf_dir))
    return out.select("chrom", "pos", "ref", "alt", "transcript", "cds_pos", "codon_ref", "codon_alt", "aa_ref", "aa_alt", "effect")


@query(
    "rare_codons",
    "exons refseq",
    _CODON.split(",\n  nb AS")[0]
    + f""", cq AS (SELECT transcript, CAST(unnest(range(length(cds) // 3)) AS INT) AS codon_num, cds FROM sq), cx AS (SELECT transcript, codon_num, substr(cds, codon_num * 3 + 1, 3) AS codon FROM cq),
    ca AS (SELECT *, {_AA.format('codon')} AS aa FROM cx), sh AS (SELECT aa, count(*) / (SELECT count(*) FROM ca) AS share FROM ca GROUP BY aa)
    SELECT aa, transcript, codon_num, codon, round(share, 6) AS share FROM ca JOIN sh USING (aa) WHERE share < 0.02""",
)
def _(spark, sf_dir):
    return ef.rare_codons(cds(spark, sf_dir), fx.refseq(spark, sf_dir), 0.02).withColumn("share", F.round("share", 6))


# ---- databases ------------------------------------------------------------------------------

_DB = """db AS (SELECT chrom, pos, pos + length(ref) - 1 AS e, ref, CASE WHEN size % 3 = 0 THEN concat(lower(alt), ',', 'TTT') ELSE alt END AS alt, concat('freq', CAST(size AS VARCHAR)) AS freq, concat('sig', CAST(size % 7 AS VARCHAR)) AS sig FROM variants WHERE size % 4 <> 2
   UNION ALL SELECT chrom, pos, pos + length(ref) - 1, ref, alt, 'extra', 'sigx' FROM variants WHERE size % 10 = 1)"""


def database(spark, sf_dir):
    v = fx.variants(spark, sf_dir)
    a = v.filter("size % 4 <> 2").selectExpr(
        "chrom", "pos", "pos + length(ref) - 1 AS end", "ref", "CASE WHEN size % 3 = 0 THEN concat(lower(alt), ',', 'TTT') ELSE alt END AS alt", "concat('freq', size) AS freq", "concat('sig', size % 7) AS sig"
    )
    b = v.filter("size % 10 = 1").selectExpr("chrom", "pos", "pos + length(ref) - 1 AS end", "ref", "alt", "'extra' AS freq", "'sigx' AS sig")
    return a.unionByName(b)


@query(
    "annotate_db",
    "variants",
    _DB
    + """, dx AS (SELECT chrom, pos, e, unnest(string_split(upper(alt), ',')) AS alt, freq, sig FROM db), dg AS (SELECT chrom, pos, e, alt, string_agg(DISTINCT freq, ',' ORDER BY freq) AS db_freq, string_agg(DISTINCT sig, ',' ORDER BY sig) AS db_sig FROM dx GROUP BY ALL)
    SELECT v.chrom, v.pos, v.ref, v.alt, db_freq, db_sig FROM variants v LEFT JOIN dg ON dg.chrom = v.chrom AND dg.pos = v.pos AND dg.e = v.pos + length(v.ref) - 1 AND dg.alt = v.alt""",
)
def _(spark, sf_dir):
    out = ef.annotate_db(variants(spark, sf_dir), database(spark, sf_dir), "locus", ["freq", "sig"], prefix="db_")
    return out.select("chrom", "pos", "ref", "alt", "db_freq", "db_sig")


@query(
    "annotate_db_alleles",
    "variants",
    _DB
    + """ SELECT v.chrom, v.pos, v.ref, v.alt, (SELECT string_agg(DISTINCT freq, ',' ORDER BY freq) FROM db WHERE db.chrom = v.chrom AND db.pos = v.pos AND db.e = v.pos + length(v.ref) - 1 AND db.ref = v.ref AND db.alt = v.alt) AS by_alleles,
      (SELECT string_agg(DISTINCT freq, ',' ORDER BY freq) FROM db WHERE db.chrom = v.chrom AND db.pos = v.pos AND db.alt = v.alt) AS by_position FROM variants v""",
)
def _(spark, sf_dir):
    db = database(spark, sf_dir)
    out = ef.annotate_db(variants(spark, sf_dir), db.withColumnRenamed("freq", "by_alleles"), "alleles", ["by_alleles"])
    out = ef.annotate_db(out, db.withColumnRenamed("freq", "by_position"), "position_alt", ["by_position"])
    return out.select("chrom", "pos", "ref", "alt", "by_alleles", "by_position")


@query(
    "annotate_bed",
    "variants regions",
    """SELECT v.chrom, v.pos, v.ref, v.alt, (SELECT string_agg(DISTINCT name, ',' ORDER BY name) FROM regions g WHERE g.chrom = v.chrom AND g."start" <= v.pos + length(v.ref) - 1 AND g."end" >= v.pos) AS bed FROM variants v""",
)
def _(spark, sf_dir):
    return ef.annotate_bed(variants(spark, sf_dir), fx.regions(spark, sf_dir), "bed").select("chrom", "pos", "ref", "alt", "bed")


_GENES = """gl AS (SELECT v.chrom, v.pos, v.ref, v.alt, g.name AS gene FROM variants v JOIN regions g ON g.chrom = v.chrom AND g."start" <= v.pos + length(v.ref) - 1 AND g."end" >= v.pos)"""


def with_genes(spark, sf_dir):
    v = ef.annotate_bed(variants(spark, sf_dir), fx.regions(spark, sf_dir), "_g")
    return v.withColumn("genes", F.coalesce(F.split("_g", ","), F.array().cast("array<string>"))).drop("_g")


@query(
    "annotate_gene",
    "variants regions",
    _GENES + """ SELECT chrom, pos, ref, alt, string_agg(DISTINCT concat('desc_', gene), ',' ORDER BY concat('desc_', gene)) AS description FROM gl WHERE CAST(substr(gene, 5) AS BIGINT) % 3 <> 0 GROUP BY ALL""",
)
def _(spark, sf_dir):
    g = fx.regions(spark, sf_dir).filter("CAST(substr(name, 5) AS BIGINT) % 3 <> 0").selectExpr("name AS gene", "concat('desc_', name) AS description")
    return ef.annotate_gene(with_genes(spark, sf_dir), g, ["description"]).select("chrom", "pos", "ref", "alt", "description")


@query(
    "annotate_transcript",
    "variants feats",
    _EFF + """ SELECT chrom, pos, ref, alt, transcript, CASE WHEN CAST(substr(transcript, 8) AS BIGINT) % 2 = 0 THEN concat('acc', transcript) END AS accession FROM fr""",
)
def _(spark, sf_dir):
    db = exons(spark, sf_dir).select("transcript").distinct().filter("CAST(substr(transcript, 8) AS BIGINT) % 2 = 0").withColumn("accession", F.concat(F.lit("acc"), "transcript"))
    return ef.annotate_db(effects(spark, sf_dir), db, "transcript", ["accession"]).select("chrom", "pos", "ref", "alt", "transcript", "accession")


@query(
    "annotate_with_cache",
    "variants",
    """SELECT *, CASE WHEN size % 3 = 0 THEN concat('cached', CAST(pos AS VARCHAR)) ELSE concat('new', CAST(pos AS VARCHAR)) END AS anno FROM variants""",
)
def _(spark, sf_dir):
    v = fx.variants(spark, sf_dir)
    cache = v.filter("size % 3 = 0").selectExpr("chrom", "pos", "ref", "alt", "concat('cached', pos) AS anno")
    rows, _new = ef.annotate_with_cache(v, cache, lambda d: d.withColumn("anno", F.expr("concat('new', pos)")))
    return rows


@query(
    "group_loci",
    "cohort",
    """v AS (SELECT chrom, pos, pos + length(ref) - 1 AS e, sample, alt1, alt2, CASE WHEN gq % 2 = 0 THEN 'a.vcf' ELSE 'b.vcf' END AS source FROM cohort WHERE a2 > 0),
    w AS (SELECT *, unnest([alt1, alt2]) AS x FROM v)
    SELECT chrom, pos, e AS "end", string_agg(DISTINCT source, ',' ORDER BY source) AS sources, string_agg(DISTINCT x, ',' ORDER BY x) AS alts, string_agg(DISTINCT sample, ',' ORDER BY sample) AS samples FROM w GROUP BY chrom, pos, e""",
)
def _(spark, sf_dir):
    c = fx.cohort(spark, sf_dir).filter("gt[1] > 0").selectExpr("chrom", "pos", "pos + length(ref) - 1 AS end", "sample", "alts", "CASE WHEN gq % 2 = 0 THEN 'a.vcf' ELSE 'b.vcf' END AS source")
    return ef.group_loci(c).withColumns({x: F.array_join(x, ",") for x in ("sources", "alts", "samples")})


@query(
    "sample_allele_columns",
    "cohort",
    """p AS (SELECT *, CASE WHEN alt2 IS NULL THEN [gq % 5, (gq * 3) % 14, dp % 12] ELSE [gq % 5, (gq * 3) % 14, dp % 12, gq % 7, dp % 9, (gq + dp) % 11] END AS pl,
       least(a1, a2) AS lo, greatest(a1, a2) AS hi, gq % 6 = 0 AS near FROM cohort),
    q AS (SELECT *, CAST(hi * (hi + 1) // 2 + lo AS INT) AS ix FROM p), o AS (SELECT *, pl[ix + 1] AS own, list_filter(list_transform(range(len(pl)), lambda i: CASE WHEN i <> ix THEN pl[i + 1] END), lambda x: x IS NOT NULL) AS ot FROM q),
    c AS (SELECT *, CASE WHEN lo < 0 THEN 1 WHEN own > 3 OR list_contains(ot, 0) THEN -1 WHEN own > 0 OR list_min(ot) < 10 THEN 0 ELSE 1 END AS ind FROM o),
    e AS (SELECT *, 1 AS k, alt1 AS alt, ad1 AS ad FROM c UNION ALL SELECT *, 2 AS k, alt2 AS alt, ad2 AS ad FROM c WHERE alt2 IS NOT NULL)
    SELECT sample, chrom, pos, ref, alt, ad AS allele_depth, CASE WHEN dp = 0 THEN 0.0 ELSE round(coalesce(ad / nullif(ad0 + ad1 + coalesce(ad2, 0), 0), 0), 2) END AS allele_ratio,
      CASE WHEN lo < 0 THEN 'noCall' WHEN lo > 0 AND lo <> hi THEN 'het-alt' WHEN lo <> hi THEN 'het-ref' WHEN lo > 0 THEN 'hom-alt' ELSE '.' END AS zygosity,
      CASE WHEN a1 = k OR a2 = k THEN CASE WHEN ad <= 2 OR ind < 0 THEN 'FAIL' WHEN ad >= 8 AND ind > 0 AND filter = 'PASS' THEN CASE WHEN near THEN 'DUBIOUS' ELSE 'PASS' END ELSE 'DUBIOUS' END END AS filter_tag, CAST(near AS INT) AS near_flag, dp FROM e""",
)
def _(spark, sf_dir):
    more = "CASE WHEN size(alts) > 1 THEN array(gq % 7, dp % 9, (gq + dp) % 11) ELSE array() END"
    c = fx.cohort(spark, sf_dir).withColumns({"pl": F.expr(f"concat(array(gq % 5, (gq * 3) % 14, dp % 12), {more})"), "has_near": F.expr("gq % 6 = 0")})
    return ef.sample_allele_columns(c)


@query(
    "format_annotations",
    "variants feats",
    _EFF
    + """, t AS (SELECT chrom, pos, ref, concat_ws('|', alt, effect, impact, coalesce(gene, '.'), coalesce(transcript, '.')) AS x FROM fr) SELECT chrom, pos, ref, concat('ANNO=', string_agg(DISTINCT x, ',' ORDER BY x)) AS info FROM t GROUP BY ALL""",
)
def _(spark, sf_dir):
    return ef.format_annotations(effects(spark, sf_dir), ["Allele", "Effect", "Impact", "Gene", "Feature"])


@query(
    "select_fields",
    "variants feats",
    _EFF + """ SELECT chrom, pos, ref, effect AS "Effect", coalesce(gene, '.') AS "Gene", CAST(rank AS VARCHAR) AS "Rank", '.' AS "Codon" FROM fr""",
)
def _(spark, sf_dir):
    return ef.select_fields(effects(spark, sf_dir), ["Effect", "Gene", "Rank", "Codon"])

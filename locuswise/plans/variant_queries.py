"""Variant, genotype and call-set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from locuswise.functions import alleles as al
from locuswise.operators import variants as vr
from locuswise.plans import fixtures as fx
from locuswise.plans.registry import query


def vtype(ref, alt):
    """SQL text of the variant type of one allele."""
    return f"""CASE WHEN length({ref}) = length({alt}) THEN CASE WHEN length({ref}) > 1 AND len(list_filter(range(length({ref})), lambda i: substr({ref}, i + 1, 1) <> substr({alt}, i + 1, 1))) > 1 THEN 'MNP' ELSE 'SNP' END
      WHEN length({ref}) > length({alt}) THEN CASE WHEN starts_with({ref}, {alt}) THEN 'DEL' ELSE 'InDel' END
      ELSE CASE WHEN starts_with({alt}, {ref}) THEN 'INS' ELSE 'InDel' END END"""


_TYPED = f"""ts AS (SELECT *, {vtype('ref', 'alt1')} AS t1, CASE WHEN alt2 IS NOT NULL THEN {vtype('ref', 'alt2')} END AS t2 FROM sites)"""
_SITE_TYPE = "CASE WHEN t2 IS NOT NULL AND t2 <> t1 THEN 'MIXED' ELSE t1 END"


@query(
    "variant_types",
    "sites",
    _TYPED + f" SELECT chrom, pos, ref, alt1, {_SITE_TYPE} AS site_type, t1 AS first_type, concat(ref, alt1) IN ('AG', 'GA', 'CT', 'TC') AS transition, "
    "length(ref) = length(alt1) AS in_snp_mode, length(ref) <> length(alt1) AS in_indel_mode FROM ts",
)
def _(spark, sf_dir):
    s = fx.sites(spark, sf_dir).withColumn("alt1", F.get("alts", F.lit(0)))
    r, a = F.col("ref"), F.col("alt1")
    return s.select(
        "chrom", "pos", "ref", "alt1", al.site_type(r, F.col("alts")).alias("site_type"), al.variant_type(r, a).alias("first_type"),
        al.is_transition(r, a).alias("transition"), al.in_mode(r, a, "SNP").alias("in_snp_mode"), al.in_mode(r, a, "INDEL").alias("in_indel_mode"),
    )


def _allele_sql(x):
    return f"CASE {x} WHEN 1 THEN alt1 WHEN 2 THEN alt2 END"


_CALLS = f"""k AS (SELECT *, filter = 'PASS' AS passed, a1 < 0 AS nc, a1 = 0 AND a2 = 0 AS hr, a1 <> a2 AS het, {_allele_sql('a1')} AS x1, {_allele_sql('a2')} AS x2 FROM cohort),
  l AS (SELECT *, CASE WHEN x1 IS NOT NULL THEN {vtype('ref', 'x1')} END AS t1, CASE WHEN x2 IS NOT NULL THEN {vtype('ref', 'x2')} END AS t2 FROM k),
  m AS (SELECT *, CASE WHEN t1 IS NOT NULL AND t2 IS NOT NULL AND t1 <> t2 THEN 'MIXED' ELSE coalesce(t1, t2) END AS kind,
     CAST(coalesce(concat(ref, x1) IN ('AG','GA','CT','TC') AND x1 IS NOT NULL, FALSE) AS INT) + CAST(coalesce(concat(ref, x2) IN ('AG','GA','CT','TC') AND x2 IS NOT NULL, FALSE) AS INT) AS ti,
     CAST(x1 IS NOT NULL AS INT) + CAST(x2 IS NOT NULL AS INT) AS na FROM l),
  n AS (SELECT *, passed AND NOT nc AND NOT hr AS v FROM m)"""


def _nt(t):
    return f"CAST(kind = '{t}' AS INT) + CASE WHEN kind = 'MIXED' THEN CAST(t1 = '{t}' AS INT) + CAST(t2 = '{t}' AS INT) ELSE 0 END"


_STAT_COLS = {
    "passed": "count(*) FILTER (passed)", "failed": "count(*) FILTER (NOT passed)", "no_call": "count(*) FILTER (passed AND nc)",
    "hom_ref": "count(*) FILTER (passed AND hr)", "het": "count(*) FILTER (v AND het)", "hom": "count(*) FILTER (v AND NOT het)",
    "known": "count(*) FILTER (v AND rsid IS NOT NULL)",
    "ti": "sum(ti) FILTER (v AND kind = 'SNP')", "tv": "sum(na - ti) FILTER (v AND kind = 'SNP')",
    "known_ti": "sum(ti) FILTER (v AND kind = 'SNP' AND rsid IS NOT NULL)", "known_tv": "sum(na - ti) FILTER (v AND kind = 'SNP' AND rsid IS NOT NULL)",
    "novel_ti": "sum(ti) FILTER (v AND kind = 'SNP' AND rsid IS NULL)", "novel_tv": "sum(na - ti) FILTER (v AND kind = 'SNP' AND rsid IS NULL)",
}
for _t in vr.TYPES:
    _STAT_COLS[f"het_{_t.lower()}"] = f"sum({_nt(_t)}) FILTER (v AND het)"
    _STAT_COLS[f"hom_{_t.lower()}"] = f"sum({_nt(_t)}) FILTER (v AND NOT het)"
_STATS = _CALLS + ", st AS (SELECT coalesce(sample, 'total') AS sample, " + ", ".join(
    f"CAST(coalesce({e}, 0) AS BIGINT) AS {n}" for n, e in _STAT_COLS.items()
) + " FROM n GROUP BY ROLLUP (sample))"


@query("variant_stats", "cohort", _STATS + " SELECT * FROM st")
def _(spark, sf_dir):
    return vr.variant_stats(fx.cohort(spark, sf_dir))


def _div(a, b):
    return f"round(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 6)"


@query(
    "variant_stats_ratios",
    "cohort",
    _STATS
    + f""" SELECT sample, {_div('ti', 'tv')} AS ti_tv, {_div('known_ti', 'known_tv')} AS known_ti_tv, {_div('novel_ti', 'novel_tv')} AS novel_ti_tv, {_div('het', 'hom')} AS het_hom, """
    + ", ".join(f"{_div(f'het_{t}', f'hom_{t}')} AS {t}_het_hom" for t in ("snp", "mnp", "ins", "del"))
    + f""", {_div('het_ins + hom_ins', '(het_del + hom_del)')} AS ins_del, {_div('(het_ins + hom_ins + het_del + hom_del)', '(het_snp + hom_snp + het_mnp + hom_mnp)')} AS indel_snp_mnp,
    {_div('known', '(passed - no_call - hom_ref)')} AS known_share FROM st""",
)
def _(spark, sf_dir):
    out = vr.variant_stats_ratios(vr.variant_stats(fx.cohort(spark, sf_dir)))
    return out.select("sample", *[F.round(c, 6).alias(c) for c in out.columns if c != "sample"])


@query(
    "allele_length_histogram",
    "cohort",
    _CALLS
    + """, u AS (SELECT sample, ref, unnest([x1, x2]) AS x, unnest([t1, t2]) AS type FROM n WHERE passed AND NOT nc)
    SELECT sample, type, greatest(length(ref), length(x)) AS length, count(*) AS n FROM u WHERE x IS NOT NULL GROUP BY ALL""",
)
def _(spark, sf_dir):
    return vr.allele_length_histogram(fx.cohort(spark, sf_dir)).withColumn("length", F.col("length").cast("long"))


_SITE_STAT = """f AS (SELECT *, length(alt1) = length(ref) AND length(ref) = 1 OR coalesce(length(alt2) = length(ref) AND length(ref) = 1, FALSE) AS snp,
    length(alt1) = length(ref) AND length(ref) > 1 OR coalesce(length(alt2) = length(ref) AND length(ref) > 1, FALSE) AS mnp,
    length(alt1) > length(ref) OR coalesce(length(alt2) > length(ref), FALSE) AS ins, length(alt1) < length(ref) OR coalesce(length(alt2) < length(ref), FALSE) AS del,
    concat(ref, alt1) IN ('AG','GA','CT','TC') AS ti FROM sites),
  g AS (SELECT 'before' AS stage, * FROM f UNION ALL SELECT 'after', * FROM f WHERE filter = 'PASS')
  SELECT stage, count(*) AS variants, count(*) FILTER (snp) AS snps, count(*) FILTER (mnp) AS mnps, count(*) FILTER (ins) AS insertions, count(*) FILTER (del) AS deletions,
   count(*) FILTER (ins OR del) AS indels, count(*) FILTER (snp AND alt2 IS NULL AND ti) AS transitions, count(*) FILTER (snp AND alt2 IS NULL AND NOT ti) AS transversions FROM g GROUP BY stage"""


@query("site_stats", "sites", _SITE_STAT)
def _(spark, sf_dir):
    s = fx.sites(spark, sf_dir)
    stages = F.when(F.col("is_filtered"), F.array(F.lit("before"))).otherwise(F.array(F.lit("before"), F.lit("after")))
    return vr.site_stats(s.withColumn("stage", F.explode(stages)), ["stage"])


@query(
    "callset_summary",
    "sites",
    _TYPED
    + f""", q AS (SELECT *, {_SITE_TYPE} AS kind, concat(ref, alt1) IN ('AG','GA','CT','TC') AS ti FROM ts)
    SELECT count(*) FILTER (kind = 'SNP') AS snps, count(*) FILTER (kind IN ('INS', 'DEL', 'InDel')) AS indels,
      round(count(*) FILTER (kind = 'SNP' AND alt2 IS NULL AND ti) / count(*) FILTER (kind = 'SNP' AND alt2 IS NULL AND NOT ti), 6) AS ti_tv,
      count(DISTINCT CASE WHEN kind = 'SNP' THEN chrom END) AS snp_contigs, count(DISTINCT CASE WHEN kind IN ('INS', 'DEL', 'InDel') THEN chrom END) AS indel_contigs FROM q""",
)
def _(spark, sf_dir):
    return vr.callset_summary(fx.sites(spark, sf_dir)).withColumn("ti_tv", F.round("ti_tv", 6))


@query(
    "hard_filter",
    "sites",
    _TYPED
    + f""" SELECT chrom, pos, array_to_string(CASE WHEN len(fl) = 0 THEN ['PASS'] ELSE fl END, ';') AS filters FROM (
      SELECT chrom, pos, list_filter([CASE WHEN filter <> 'PASS' THEN filter END, CASE WHEN {_SITE_TYPE} = 'SNP' AND size % 13 < 2 THEN 'HFsnp' END,
        CASE WHEN {_SITE_TYPE} IN ('INS', 'DEL', 'InDel') AND size % 3 <> 0 AND size > 30 THEN 'HFindel' END], lambda x: x IS NOT NULL) AS fl FROM ts)""",
)
def _(spark, sf_dir):
    out = vr.hard_filter(
        fx.sites(spark, sf_dir), "HF", "CAST(info['QD'] AS DOUBLE) < 2.0", "CAST(info['FS'] AS DOUBLE) > 30.0"
    )
    return out.select("chrom", "pos", F.array_join("filters", ";").alias("filters"))


@query(
    "eval_filter",
    "sites",
    _TYPED + f" SELECT substr(chrom, 4) AS chrom, pos, ref FROM ts WHERE filter = 'PASS' AND {_SITE_TYPE} = 'SNP'",
)
def _(spark, sf_dir):
    return vr.eval_filter(fx.sites(spark, sf_dir), "SNP").select(vr.norm_contig(F.col("chrom")).alias("chrom"), "pos", "ref")


_KNOWN = """kn AS (SELECT chrom, pos, pos + length(ref) - 1 AS e, ref, CASE WHEN size % 4 = 1 THEN concat(ref, 'C') ELSE alt1 END AS ka, concat('kn', CAST(pos AS VARCHAR)) AS kid, pos AS ord FROM sites WHERE size % 3 <> 2
    UNION ALL SELECT chrom, pos, pos + length(ref) - 1, ref, alt2, concat('k2', CAST(pos AS VARCHAR)), pos + 100000000 FROM sites WHERE alt2 IS NOT NULL)"""


@query(
    "annotate_ids",
    "sites",
    _KNOWN
    + """ SELECT s.chrom, s.pos, coalesce((SELECT min_by(kid, ord) FROM kn WHERE kn.chrom = s.chrom AND kn.pos = s.pos AND kn.e = s.pos + length(s.ref) - 1 AND (kn.ka = s.alt1 OR kn.ka = s.alt2)), rsid) AS id FROM sites s""",
)
def _(spark, sf_dir):
    s = fx.sites(spark, sf_dir)
    k = s.filter("size % 3 <> 2").selectExpr(
        "chrom", "pos", "end", "array(CASE WHEN size % 4 = 1 THEN concat(ref, 'C') ELSE alts[0] END) AS alts", "concat('kn', pos) AS id", "pos AS order"
    ).unionByName(
        s.filter("size(alts) > 1").selectExpr("chrom", "pos", "end", "array(alts[1]) AS alts", "concat('k2', pos) AS id", "pos + 100000000 AS order")
    )
    return vr.annotate_ids(s, k).select("chrom", "pos", "id")


# ---- concordance ----------------------------------------------------------------------------

def truth_set(spark, sf_dir):
    """A second call set: some sites missing, some genotypes changed, sample s11 absent."""
    c = fx.cohort(spark, sf_dir).filter("pos % 10 <> 3 AND sample <> 's11'")
    return c.withColumn("gt", F.expr("CASE WHEN gq % 9 = 0 THEN array(0, 1) WHEN gq % 9 = 1 THEN array(0, 0) ELSE gt END"))


def _set_sql(a1, a2):
    return f"""array_to_string(list_sort(list_distinct(list_filter([CASE {a1} WHEN 1 THEN alt1 WHEN 2 THEN alt2 END, CASE {a2} WHEN 1 THEN alt1 WHEN 2 THEN alt2 END], lambda x: x IS NOT NULL))), ',')"""


_COMPARE = f"""tr AS (SELECT * REPLACE (CASE WHEN gq % 9 <= 1 THEN 0 ELSE a1 END AS a1, CASE WHEN gq % 9 = 0 THEN 1 WHEN gq % 9 = 1 THEN 0 ELSE a2 END AS a2) FROM cohort WHERE pos % 10 <> 3 AND sample <> 's11'),
  sm AS (SELECT DISTINCT sample FROM cohort INTERSECT SELECT DISTINCT sample FROM tr),
  te AS (SELECT substr(chrom, 4) AS chrom, pos, pos + length(ref) - 1 AS e, alt1 AS alt, sample, CASE WHEN a1 >= 0 THEN nullif({_set_sql('a1', 'a2')}, '') END AS x FROM cohort WHERE sample IN (FROM sm)),
  tb AS (SELECT substr(chrom, 4) AS chrom, pos, pos + length(ref) - 1 AS e, alt1 AS alt, sample, CASE WHEN a1 >= 0 THEN nullif({_set_sql('a1', 'a2')}, '') END AS y FROM tr WHERE sample IN (FROM sm)),
  cm AS (SELECT * FROM te FULL JOIN tb USING (chrom, pos, e, alt, sample))"""
_COUNTS = (
    _COMPARE
    + """, cn AS (SELECT coalesce(sample, 'total') AS sample, count(x) AS test, count(y) AS truth, count(*) FILTER (x = y) AS matched FROM cm GROUP BY ROLLUP (sample)
    UNION ALL SELECT 'REF', (SELECT count(*) FROM (SELECT DISTINCT chrom, pos FROM cohort)), (SELECT count(*) FROM (SELECT DISTINCT chrom, pos FROM tr)),
      (SELECT count(*) FROM (SELECT DISTINCT chrom, pos FROM cohort INTERSECT SELECT DISTINCT chrom, pos FROM tr)))"""
)


@query("concordance_counts", "cohort", _COUNTS + " SELECT * FROM cn")
def _(spark, sf_dir):
    return vr.concordance_counts(fx.cohort(spark, sf_dir), truth_set(spark, sf_dir))


@query(
    "concordance_report",
    "cohort",
    _COUNTS
    + """ SELECT sample, test + truth - matched AS total, test, truth, matched, round(100.0 * matched / nullif(test + truth - matched, 0), 2) AS concordance,
    round(100.0 * matched / nullif(test, 0), 2) AS "precision", round(100.0 * matched / nullif(truth, 0), 2) AS sensitivity, round(200.0 * matched / nullif(test + truth, 0), 2) AS f_measure FROM cn""",
)
def _(spark, sf_dir):
    return vr.concordance_report(vr.concordance_counts(fx.cohort(spark, sf_dir), truth_set(spark, sf_dir)))


@query("diff_list", "cohort", _COMPARE + ' SELECT sample, chrom, pos, e AS "end", alt FROM cm WHERE (x IS NOT NULL OR y IS NOT NULL) AND x IS DISTINCT FROM y')
def _(spark, sf_dir):
    return vr.diff_calls(fx.cohort(spark, sf_dir), truth_set(spark, sf_dir))


@query("sample_intersect", "cohort", "SELECT DISTINCT sample FROM cohort WHERE sample <> 's11'")
def _(spark, sf_dir):
    return vr.common_samples(fx.cohort(spark, sf_dir), truth_set(spark, sf_dir))


# ---- table forms ----------------------------------------------------------------------------

_SHOWN = "CASE WHEN {0} < 0 THEN '.' WHEN {0} = 1 THEN alt1 WHEN {0} = 2 THEN alt2 END"


@query(
    "variant_warehouse",
    "cohort",
    f"""w AS (SELECT *, {_SHOWN.format('a1')} AS x1, {_SHOWN.format('a2')} AS x2 FROM cohort)
    SELECT concat_ws('-', chrom, CAST(pos AS VARCHAR), sample) AS row_key, ref, CASE WHEN x1 IS NULL THEN x2 WHEN x2 IS NULL OR x1 = x2 THEN x1 ELSE concat(x1, ',', x2) END AS alt,
      regexp_replace(printf('%.2f', qual), '\\.00$', '') AS qual,
      CAST(CASE WHEN x1 IS NULL THEN 0 ELSE 16 END + CASE WHEN x2 IS NULL THEN 0 WHEN x1 IS NULL OR x1 = x2 THEN 1 ELSE 2 END AS INT) AS gt,
      concat_ws(',', CAST(ad0 AS VARCHAR), CAST(ad1 AS VARCHAR), CAST(ad2 AS VARCHAR)) AS ad, dp
    FROM w WHERE x1 IS NOT NULL OR x2 IS NOT NULL""",
)
def _(spark, sf_dir):
    return vr.variant_warehouse(fx.cohort(spark, sf_dir))


_AC = "CASE WHEN size % 7 = 0 THEN concat(CAST(size % 5 AS VARCHAR), ',', CAST(size % 4 AS VARCHAR)) ELSE CAST(size % 5 AS VARCHAR) END"


@query(
    "flatten_info",
    "sites",
    f"""SELECT substr(chrom, 4) AS chrom, pos, ref, alt, CAST(size % 13 AS VARCHAR) AS "QD", CASE WHEN size % 3 <> 0 THEN CAST(size AS VARCHAR) ELSE '.' END AS "FS", {_AC} AS "AC"
    FROM (SELECT *, unnest([alt1, alt2]) AS alt FROM sites) WHERE alt IS NOT NULL""",
)
def _(spark, sf_dir):
    return vr.flatten_info(fx.sites(spark, sf_dir))


@query(
    "split_multiallelic",
    "sites",
    f"""SELECT chrom, pos, alt1 AS alt, CASE WHEN alt2 IS NOT NULL THEN split_part({_AC}, ',', 1) ELSE {_AC} END AS "AC", CAST(size % 13 AS VARCHAR) AS "QD" FROM sites
    UNION ALL SELECT chrom, pos, alt2, split_part({_AC}, ',', 2), CAST(size % 13 AS VARCHAR) FROM sites WHERE alt2 IS NOT NULL""",
)
def _(spark, sf_dir):
    s = fx.sites(spark, sf_dir).select("chrom", "pos", "alts", F.expr("info['AC'] AS AC"), F.expr("info['QD'] AS QD"))
    return vr.split_multiallelic(s, ["AC", "QD"])


@query(
    "trim_alleles",
    "sites",
    """b AS (SELECT chrom, pos, concat('CA', ref, 'GG') AS r, concat('CA', alt1, 'GG') AS a FROM sites),
    s AS (SELECT *, coalesce(list_max(list_filter(range(1, least(length(r), length(a))), lambda n: right(r, n) = right(a, n))), 0) AS k FROM b),
    t AS (SELECT chrom, pos, left(r, length(r) - k) AS r, left(a, length(a) - k) AS a FROM s),
    p AS (SELECT *, coalesce(list_max(list_filter(range(1, least(length(r), length(a))), lambda n: left(r, n) = left(a, n))), 0) AS k FROM t)
    SELECT chrom, pos AS first_pos, CAST(pos + k AS BIGINT) AS pos, substr(r, k + 1) AS ref, substr(a, k + 1) AS alt FROM p""",
)
def _(spark, sf_dir):
    s = fx.sites(spark, sf_dir).selectExpr(
        "chrom", "pos", "pos AS first_pos", "concat('CA', ref, 'GG') AS ref", "concat('CA', alts[0], 'GG') AS alt"
    )
    return al.trim_alleles(s)


@query(
    "rename_samples",
    "cohort",
    """SELECT concat('patient_', sample, '_x') AS sample, chrom, pos, gq FROM cohort""",
)
def _(spark, sf_dir):
    c = fx.cohort(spark, sf_dir).select("sample", "chrom", "pos", "gq")
    return vr.rename_samples(c, c.select("sample").distinct().withColumn("new_name", F.expr("concat('patient ', sample, '#x')")))


_PED = "ped(family, f, m, c) AS (VALUES ('fam1', 's0', 's1', 's2'), ('fam2', 's3', 's4', 's5'), ('fam3', 's6', 's7', 's8'))"


def trios(spark):
    return spark.createDataFrame(
        [("fam1", "s0", "s1", "s2"), ("fam2", "s3", "s4", "s5"), ("fam3", "s6", "s7", "s8")], "family string, father string, mother string, child string"
    )


@query(
    "mendelian",
    "cohort",
    _PED
    + """, g AS (SELECT * FROM cohort WHERE gq >= 10),
    t AS (SELECT family, f.a1 AS f1, f.a2 AS f2, m.a1 AS m1, m.a2 AS m2, c.a1 AS c1, c.a2 AS c2 FROM ped JOIN g f ON f.sample = ped.f JOIN g m ON m.sample = ped.m AND m.chrom = f.chrom AND m.pos = f.pos
       JOIN g c ON c.sample = ped.c AND c.chrom = f.chrom AND c.pos = f.pos),
    v AS (SELECT family, CASE WHEN c1 < 0 THEN FALSE
       WHEN m1 < 0 THEN (f1 = 0 AND f2 = 0 AND c1 > 0 AND c1 = c2) OR (f1 > 0 AND f1 = f2 AND c1 = 0 AND c2 = 0)
       WHEN f1 < 0 THEN (m1 = 0 AND m2 = 0 AND c1 > 0 AND c1 = c2) OR (m1 > 0 AND m1 = m2 AND c1 = 0 AND c2 = 0)
       ELSE NOT ((c1 IN (m1, m2) AND c2 IN (f1, f2)) OR (c2 IN (m1, m2) AND c1 IN (f1, f2))) END AS bad FROM t)
    SELECT family, count(*) AS sites, count(*) FILTER (bad) AS violations FROM v GROUP BY family""",
)
def _(spark, sf_dir):
    return vr.mendelian_violations(fx.cohort(spark, sf_dir), trios(spark), 10)


@query(
    "near_variants",
    "cohort",
    """v AS (SELECT sample, chrom, pos, pos + length(ref) - 1 AS e FROM cohort WHERE a2 > 0),
    w AS (SELECT *, lead(pos) OVER (PARTITION BY sample, chrom ORDER BY pos) AS nx, max(e) OVER (PARTITION BY sample, chrom ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pv FROM v)
    SELECT sample, chrom, pos, coalesce(nx - e <= 5, FALSE) OR coalesce(pos - pv <= 5, FALSE) AS has_near FROM w""",
)
def _(spark, sf_dir):
    v = fx.cohort(spark, sf_dir).filter("gt[1] > 0").selectExpr("sample", "chrom", "pos", "pos + length(ref) - 1 AS end")
    return vr.near_variants(v).select("sample", "chrom", "pos", "has_near")


@query(
    "merge_samples",
    "reads genotypes",
    """u AS (SELECT DISTINCT sample, 'fastq' AS source FROM reads UNION SELECT DISTINCT sample, 'vcf' FROM genotypes)
    SELECT sample, min(source) AS source, count(DISTINCT source) AS sources, CAST(row_number() OVER (ORDER BY sample) - 1 AS INT) AS idx FROM u GROUP BY sample""",
)
def _(spark, sf_dir):
    a = fx.reads(spark, sf_dir).select("sample").distinct().withColumn("source", F.lit("fastq"))
    b = fx.genotypes(spark, sf_dir).select("sample").distinct().withColumn("source", F.lit("vcf"))
    return vr.merge_samples(a, b)


@query("union_sources", "reads regions", """SELECT 'reads' AS source, chrom, pos FROM reads UNION ALL SELECT 'regions', chrom, "start" FROM regions""")
def _(spark, sf_dir):
    return vr.union_sources(
        reads=fx.reads(spark, sf_dir).select("chrom", "pos"), regions=fx.regions(spark, sf_dir).selectExpr("chrom", "start AS pos")
    )


@query("distinct_positions", "reads genotypes variants", "SELECT chrom, pos FROM genotypes UNION SELECT chrom, pos FROM variants UNION SELECT chrom, pos FROM reads WHERE NOT is_unmapped")
def _(spark, sf_dir):
    return vr.distinct_positions(
        fx.genotypes(spark, sf_dir), fx.variants(spark, sf_dir), fx.reads(spark, sf_dir).filter("NOT is_unmapped")
    )

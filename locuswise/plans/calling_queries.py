"""Pileup, likelihood and calling queries.

Read bases of the fixture are random text. Calls use a pileup whose bases follow the reference
except at every ninth position of half the samples, so that most sites are clean and some are not.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from locuswise.operators import calling as cl
from locuswise.operators.pileup import explode_bases, passes_base_filter, pileup as cigar_pileup
from locuswise.operators.reference import ref_blocks, reference_in_reads
from locuswise.plans import fixtures as fx
from locuswise.plans.registry import query

# bases that mostly match the reference
fx.SQL["clean"] = """SELECT p.* REPLACE (CASE WHEN p.base <> 'N' AND NOT (p.pos % 9 = 0 AND ascii(sample[2]) % 2 = 0 AND (ascii(p.base) + p.qual) % 3 > 0) THEN r.base ELSE p.base END AS base)
  FROM pileup p JOIN refseq r USING (chrom, pos)"""


def clean_pileup(spark, sf_dir):
    p = fx.pileup(spark, sf_dir)
    r = fx.refseq(spark, sf_dir).withColumnRenamed("base", "_ref")
    keep = "base <> 'N' AND NOT (pos % 9 = 0 AND ascii(substr(sample, 2, 1)) % 2 = 0 AND (ascii(base) + qual) % 3 > 0)"
    return p.join(r, ["chrom", "pos"]).withColumn("base", F.expr(f"CASE WHEN {keep} THEN _ref ELSE base END")).drop("_ref")


_TERMS = f"""q AS (SELECT *, CASE WHEN least(qual, mapq) < 10 THEN 0 ELSE least(qual, mapq) END AS q FROM {{src}} WHERE base <> 'N'),
  e AS (SELECT *, pow(10.0, -q / 10.0) AS e FROM q),
  mn AS (SELECT *, CASE WHEN q = 0 THEN 1.0 ELSE (1 - 1e-4) * (1 - e) + 1e-4 * e / 3 END AS m,
                CASE WHEN q = 0 THEN 1.0 ELSE (1 - 1e-4) * e / 3 + 1e-4 / 3 * (1 - e) + 2 * 1e-4 / 3 * e / 3 END AS n FROM e),
  gl AS (SELECT sample, chrom, pos, count(*) AS depth, """ + ", ".join(
    f"sum(log10(((CASE WHEN base = '{g[0]}' THEN m ELSE n END) + (CASE WHEN base = '{g[1]}' THEN m ELSE n END)) / 2)) AS \"gl_{g}\"" for g in cl.GENOTYPES
) + " FROM mn GROUP BY ALL)"


@query(
    "genotype_likelihoods",
    "pileup",
    _TERMS.format(src="pileup") + " SELECT sample, chrom, pos, depth, " + ", ".join(f'round("gl_{g}", 6) AS "gl_{g}"' for g in cl.GENOTYPES) + " FROM gl WHERE depth > 2",
)
def _(spark, sf_dir):
    g = cl.genotype_likelihoods(fx.pileup(spark, sf_dir), min_depth=2)
    return g.withColumns({f"gl_{x}": F.round(f"gl_{x}", 6) for x in cl.GENOTYPES})


_ALTS = _TERMS.format(src="clean") + """, gr AS (SELECT gl.*, r.base AS ref FROM gl JOIN refseq r USING (chrom, pos) WHERE depth > 2),
  lng AS (SELECT sample, chrom, pos, ref, unnest([""" + ", ".join(f"'{g}'" for g in cl.GENOTYPES) + "]) AS g, unnest([" + ", ".join(
    f'"gl_{g}"' for g in cl.GENOTYPES
) + """]) AS v FROM gr),
  best AS (SELECT *, row_number() OVER (PARTITION BY sample, chrom, pos ORDER BY round(v, 9) DESC, g) AS rk, max(CASE WHEN g = concat(ref, ref) THEN v END) OVER (PARTITION BY sample, chrom, pos) AS rr FROM lng),
  votes AS (SELECT chrom, pos, ref, unnest(list_distinct([g[1], g[2]])) AS alt, v - rr AS gain FROM best WHERE rk = 1 AND g <> concat(ref, ref)),
  ca AS (SELECT chrom, pos, ref, list(alt ORDER BY alt) AS alts FROM (SELECT chrom, pos, ref, alt, sum(gain) AS s FROM votes WHERE alt <> ref GROUP BY ALL) WHERE s > 0 GROUP BY ALL)"""


@query("choose_alts", "pileup refseq clean", _ALTS + " SELECT chrom, pos, ref, array_to_string(alts, ',') AS alts FROM ca")
def _(spark, sf_dir):
    g = cl.genotype_likelihoods(clean_pileup(spark, sf_dir), min_depth=2)
    return cl.choose_alts(g, fx.refseq(spark, sf_dir)).withColumn("alts", F.array_join("alts", ","))


def _pick(a, b):
    return f"max(CASE WHEN g = concat(least({a}, {b}), greatest({a}, {b})) THEN v END)"


# exact allele counts by listing all genotype combinations of the four samples
_CALLS = """t3 AS (SELECT l.chrom, l.pos, l.ref, ca.alt AS alt, l.sample, """ + f"{_pick('l.ref', 'l.ref')} AS rr, {_pick('l.ref', 'ca.alt')} AS ra, {_pick('ca.alt', 'ca.alt')} AS aa" + """
    FROM lng l JOIN (SELECT chrom, pos, unnest(alts) AS alt FROM {sites}) ca ON l.chrom = ca.chrom AND l.pos = ca.pos GROUP BY ALL),
  w3 AS (SELECT *, greatest(rr, ra, aa) AS top, greatest(rr, ra, aa) - least(rr, ra, aa) > 1e-9 AS called, CASE WHEN rr >= ra AND rr >= aa THEN 0 WHEN ra >= aa THEN 1 ELSE 2 END AS copies FROM t3),
  gx AS (SELECT chrom, pos, alt, sample, unnest([0, 1, 2]) AS c, unnest([pow(10, rr - top), 2 * pow(10, ra - top), pow(10, aa - top)]) AS w FROM w3),
  comb AS (SELECT st.chrom, st.pos, st.alt, coalesce(a.c, 0) + coalesce(b.c, 0) + coalesce(d.c, 0) + coalesce(f.c, 0) AS k, sum(coalesce(a.w, 1) * coalesce(b.w, 1) * coalesce(d.w, 1) * coalesce(f.w, 1)) AS z
     FROM (SELECT DISTINCT chrom, pos, alt FROM w3) st LEFT JOIN gx a ON a.chrom = st.chrom AND a.pos = st.pos AND a.alt = st.alt AND a.sample = 's0' LEFT JOIN gx b ON b.chrom = st.chrom AND b.pos = st.pos AND b.alt = st.alt AND b.sample = 's1'
     LEFT JOIN gx d ON d.chrom = st.chrom AND d.pos = st.pos AND d.alt = st.alt AND d.sample = 's2' LEFT JOIN gx f ON f.chrom = st.chrom AND f.pos = st.pos AND f.alt = st.alt AND f.sample = 's3' GROUP BY ALL),
  nn AS (SELECT chrom, pos, ref, alt, 2 * count(*) AS n, CAST(2 * count(*) FILTER (called) AS INT) AS an, CAST(sum(copies) FILTER (called) AS INT) AS ac FROM w3 GROUP BY ALL),
  lk AS (SELECT comb.*, n, z / (gamma(n + 1) / gamma(k + 1) / gamma(n - k + 1)) AS lk, CASE WHEN k = 0 THEN 1 - 0.001 * list_sum(list_transform(range(1, n + 1), lambda i: 1.0 / i)) ELSE 0.001 / k END AS prior
     FROM comb JOIN nn USING (chrom, pos, alt)),
  fin AS (SELECT chrom, pos, alt, -10 * log10(greatest(sum(lk * prior) FILTER (k = 0) / sum(lk * prior), 1e-300)) AS qual, CAST(arg_max(k, round(lk, 12)) AS INT) AS mleac FROM lk GROUP BY ALL),
  dps AS (SELECT chrom, pos, CAST(sum(depth) AS BIGINT) AS dp FROM gl WHERE depth > 2 GROUP BY ALL),
  out AS (SELECT nn.chrom, nn.pos, nn.ref, nn.alt, dp, round(qual, 4) AS qual, CASE WHEN qual < 30 THEN 'LowQual' ELSE 'PASS' END AS filter, coalesce(ac, 0) AS ac, an, mleac,
     round(least(1.0, mleac / nullif(an, 0)), 6) AS mleaf FROM nn JOIN fin USING (chrom, pos, alt) JOIN dps USING (chrom, pos) WHERE {emit})"""


@query("call_genotypes", "pileup refseq clean", _ALTS + ", " + _CALLS.format(sites="ca", emit="mleac > 0 AND qual >= 10") + " SELECT * FROM out")
def _(spark, sf_dir):
    r = fx.refseq(spark, sf_dir)
    g = cl.genotype_likelihoods(clean_pileup(spark, sf_dir), min_depth=2)
    out = cl.call_genotypes(g, cl.choose_alts(g, r), emit=10.0)
    return out.withColumns({"qual": F.round("qual", 4), "mleaf": F.round("mleaf", 6)})


@query(
    "assign_genotypes",
    "pileup refseq clean",
    _ALTS
    + ", "
    + _CALLS.format(sites="ca", emit="mleac > 0 AND qual >= 10")
    + """, p AS (SELECT *, CAST(round((top - rr) * 10) AS INT) AS p0, CAST(round((top - ra) * 10) AS INT) AS p1, CAST(round((top - aa) * 10) AS INT) AS p2 FROM w3)
    SELECT sample, chrom, pos, ref, alt, concat_ws(',', CAST(p0 AS VARCHAR), CAST(p1 AS VARCHAR), CAST(p2 AS VARCHAR)) AS pl,
      CASE WHEN greatest(p0, p1, p2) = 0 THEN './.' WHEN p0 = 0 THEN '0/0' WHEN p1 = 0 THEN '0/1' ELSE '1/1' END AS gt, CAST(least(list_sort([p0, p1, p2])[2], 99) AS INT) AS gq FROM p""",
)
def _(spark, sf_dir):
    g = cl.genotype_likelihoods(clean_pileup(spark, sf_dir), min_depth=2)
    out = cl.assign_genotypes(g, cl.choose_alts(g, fx.refseq(spark, sf_dir)))
    show = F.transform("gt", lambda a: F.when(a < 0, ".").otherwise(a.cast("string")))
    return out.select(
        "sample", "chrom", "pos", "ref", "alt", F.array_join(F.transform("pl", lambda x: x.cast("string")), ",").alias("pl"),
        F.array_join(show, "/").alias("gt"), "gq",
    )


_GIVEN = """gv AS (SELECT r.chrom, r.pos, r.base AS ref, CASE WHEN r.pos % 3 = 0 THEN [CASE WHEN r.base = 'A' THEN 'C' ELSE 'A' END] ELSE list_filter(['A', 'C', 'G', 'T'], lambda b: b <> r.base) END AS alts FROM refseq r JOIN variants v ON v.chrom = r.chrom AND v.pos = r.pos)"""


@query("genotype_given", "pileup refseq clean variants", _ALTS + ", " + _GIVEN + ", " + _CALLS.format(sites="gv", emit="TRUE") + " SELECT * FROM out")
def _(spark, sf_dir):
    r = fx.refseq(spark, sf_dir)
    given = r.join(fx.variants(spark, sf_dir).select("chrom", "pos"), ["chrom", "pos"]).selectExpr(
        "chrom", "pos", "base AS ref", "CASE WHEN pos % 3 = 0 THEN array(CASE WHEN base = 'A' THEN 'C' ELSE 'A' END) ELSE filter(array('A', 'C', 'G', 'T'), b -> b <> base) END AS alts"
    )
    g = cl.genotype_likelihoods(clean_pileup(spark, sf_dir), min_depth=2)
    out = cl.genotype_given(g, given)
    return out.withColumns({"qual": F.round("qual", 4), "mleaf": F.round("mleaf", 6)})


@query(
    "ref_confidence",
    "reads",
    """d AS (SELECT sample, chrom, pos + i AS pos, count(*) AS depth FROM reads, (SELECT unnest(range(32)) AS i) WHERE NOT is_unmapped GROUP BY ALL)
    SELECT chrom, pos, round(-10 * log10(list_reduce(list(0.0005 * pow(0.5, depth)), lambda a, b: a + b - a * b)), 6) AS ref_conf FROM d GROUP BY ALL""",
)
def _(spark, sf_dir):
    d = fx.pileup(spark, sf_dir).groupBy("sample", "chrom", "pos").agg(F.count("*").alias("depth"))
    return cl.ref_confidence(d).withColumn("ref_conf", F.round("ref_conf", 6))


@query(
    "ref_vs_any",
    "pileup refseq",
    f"""d AS (SELECT p.*, r.base AS ref, pow(10.0, -qual / 10.0) AS e FROM pileup p JOIN refseq r USING (chrom, pos) WHERE qual > 10),
    f AS (SELECT *, log10(1 - e) AS y, log10(e) + {math.log10(1 / 3)} AS n, base <> ref AS alt FROM d)
    SELECT sample, chrom, pos, round(sum(CASE WHEN alt THEN n ELSE y END), 6) AS gl_0, round(sum(log10(pow(10, y) + pow(10, n)) - {math.log10(2)}), 6) AS gl_1,
      round(sum(CASE WHEN alt THEN y ELSE n END), 6) AS gl_2, count(*) FILTER (NOT alt) AS ref_depth, count(*) FILTER (alt) AS alt_depth FROM f GROUP BY ALL""",
)
def _(spark, sf_dir):
    ref = fx.refseq(spark, sf_dir)
    out = cl.ref_vs_any(explode_bases(reference_in_reads(fx.reads(spark, sf_dir).filter("NOT is_unmapped"), ref)), ref)
    return out.withColumns({c: F.round(c, 6) for c in ("gl_0", "gl_1", "gl_2")})


_SHAPES = """sh(cigar, s, e, o, d) AS (VALUES ('2S30M',0,29,2,FALSE),('10M2I20M',0,9,0,FALSE),('10M2I20M',10,29,2,FALSE),('10M3D22M',0,9,0,FALSE),
  ('10M3D22M',10,12,0,TRUE),('10M3D22M',13,34,-3,FALSE),('4D32M',0,3,0,TRUE),('4D32M',4,35,-4,FALSE),('10M2I3D20M',0,9,0,FALSE),('10M2I3D20M',10,12,0,TRUE),
  ('10M2I3D20M',13,32,-1,FALSE),('5H30M2S',0,29,0,FALSE),('10M5N22M',0,9,0,FALSE),('10M5N22M',15,36,-5,FALSE),('32M',0,31,0,FALSE)),
  pp AS (SELECT a.*, unnest(range(s, e + 1)) AS i, o, d FROM aligned a JOIN sh USING (cigar) WHERE a.pos IS NOT NULL),
  cp AS (SELECT sample, read_name, mate_no, mapq, chrom, pos + i AS gpos, CASE WHEN NOT d THEN substr(bases, CAST(i + o + 1 AS INT), 1) END AS base,
     CASE WHEN NOT d THEN CAST(ascii(substr(quals, CAST(i + o + 1 AS INT), 1)) - 33 AS INT) END AS qual, d AS is_del,
     CASE WHEN cigar IN ('10M2I20M', '10M2I3D20M') AND i = 9 THEN substr(bases, 11, 2) END AS next_ins,
     CASE WHEN cigar = '10M3D22M' AND i = 9 THEN 3 END AS next_del FROM pp)"""


def _cigar_pileup(spark, sf_dir):
    a = fx.aligned(spark, sf_dir).filter("pos IS NOT NULL").select(
        "sample", "read_name", "mate_no", "mapq", "chrom", "pos", "cigar", "bases", "quals"
    )
    return cigar_pileup(a)


@query(
    "pileup_cigar",
    "aligned",
    _SHAPES + " SELECT read_name, mate_no, chrom, CAST(gpos AS BIGINT) AS pos, base, qual, is_del, next_ins, next_del FROM cp WHERE mapq >= 20 AND (is_del OR qual >= 15)",
)
def _(spark, sf_dir):
    p = _cigar_pileup(spark, sf_dir)
    ok = passes_base_filter(F.col("mapq"), F.col("qual"), F.col("is_del"), 20, 15)
    return p.filter(ok).select("read_name", "mate_no", "chrom", "pos", "base", "qual", "is_del", "next_ins", "next_del")


@query(
    "consensus_indels",
    "aligned refseq",
    _SHAPES
    + """, ev AS (SELECT sample, chrom, gpos AS pos, CASE WHEN next_ins IS NOT NULL THEN next_ins WHEN next_del IS NOT NULL THEN 'D3' END AS ev FROM cp),
    gs AS (SELECT sample, chrom, pos FROM ev GROUP BY ALL HAVING count(ev) > 0 AND count(ev) / count(*) >= 0.02),
    ct AS (SELECT chrom, pos, ev, count(*) AS n FROM ev SEMI JOIN gs USING (sample, chrom, pos) WHERE ev IS NOT NULL GROUP BY ALL HAVING count(*) >= 2),
    rr AS (SELECT ct.*, (SELECT string_agg(base, '' ORDER BY r.pos) FROM refseq r WHERE r.chrom = ct.chrom AND r.pos BETWEEN ct.pos AND ct.pos + CASE WHEN ev = 'D3' THEN 3 ELSE 0 END) AS ref FROM ct)
    SELECT chrom, pos, ref, CASE WHEN ev = 'D3' THEN left(ref, 1) ELSE concat(ref, ev) END AS alt, n FROM rr WHERE ev NOT LIKE '%N%'""",
)
def _(spark, sf_dir):
    blocks = ref_blocks(fx.refseq(spark, sf_dir))
    return cl.consensus_indels(_cigar_pileup(spark, sf_dir), blocks, min_count=2, min_fraction=0.02)


@query(
    "position_bases",
    "aligned refseq",
    _SHAPES
    + """ SELECT cp.chrom, CAST(gpos AS BIGINT) AS pos, count(*) FILTER (cp.base = 'A') AS a, count(*) FILTER (cp.base = 'C') AS c, count(*) FILTER (cp.base = 'G') AS g, count(*) FILTER (cp.base = 'T') AS t,
      bool_or(is_del OR next_ins IS NOT NULL OR next_del IS NOT NULL) AS has_indel, count(*) FILTER (NOT is_del AND cp.base IS DISTINCT FROM r.base) > 0 AS has_mismatch,
      count(*) FILTER (NOT is_del) = 0 AS only_deletion FROM cp LEFT JOIN refseq r ON r.chrom = cp.chrom AND r.pos = gpos GROUP BY ALL""",
)
def _(spark, sf_dir):
    return cl.position_bases(_cigar_pileup(spark, sf_dir), fx.refseq(spark, sf_dir))


# one row per step: copies from the frequency that the step before gives
_EM = """/* recursive */ , st AS (SELECT chrom, pos, alt, 2.0 * count(*) AS n FROM t3 GROUP BY ALL),
  wt AS (SELECT chrom, pos, alt, pow(10, rr - greatest(rr, ra, aa)) AS w0, 2 * pow(10, ra - greatest(rr, ra, aa)) AS w1, pow(10, aa - greatest(rr, ra, aa)) AS w2 FROM t3),
  em AS (SELECT 0 AS k, chrom, pos, alt, n, CAST(0 AS DOUBLE) AS c FROM st UNION ALL
    SELECT k + 1, chrom, pos, alt, n, sum((w1 * f * (1 - f) + 2 * w2 * f * f) / (w0 * (1 - f) * (1 - f) + w1 * f * (1 - f) + w2 * f * f))
    FROM (SELECT *, (c + 0.01) / (n + 10.01) AS f FROM em WHERE k < 20) e JOIN wt USING (chrom, pos, alt) GROUP BY k, chrom, pos, alt, n),
  fr AS (SELECT *, (c + 0.01) / (n + 10.01) AS f FROM em WHERE k = 20)
  SELECT chrom, pos, alt, CAST(n / 2 AS INT) AS samples, round(c, 6) AS alt_copies, round(sum(log10(w0 * (1 - f) * (1 - f) / (w0 * (1 - f) * (1 - f) + w1 * f * (1 - f) + w2 * f * f))), 6) AS log10_no_variant
  FROM fr JOIN wt USING (chrom, pos, alt) GROUP BY chrom, pos, alt, n, c"""


@query("allele_frequency_em", "pileup refseq clean", _ALTS + ", " + _CALLS.format(sites="ca", emit="TRUE") + _EM)
def _(spark, sf_dir):
    r = fx.refseq(spark, sf_dir)
    g = cl.genotype_likelihoods(clean_pileup(spark, sf_dir), min_depth=2)
    s = cl.choose_alts(g, r).select("chrom", "pos", "ref", F.explode("alts").alias("alt"))
    j = g.join(s, ["chrom", "pos"])
    three = j.select(
        "chrom", "pos", "alt", "sample",
        cl._pick(F.col("ref"), F.col("ref")).alias("rr"), cl._pick(F.col("ref"), F.col("alt")).alias("ra"), cl._pick(F.col("alt"), F.col("alt")).alias("aa"),
    )
    out = cl.allele_frequency_em(three)
    return out.withColumns({c: F.round(c, 6) for c in ("alt_copies", "log10_no_variant")})

"""Variant-score recalibration queries.

Scores of the SQL-checked queries come from the part table; fitting a mixture model has no SQL form.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from locuswise.operators import mixture as mx
from locuswise.operators import vqsr as vq
from locuswise.plans import fixtures as fx
from locuswise.plans.registry import query

_FEAT = """ft AS (SELECT *, CASE WHEN size % 9 <> 4 THEN qual / 100.0 END AS f0, CAST(size AS DOUBLE) AS f1, CAST(pos % 101 AS DOUBLE) AS f2, pos % 3 = 0 AS tr FROM sites),
  ms AS (SELECT avg(f0) AS m0, stddev_pop(f0) AS s0, avg(f1) AS m1, stddev_pop(f1) AS s1, avg(f2) AS m2, stddev_pop(f2) AS s2 FROM ft WHERE tr)"""
NAMES = ["QD", "SIZE", "PLACE"]
_U = "((CAST(concat('0x', substr(md5(concat_ws('|', chrom, CAST(pos AS VARCHAR), 'QD')), {}, 8)) AS BIGINT) + 1) / (4294967296.0 + 1))"


def featured(spark, sf_dir):
    s = fx.sites(spark, sf_dir).selectExpr(
        "*", "CASE WHEN size % 9 <> 4 THEN qual / 100.0 END AS QD", "CAST(size AS DOUBLE) AS SIZE_", "CAST(pos % 101 AS DOUBLE) AS PLACE", "pos % 3 = 0 AS at_training",
    )
    return vq.vqsr_features(s.withColumnRenamed("SIZE_", "F_SIZE"), ["QD", "F_SIZE", "PLACE"])


@query(
    "vqsr_normalise",
    "sites",
    _FEAT
    + f""", z AS (SELECT chrom, pos, CASE WHEN f0 IS NULL THEN 0.1 * sqrt(-2 * ln({_U.format(1)})) * cos({2 * math.pi!r} * {_U.format(9)}) ELSE (f0 - m0) / s0 END AS z0, (f1 - m1) / s1 AS z1, (f2 - m2) / s2 AS z2 FROM ft, ms)
    SELECT chrom, pos, round(z0, 6) AS z0, round(z1, 6) AS z1, round(z2, 6) AS z2, greatest(abs(z0), abs(z1), abs(z2)) > 10 AS failing_sd FROM z""",
)
def _(spark, sf_dir):
    n = vq.vqsr_normalise(featured(spark, sf_dir), NAMES)
    return n.select("chrom", "pos", *[F.round(F.get("features", F.lit(i)), 6).alias(f"z{i}") for i in range(3)], "failing_sd")


_RES = """rs AS (SELECT chrom, pos, ref, alt1, alt2, filter <> 'PASS' AS flt, size % 2 = 0 AS known, size % 3 = 0 AS truth, size % 3 <> 1 AS training, size % 17 = 0 AS an, CAST(size % 20 AS DOUBLE) AS prior FROM sites WHERE size % 5 <> 2
   UNION ALL SELECT chrom, pos, ref, alt1, NULL, FALSE, TRUE, FALSE, FALSE, FALSE, 3.5 FROM sites WHERE size % 4 = 1)"""


def resources(spark, sf_dir):
    s = fx.sites(spark, sf_dir)
    a = s.filter("size % 5 <> 2").selectExpr(
        "chrom", "pos", "ref", "alts", "is_filtered", "size % 2 = 0 AS known", "size % 3 = 0 AS truth", "size % 3 <> 1 AS training", "size % 17 = 0 AS anti", "CAST(size % 20 AS DOUBLE) AS prior"
    )
    b = s.filter("size % 4 = 1").selectExpr(
        "chrom", "pos", "ref", "array(alts[0]) AS alts", "false AS is_filtered", "true AS known", "false AS truth", "false AS training", "false AS anti", "CAST(3.5 AS DOUBLE) AS prior"
    )
    return a.unionByName(b)


def _small(ref, a1, a2):
    return f"length({ref}) = length({a1}) AND ({a2} IS NULL OR length({ref}) = length({a2}))"


@query(
    "label_training_sites",
    "sites",
    _RES
    + f""", j AS (SELECT s.chrom, s.pos, bool_or(known) AS known, bool_or(truth) AS truth, bool_or(training) AS training, bool_or(an) AS an, max(prior) AS prior
      FROM sites s LEFT JOIN rs r ON r.chrom = s.chrom AND r.pos = s.pos AND NOT flt AND ({_small('s.ref', 's.alt1', 's.alt2')}) = ({_small('r.ref', 'r.alt1', 'r.alt2')}) GROUP BY ALL)
    SELECT chrom, pos, coalesce(known, FALSE) AS is_known, coalesce(truth, FALSE) AS at_truth, coalesce(training, FALSE) AS at_training, coalesce(an, FALSE) AS at_anti, greatest(2.0, coalesce(prior, 2.0)) AS prior FROM j""",
)
def _(spark, sf_dir):
    s = fx.sites(spark, sf_dir).select("chrom", "pos", "ref", "alts")
    return vq.label_training_sites(s, resources(spark, sf_dir)).drop("ref", "alts")


_SCORED = """sc AS (SELECT chrom, pos, (CAST((pos * 37 + size * 11) % 1300 AS DOUBLE) / 100.0 - 5.0) AS lod, size % 2 = 0 AS is_known, size % 4 = 0 AS at_truth, length(ref) = 1 AND length(alt1) = 1 AS is_snp, concat(ref, alt1) IN ('AG','GA','CT','TC') AS ti FROM sites)"""


def scored(spark, sf_dir):
    return fx.sites(spark, sf_dir).selectExpr(
        "*", "(CAST((pos * 37 + size * 11) % 1300 AS DOUBLE) / 100.0 - 5.0) AS lod", "size % 2 = 0 AS is_known", "size % 4 = 0 AS at_truth", "length(ref) = 1 AND length(alts[0]) = 1 AS is_snp",
        "concat(ref, alts[0]) IN ('AG','GA','CT','TC') AS is_transition",
    )


LEVELS = [50.0, 90.0, 99.0, 99.9, 100.0]
_ROWS = """st AS (SELECT level, previous, min_lod, count(*) FILTER (is_known) AS num_known, count(*) FILTER (NOT is_known) AS num_novel,
    round(count(*) FILTER (is_known AND is_snp AND ti) / greatest(count(*) FILTER (is_known AND is_snp AND NOT ti), 1), 6) AS known_titv, round(count(*) FILTER (NOT is_known AND is_snp AND ti) / greatest(count(*) FILTER (NOT is_known AND is_snp AND NOT ti), 1), 6) AS novel_titv,
    (SELECT count(*) FROM sc WHERE at_truth) AS truth_sites, count(*) FILTER (at_truth) AS called_truth FROM tl JOIN sc ON lod >= min_lod GROUP BY ALL)
  SELECT level, min_lod, num_known, num_novel, known_titv, novel_titv, truth_sites, called_truth, printf('VQSRTrancheSNP%.2fto%.2f', previous, level) AS name FROM st"""


def _lv(levels):
    return "lv(level, previous) AS (VALUES " + ", ".join(f"(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for a, b in zip(levels, [0.0, *levels[:-1]])) + ")"


@query(
    "tranches",
    "sites",
    _SCORED
    + ", "
    + _lv(LEVELS)
    + """, cu AS (SELECT lod, sum(t) OVER (ORDER BY lod DESC) AS truth FROM (SELECT lod, count(*) FILTER (at_truth) AS t FROM sc GROUP BY lod)),
    tl AS (SELECT level, previous, min(lod) AS min_lod FROM lv JOIN cu ON truth <= (SELECT count(*) FROM sc WHERE at_truth) * level / 100.0 + 1e-9 GROUP BY ALL), """
    + _ROWS,
)
def _(spark, sf_dir):
    t = vq.find_tranches(scored(spark, sf_dir), LEVELS)
    return t.withColumns({c: F.round(c, 6) for c in ("known_titv", "novel_titv")})


@query(
    "vqslod_tranches",
    "sites",
    _SCORED + ", " + _lv([-3.0, 0.0, 2.0]) + ", tl AS (SELECT level, previous, min(lod) AS min_lod FROM lv JOIN sc ON lod >= level GROUP BY ALL), " + _ROWS,
)
def _(spark, sf_dir):
    t = vq.find_vqslod_tranches(scored(spark, sf_dir), [-3.0, 0.0, 2.0])
    return t.withColumns({c: F.round(c, 6) for c in ("known_titv", "novel_titv")})


_TR = [(90.0, 2.0, "VQSRTrancheSNP0.00to90.00"), (99.0, -1.0, "VQSRTrancheSNP90.00to99.00"), (99.9, -3.5, "VQSRTrancheSNP99.00to99.90")]
_IS_SNP = "length(ref) = length(alt1) AND (alt2 IS NULL OR length(ref) = length(alt2))"


@query(
    "apply_vqsr",
    "sites",
    f"""v AS (SELECT s.*, {_IS_SNP} AND filter = 'PASS' AS own, (CAST((pos * 37 + size * 11) % 1300 AS DOUBLE) / 100.0 - 5.0) AS lod FROM sites s)
    SELECT chrom, pos, CASE WHEN own THEN lod END AS "VQSLOD", CASE WHEN own THEN CASE WHEN size % 2 = 0 THEN 'QD' ELSE 'FS' END END AS culprit, own AND size % 3 = 0 AS "POSITIVE_TRAIN_SITE", own AND size % 17 = 0 AS "NEGATIVE_TRAIN_SITE",
      CASE WHEN own THEN CASE WHEN lod >= -1.0 THEN 'PASS' WHEN lod >= -3.5 THEN 'VQSRTrancheSNP99.00to99.90' ELSE 'VQSRTrancheSNP99.00to99.90+' END WHEN filter = 'PASS' THEN '' ELSE filter END AS filters FROM v""",
)
def _(spark, sf_dir):
    s = scored(spark, sf_dir)
    recal = s.selectExpr("chrom", "pos", "end", "lod", "CASE WHEN size % 2 = 0 THEN 'QD' ELSE 'FS' END AS culprit", "size % 3 = 0 AS at_training", "size % 17 = 0 AS at_anti")
    out = vq.apply_vqsr(s, recal, _TR, level=99.0)
    return out.select("chrom", "pos", "VQSLOD", "culprit", "POSITIVE_TRAIN_SITE", "NEGATIVE_TRAIN_SITE", F.array_join("filters", ";").alias("filters"))


@query(
    "apply_vqsr_alleles",
    "sites",
    """a AS (SELECT chrom, pos, CASE WHEN size % 6 <> 0 THEN (CAST((pos * 37 + size * 11) % 1300 AS DOUBLE) / 100.0 - 5.0) END AS l1, CASE WHEN alt2 IS NOT NULL THEN (CAST((pos * 41 + size * 3) % 1700 AS DOUBLE) / 100.0 - 7.0) END AS l2, alt2 IS NOT NULL AS two FROM sites),
    b AS (SELECT *, CASE WHEN l1 IS NULL THEN 'NA' WHEN l1 < 0 THEN 'LOW_VQSLOD' ELSE 'PASS' END AS x1, CASE WHEN l2 IS NULL THEN 'NA' WHEN l2 < 0 THEN 'LOW_VQSLOD' ELSE 'PASS' END AS x2 FROM a)
    SELECT chrom, pos, concat(coalesce(printf('%.4f', l1), 'NaN'), CASE WHEN two THEN concat(',', printf('%.4f', l2)) ELSE '' END) AS "AS_VQSLOD", concat(x1, CASE WHEN two THEN concat(',', x2) ELSE '' END) AS "AS_FilterStatus",
      CASE WHEN two AND (l1 IS NULL OR l2 > l1) THEN x2 ELSE x1 END AS filters FROM b""",
)
def _(spark, sf_dir):
    s = scored(spark, sf_dir)
    one = s.filter("size % 6 <> 0").selectExpr("chrom", "pos", "alts[0] AS alt", "lod", "'QD' AS culprit")
    two = s.filter("size(alts) > 1").selectExpr("chrom", "pos", "alts[1] AS alt", "(CAST((pos * 41 + size * 3) % 1700 AS DOUBLE) / 100.0 - 7.0) AS lod", "'FS' AS culprit")
    out = vq.apply_vqsr_alleles(s, one.unionByName(two))
    return out.select("chrom", "pos", "AS_VQSLOD", "AS_FilterStatus", F.array_join("filters", ";").alias("filters"))


@query("worst_variants", "sites", _SCORED + " SELECT chrom, pos, lod FROM sc WHERE lod < -4")
def _(spark, sf_dir):
    return vq.worst_variants(scored(spark, sf_dir).withColumn("failing_sd", F.lit(False)), -4.0).select("chrom", "pos", "lod")


@query(
    "sample_training",
    "sites",
    "SELECT chrom, pos FROM sites WHERE pos % 3 = 0 ORDER BY md5(concat_ws('|', chrom, CAST(pos AS VARCHAR), ref, '0')), chrom, pos, ref LIMIT 300",
)
def _(spark, sf_dir):
    s = fx.sites(spark, sf_dir).selectExpr("chrom", "pos", "ref", "pos % 3 = 0 AS at_training", "false AS failing_sd")
    return vq.sample_training(s, 300).select("chrom", "pos")


def normalised(spark, sf_dir):
    return vq.vqsr_normalise(featured(spark, sf_dir), NAMES).withColumn("prior", F.col("size") % 20 + 1.0).withColumn("at_anti", F.lit(False))


def fitted(spark, sf_dir):
    """Both models with the largest numbers of components of the feature set, each fitted until its weights settle."""
    n = normalised(spark, sf_dir)
    good = vq.fit_vqsr(vq.sample_training(n), k=vq.MAX_GAUSSIANS)
    bad = vq.fit_vqsr(vq.worst_variants(vq.score_positive(n, good), -1.5), k=vq.MAX_GAUSSIANS_NEGATIVE)
    return n, good, bad


# Two models whose densities SQL can follow.
_GOOD = [(0.55, [0.1, -0.2, 0.3], [[1.1, 0.2, 0.1], [0.2, 0.9, -0.1], [0.1, -0.1, 1.3]]), (0.45, [-0.6, 0.5, -0.4], [[0.7, -0.1, 0.2], [-0.1, 1.2, 0.1], [0.2, 0.1, 0.8]])]
_BAD = [(1.0, [1.2, 0.8, -0.9], [[2.0, 0.3, 0.2], [0.3, 1.7, 0.4], [0.2, 0.4, 2.2]])]
_Z = _FEAT + f""", z AS (SELECT chrom, pos, size, tr, f0 IS NULL AS gone, CASE WHEN f0 IS NULL THEN 0.1 * sqrt(-2 * ln({_U.format(1)})) * cos({2 * math.pi!r} * {_U.format(9)}) ELSE (f0 - m0) / s0 END AS z0, (f1 - m1) / s1 AS z1, (f2 - m2) / s2 AS z2 FROM ft, ms)"""


def _quadratic(mean, cov, dims):
    """SQL of the squared distance over some dimensions, and the matching determinant."""
    c = np.array(cov)[np.ix_(dims, dims)]
    inv = np.linalg.inv(c)
    terms = [f"({inv[a, b]!r}) * (z{i} - ({mean[i]!r})) * (z{j} - ({mean[j]!r}))" for a, i in enumerate(dims) for b, j in enumerate(dims)]
    return " + ".join(terms).replace("np.float64(", "(").replace("))", "))"), float(np.linalg.det(c))


def _density(params, dims):
    parts = []
    for w, mean, cov in params:
        quad, det = _quadratic(mean, cov, dims)
        parts.append(f"{w / math.sqrt((2 * math.pi) ** len(dims) * det)!r} * exp(-0.5 * ({quad}))")
    return "log10(" + " + ".join(parts) + ")"


def _of(params):
    return f"CASE WHEN gone THEN {_density(params, [1, 2])} ELSE {_density(params, [0, 1, 2])} END"


@query(
    "vqsr_score",
    "sites",
    _Z
    + f""", d AS (SELECT *, {_of(_GOOD)} AS g, {_of(_BAD)} AS b, {", ".join(f"{_density(_GOOD, [i])} - {_density(_BAD, [i])} AS r{i}" for i in range(3))} FROM z),
    o AS (SELECT *, log10(1 - pow(10, -(size % 20 + 1) / 10.0)) - log10(pow(10, -(size % 20 + 1) / 10.0)) AS odds FROM d)
    SELECT chrom, pos, round(g, 6) AS positive, round(odds + g - b, 6) AS lod, list_sort(list_filter([CASE WHEN NOT gone THEN {{'r': r0, 'n': 'QD'}} END, {{'r': r1, 'n': 'SIZE'}}, {{'r': r2, 'n': 'PLACE'}}], lambda x: x IS NOT NULL))[1].n AS culprit FROM o""",
)
def _(spark, sf_dir):
    n = vq.score_positive(normalised(spark, sf_dir), _GOOD).withColumnRenamed("lod", "positive")
    out = vq.culprit(vq.score_vqsr(n, _GOOD, _BAD), _GOOD, _BAD, NAMES)
    return out.select("chrom", "pos", F.round("positive", 6).alias("positive"), F.round("lod", 6).alias("lod"), "culprit")


_STEP = mx.Posterior(np.array([60.0, 35.0]), np.array([41.0, 16.0]), np.array([40.001, 15.001]), np.array([[0.1, -0.2, 0.3], [-0.6, 0.5, -0.4]]), np.array([_GOOD[0][2], _GOOD[1][2]]) * 40)


def _log_share(k):
    quad, _ = _quadratic(_STEP.means[k].tolist(), _STEP.scales[k], [0, 1, 2])
    x = np.zeros((1, 3)) + _STEP.means
    head = math.log(mx.responsibilities(x[k : k + 1], _STEP)[0, k])
    other = 1 - k
    oq = (x[k] - _STEP.means[other]) @ np.linalg.inv(_STEP.scales[other]) @ (x[k] - _STEP.means[other])
    return quad, head, float(oq)


def _step_sql():
    """Shares of two components as a logistic function of the difference of their quadratic forms; its constant is read off at one mean."""
    (q0, head, far), (q1, _, _) = _log_share(0), _log_share(1)
    # log(p0 / p1) at mean 0 is head - log(1 - e^head) = c + counts1 / 2 * far
    c = head - math.log1p(-math.exp(head)) - 0.5 * float(_STEP.counts[1]) * far
    return f"1 / (1 + exp(-({c!r} - 0.5 * {float(_STEP.counts[0])!r} * ({q0}) + 0.5 * {float(_STEP.counts[1])!r} * ({q1}))))"


@query(
    "mixture_moments",
    "sites",
    _Z
    + f""", s AS (SELECT z0, z1, z2, {_step_sql()} AS p FROM z WHERE tr),
    t AS (SELECT 0 AS component, p, z0, z1, z2 FROM s UNION ALL SELECT 1, 1 - p, z0, z1, z2 FROM s)
    """
    + " UNION ALL ".join(
        f"SELECT component, {i} AS i, {j} AS j, round(sum(p{'' if i < 0 else f' * z{i}'}{'' if j < 0 else f' * z{j}'}), 5) AS value FROM t GROUP BY component"
        for i, j in [(-1, -1), *((i, -1) for i in range(3)), *((i, j) for i in range(3) for j in range(i, 3))]
    ),
)
def _(spark, sf_dir):
    rows = normalised(spark, sf_dir).filter("at_training")
    return mx.moments(rows, lambda x: mx.responsibilities(x, _STEP)).withColumn("value", F.round("value", 5))


@query("vqsr_fit_score")
def _(spark, sf_dir):
    n, good, bad = fitted(spark, sf_dir)
    out = vq.culprit(vq.score_vqsr(n, good, bad), good, bad, NAMES)
    return out.select("chrom", "pos", F.round("lod", 4).alias("lod"), "culprit")


@query("vqsr_model_report")
def _(spark, sf_dir):
    _, good, _ = fitted(spark, sf_dir)
    return vq.vqsr_model_report(spark, good, NAMES)

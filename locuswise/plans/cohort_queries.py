"""Cohort queries on per-sample records with reference blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from locuswise.operators import cohort as co
from locuswise.plans import fixtures as fx
from locuswise.plans.registry import query

# per-sample records: variants with one or two alternates plus NON_REF, and reference blocks that reach into later loci
fx.SQL["gv"] = """SELECT sample, chrom, pos AS "start", CASE WHEN a2 > 0 THEN pos + length(ref) - 1 + CASE WHEN length(ref) > 1 THEN 5 ELSE 0 END ELSE pos + 13 END AS "end",
  CASE WHEN a2 > 0 THEN ref ELSE left(ref, 1) END AS ref, CASE WHEN a2 > 0 THEN list_filter([alt1, alt2, '<NON_REF>'], lambda x: x IS NOT NULL) ELSE ['<NON_REF>'] END AS alts,
  list_transform(range(CASE WHEN a2 <= 0 THEN 3 WHEN alt2 IS NULL THEN 6 ELSE 10 END), lambda i: CAST((i * 17 + gq * 3 + dp) % 60 AS INT)) AS pl,
  CASE WHEN a2 > 0 THEN dp END AS dp, CASE WHEN a2 <= 0 THEN dp % 20 END AS min_dp, CASE WHEN a2 > 0 THEN rsid END AS id, CAST(gq % 3 * 20 AS INT) AS gq_band FROM cohort"""


def gvcf(spark, sf_dir):
    return fx.cohort(spark, sf_dir).selectExpr(
        "sample", "chrom", "pos AS start",
        "CASE WHEN gt[1] > 0 THEN pos + length(ref) - 1 + CASE WHEN length(ref) > 1 THEN 5 ELSE 0 END ELSE pos + 13 END AS end",
        "CASE WHEN gt[1] > 0 THEN ref ELSE left(ref, 1) END AS ref",
        "CASE WHEN gt[1] > 0 THEN concat(alts, array('<NON_REF>')) ELSE array('<NON_REF>') END AS alts",
        """transform(sequence(0, CASE WHEN gt[1] <= 0 THEN 2 WHEN size(alts) = 1 THEN 5 ELSE 9 END), i -> CAST((i * 17 + gq * 3 + dp) % 60 AS INT)) AS pl""",
        "CASE WHEN gt[1] > 0 THEN dp END AS dp", "CASE WHEN gt[1] <= 0 THEN dp % 20 END AS min_dp", "CASE WHEN gt[1] > 0 THEN id END AS id",
        "CAST(gq % 3 * 20 AS INT) AS gq_band",
    )


_AT = """lo AS (SELECT DISTINCT chrom, "start" AS pos FROM gv WHERE len(alts) > 1),
  rt AS (SELECT g.*, lo.pos FROM lo JOIN gv g ON g.chrom = lo.chrom AND g."start" <= lo.pos AND g."end" >= lo.pos QUALIFY row_number() OVER (PARTITION BY g.chrom, lo.pos, sample ORDER BY g."start" DESC, g."end" DESC) = 1),
  st AS (SELECT chrom, pos, arg_max(ref, length(ref)) FILTER ("start" = pos) AS mref, bool_or("start" <> pos AND len(alts) > 1) AS span, CAST(sum(coalesce(dp, min_dp, 0)) AS BIGINT) AS dp, count(*) AS samples,
     coalesce(string_agg(DISTINCT id, ',' ORDER BY id) FILTER ("start" = pos), '') AS id FROM rt GROUP BY ALL),
  al AS (SELECT DISTINCT chrom, pos, concat(a, substr(mref, length(ref) + 1)) AS alt FROM (SELECT chrom, pos, ref, unnest(alts) AS a FROM rt WHERE "start" = pos) JOIN st USING (chrom, pos) WHERE a <> '<NON_REF>'),
  ml AS (SELECT chrom, pos, mref AS ref, list_concat(list_concat(list(alt ORDER BY alt), CASE WHEN any_value(span) THEN ['*'] ELSE [] END), ['<NON_REF>']) AS alts, any_value(dp) AS dp, any_value(id) AS id, any_value(samples) AS samples
     FROM st JOIN al USING (chrom, pos) GROUP BY ALL)"""


def at(spark, sf_dir):
    g = gvcf(spark, sf_dir)
    return co.records_at(g, co.variant_loci(g))


_SHOW = " SELECT chrom, pos, ref, array_to_string(alts, ',') AS alts, dp, id, samples FROM ml"


@query("merge_gvcf", "gv", _AT + _SHOW)
def _(spark, sf_dir):
    return co.merge_sites(at(spark, sf_dir)).withColumn("alts", F.array_join("alts", ","))


# INFO of the records: a number each, a number on some, text, and a key that is computed again
_INFO = {"MQ": "CAST({pl} % 40 AS {s}) || '.5'", "RPS": "CASE WHEN coalesce(dp, min_dp) % 3 > 0 THEN CAST(coalesce(dp, min_dp) - 20 AS {s}) END", "NOTE": "CASE WHEN gq_band = 0 THEN 'low' ELSE CAST(gq_band AS {s}) END", "AC": "'1'"}
_INFO_SQL = (
    _AT
    + """, iv AS (SELECT chrom, pos, unnest(['MQ', 'RPS', 'NOTE']) AS k, TRY_CAST(unnest(["""
    + ", ".join(_INFO[k].format(pl="pl[2]", s="VARCHAR") for k in ("MQ", "RPS", "NOTE"))
    + """]) AS DOUBLE) AS v FROM rt WHERE "start" = pos),
  ir AS (SELECT *, row_number() OVER (PARTITION BY chrom, pos, k ORDER BY v) AS r, count(*) OVER (PARTITION BY chrom, pos, k) AS n FROM iv WHERE v IS NOT NULL),
  im AS (SELECT chrom, pos, max(v) FILTER (k = 'MQ') AS mq, max(v) FILTER (k = 'RPS') AS rps, max(v) FILTER (k = 'NOTE') AS note, count(*) AS n_keys FROM ir WHERE r = n // 2 + 1 GROUP BY ALL)
  SELECT chrom, pos, ref, array_to_string(alts, ',') AS alts, dp, id, samples, mq, rps, note, CAST(coalesce(n_keys, 0) AS INT) AS n_keys FROM ml LEFT JOIN im USING (chrom, pos)"""
)


def _with_info(merge):
    def build(spark, sf_dir):
        pairs = ", ".join(f"'{k}', {v.format(pl='pl[1]', s='STRING')}" for k, v in _INFO.items())
        m = merge(at(spark, sf_dir).withColumn("info", F.expr(f"map_filter(map({pairs}), (k, v) -> v IS NOT NULL)")))
        keys = [F.try_element_at("info", F.lit(k)).alias(k.lower()) for k in ("MQ", "RPS", "NOTE")]
        return m.select("chrom", "pos", "ref", F.array_join("alts", ",").alias("alts"), "dp", "id", "samples", *keys, F.coalesce(F.size(F.map_keys("info")), F.lit(0)).alias("n_keys"))

    return build


query("merge_gvcf_info", "gv", _INFO_SQL)(_with_info(lambda d: co.merge_sites(d, info="info")))
query("merge_gvcf_info_two_level", "gv", _INFO_SQL)(_with_info(lambda d: co.merge_sites_two_level(d, 4, info="info")))


@query("merge_gvcf_two_level", "gv", _AT + _SHOW)
def _(spark, sf_dir):
    return co.merge_sites_two_level(at(spark, sf_dir), 4).withColumn("alts", F.array_join("alts", ","))


@query(
    "remap_pl",
    "gv",
    _AT
    + """, ow AS (SELECT rt.chrom, rt.pos, sample, pl, ml.ref, list_concat([ml.ref], ml.alts) AS nw, list_concat([ml.ref], list_transform(rt.alts, lambda a: CASE WHEN a = '<NON_REF>' THEN a WHEN rt."start" = rt.pos THEN concat(a, substr(ml.ref, length(rt.ref) + 1)) ELSE '*' END)) AS od
       FROM rt JOIN ml ON ml.chrom = rt.chrom AND ml.pos = rt.pos),
    hx AS (SELECT *, unnest(range(len(nw))) AS hi FROM ow), px AS (SELECT *, unnest(range(hi + 1)) AS lo FROM hx),
    ix AS (SELECT *, coalesce(nullif(list_position(od, nw[hi + 1]), 0), list_position(od, '<NON_REF>')) - 1 AS p, coalesce(nullif(list_position(od, nw[lo + 1]), 0), list_position(od, '<NON_REF>')) - 1 AS q FROM px)
    SELECT chrom, pos, sample, string_agg(CAST(pl[greatest(p, q) * (greatest(p, q) + 1) // 2 + least(p, q) + 1] AS VARCHAR), ',' ORDER BY hi, lo) AS pl FROM ix GROUP BY ALL""",
)
def _(spark, sf_dir):
    a = at(spark, sf_dir)
    g = co.merge_genotypes(a, co.merge_sites(a))
    return g.select("chrom", "pos", "sample", F.array_join(F.transform("pl", lambda x: x.cast("string")), ",").alias("pl"))


@query(
    "merge_ref_blocks",
    "gv",
    """b AS (SELECT * FROM gv WHERE len(alts) = 1), c AS (SELECT chrom, "start" AS p FROM b UNION SELECT chrom, "end" + 1 FROM b),
    n AS (SELECT chrom, p AS s, lead(p) OVER (PARTITION BY chrom ORDER BY p) - 1 AS e FROM c)
    SELECT n.chrom, s AS "start", e AS "end", count(DISTINCT sample) AS samples, CAST(sum(min_dp) AS BIGINT) AS dp, min(gq_band) AS gq_band, './.' AS gt FROM n JOIN b ON b.chrom = n.chrom AND b."start" <= e AND b."end" >= s WHERE e IS NOT NULL GROUP BY ALL""",
)
def _(spark, sf_dir):
    return co.merge_ref_blocks(gvcf(spark, sf_dir).filter("size(alts) = 1"))


@query("joint_genotype")
def _(spark, sf_dir):
    a = at(spark, sf_dir)
    g = co.joint_genotype(co.merge_genotypes(a, co.merge_sites(a)), call=10.0)
    return co.trim_sites(g).select(
        "chrom", "pos", "ref", F.array_join("alts", ",").alias("alts"), F.round("qual", 4).alias("qual"), "dp",
        F.array_join(F.transform("ac", lambda x: x.cast("string")), ",").alias("ac"), "an", F.round("excess_het", 4).alias("excess_het"),
    )


@query(
    "cleanup_genotypes",
    "cohort",
    """SELECT chrom, pos, sample, CASE WHEN gq % 3 = 0 THEN dp % 7 ELSE dp END AS dp, CASE WHEN a1 > 0 AND a1 = a2 AND gq % 2 = 0 THEN '1|1' WHEN gq % 2 = 0 THEN '0|1' END AS pgt,
      CASE WHEN gq % 5 = 0 THEN concat_ws(',', CAST(CASE WHEN gq % 3 = 0 THEN dp % 7 ELSE dp END AS VARCHAR), '0', CASE WHEN alt2 IS NOT NULL THEN '0' END) ELSE concat_ws(',', CAST(ad0 AS VARCHAR), CAST(ad1 AS VARCHAR), CAST(ad2 AS VARCHAR)) END AS ad FROM cohort""",
)
def _(spark, sf_dir):
    c = fx.cohort(spark, sf_dir).selectExpr(
        "chrom", "pos", "sample", "alts", "gt", "gq", "dp", "CASE WHEN gq % 3 = 0 THEN dp % 7 END AS min_dp", "CASE WHEN gq % 5 <> 0 THEN ad END AS ad",
        "CASE WHEN gq % 2 = 0 THEN '0|1' END AS pgt", "array(0, 10, 20) AS pl",
    )
    out = co.cleanup_genotypes(c)
    return out.select("chrom", "pos", "sample", "dp", "pgt", F.array_join(F.transform("ad", lambda x: x.cast("string")), ",").alias("ad"))


@query(
    "cleanup_reference_genotypes",
    "cohort",
    """SELECT chrom, pos, sample, dp, gq AS rgq, CASE WHEN dp > 0 AND gq > 0 THEN '0/0' ELSE concat(CAST(a1 AS VARCHAR), '/', CAST(a2 AS VARCHAR)) END AS gt FROM cohort""",
)
def _(spark, sf_dir):
    c = fx.cohort(spark, sf_dir).selectExpr(
        "chrom", "pos", "sample", "alts", "gt", "gq", "dp", "CAST(NULL AS INT) AS min_dp", "ad", "CAST(NULL AS STRING) AS pgt", "array(0, 10, 20) AS pl"
    )
    return co.cleanup_genotypes(c, as_reference=True).select(
        "chrom", "pos", "sample", "dp", "rgq", F.array_join(F.transform("gt", lambda x: x.cast("string")), "/").alias("gt")
    )


@query(
    "balanced_ranges",
    "genotypes",
    """p AS (SELECT chrom, pos, count(*) AS n FROM genotypes GROUP BY ALL),
    c AS (SELECT *, sum(n) OVER (PARTITION BY chrom ORDER BY pos) AS upto, sum(n) OVER (PARTITION BY chrom) AS total FROM p)
    SELECT chrom, CAST(floor((upto - 1) * 8 / total) AS INT) AS range, min(pos) AS first, max(pos) AS last, CAST(sum(n) AS BIGINT) AS rows FROM c GROUP BY ALL""",
)
def _(spark, sf_dir):
    return co.balanced_ranges(fx.genotypes(spark, sf_dir), 8, keys=["chrom"], tile=256)

"""Structural-variant queries on read pairs and their mates."""

from __future__ import annotations

from pyspark.sql import functions as F

from locuswise.operators import sv
from locuswise.plans import fixtures as fx
from locuswise.plans.registry import query

_KIND = """CASE WHEN mate_chrom <> chrom THEN 'Diff' WHEN is_reverse = mate_reverse THEN 'FF_RR' WHEN pos < mate_pos THEN CASE WHEN is_reverse THEN 'RF' ELSE 'FR' END
   ELSE CASE WHEN is_reverse THEN 'FR' ELSE 'RF' END END"""
# both reads of a pair
_BOTH = """bo AS (SELECT * FROM pairs UNION ALL BY NAME SELECT read_name, library, mate_chrom AS chrom, mate_pos AS pos, chrom AS mate_chrom, pos AS mate_pos, mate_reverse AS is_reverse,
     is_reverse AS mate_reverse, is_proper, -insert_size AS insert_size, mapq, is_dup, read_len FROM pairs)"""
_CLASS = _BOTH + f""", cl AS (SELECT * FROM (SELECT *, {_KIND} AS pair_type FROM bo WHERE mapq > 30 AND NOT is_dup AND abs(insert_size) < 1000000) WHERE pair_type <> 'Diff')"""


def both_reads(spark, sf_dir):
    p = fx.pairs(spark, sf_dir)
    mate = p.selectExpr(
        "read_name", "library", "mate_chrom AS chrom", "mate_pos AS pos", "chrom AS mate_chrom", "pos AS mate_pos", "mate_reverse AS is_reverse",
        "is_reverse AS mate_reverse", "is_proper", "-insert_size AS insert_size", "mapq", "is_dup", "read_len",
    )
    return p.unionByName(mate)


def classified(spark, sf_dir):
    return sv.classify_pairs(both_reads(spark, sf_dir), min_mapq=30)


@query("classify_pairs", "pairs", _CLASS + " SELECT read_name, chrom, pos, insert_size, pair_type FROM cl")
def _(spark, sf_dir):
    return classified(spark, sf_dir).select("read_name", "chrom", "pos", "insert_size", "pair_type")


_MODEL = """h AS (SELECT insert_size AS x, count(*) AS n FROM bo WHERE is_proper AND insert_size BETWEEN 1 AND 2000 AND mapq >= 30 GROUP BY ALL),
  m0 AS (SELECT x AS mean FROM h ORDER BY n DESC, x LIMIT 1),
  m1 AS (SELECT mean, coalesce(sqrt(sum(pow(x - mean, 2) * n) FILTER (x < mean) / nullif(sum(n) FILTER (x < mean) - 1, 0)), 0) AS low_sd,
     coalesce(sqrt(sum(pow(x - mean, 2) * n) FILTER (x >= mean) / nullif(sum(n) FILTER (x >= mean) - 1, 0)), 0) AS up_sd FROM h, m0 GROUP BY mean),
  md AS (SELECT *, mean - 3 * low_sd AS lower, mean + 3 * up_sd AS upper FROM m1)"""


def model(spark, sf_dir):
    return sv.insert_size_model(both_reads(spark, sf_dir), min_mapq=30)


@query(
    "insert_size_model",
    "pairs",
    _BOTH + ", " + _MODEL + " SELECT mean, round(low_sd, 6) AS low_sd, round(up_sd, 6) AS up_sd, round(lower, 6) AS lower, round(upper, 6) AS upper FROM md",
)
def _(spark, sf_dir):
    return model(spark, sf_dir).withColumns({c: F.round(c, 6) for c in ("low_sd", "up_sd", "lower", "upper")})


_DISC = _CLASS + ", " + _MODEL + """, ty AS (SELECT cl.*, md.*, CASE pair_type WHEN 'FR' THEN CASE WHEN abs(insert_size) > upper THEN 'DEL' WHEN abs(insert_size) < lower THEN 'INS' END WHEN 'RF' THEN 'ITX' WHEN 'FF_RR' THEN 'INV' END AS sv_type FROM cl, md),
  ct AS (SELECT chrom, CAST(greatest(min(mean - 2 * read_len), 50) AS DOUBLE) AS d, max(pos + read_len - 1) - min(pos) + 1 AS ref_length, count(*) FILTER (pair_type = 'FR' AND sv_type IS NOT NULL) AS nindel FROM ty GROUP BY chrom),
  cd AS (SELECT chrom, ref_length, greatest(CASE WHEN nindel = 0 THEN d ELSE least(d, ref_length / nindel) END, 50.0) AS dist FROM ct),
  dr AS (SELECT ty.*, ref_length, dist FROM ty JOIN cd USING (chrom) WHERE sv_type IS NOT NULL),
  sp AS (SELECT chrom, pos, max(dist) AS dist, max(pos + read_len - 1) AS e, sum(read_len) AS b FROM dr GROUP BY ALL),
  lg AS (SELECT *, lag(pos) OVER (PARTITION BY chrom ORDER BY pos) AS pp FROM sp),
  ci AS (SELECT *, max(CASE WHEN pp IS NULL OR pos - pp > dist THEN pos END) OVER (PARTITION BY chrom ORDER BY pos) AS cluster FROM lg),
  cs AS (SELECT chrom, cluster, max(e) - min(pos) + 1 AS cluster_length, sum(b) AS b FROM ci GROUP BY ALL),
  gc AS (SELECT * FROM cs WHERE b / cluster_length > 0 AND b / cluster_length < 300 AND cluster_length > 40),
  cr AS (SELECT dr.*, cluster, cluster_length FROM dr JOIN ci USING (chrom, pos) JOIN gc USING (chrom, cluster))"""


def clustered(spark, sf_dir):
    d = sv.discordant_reads(classified(spark, sf_dir), model(spark, sf_dir))
    return sv.cluster_discordant(d, max_coverage=300, min_length=40, tile=256)


@query("cluster_discordant", "pairs", _DISC + " SELECT read_name, chrom, pos, sv_type, round(dist, 6) AS dist, cluster, cluster_length FROM cr")
def _(spark, sf_dir):
    return clustered(spark, sf_dir).select("read_name", "chrom", "pos", "sv_type", F.round("dist", 6).alias("dist"), "cluster", "cluster_length")


_LINK = _DISC + """, lk AS (SELECT read_name, min(row(chrom, cluster, cluster_length)) AS a, max(row(chrom, cluster, cluster_length)) AS b, min(row(sv_type, library, insert_size, mean, ref_length)) AS r
   FROM cr GROUP BY read_name HAVING count(DISTINCT row(chrom, cluster)) = 2)"""


@query("link_clusters", "pairs", _LINK + " SELECT read_name, a[1] AS chrom1, a[2] AS start1, b[1] AS chrom2, b[2] AS start2, r[1] AS sv_type FROM lk")
def _(spark, sf_dir):
    return sv.link_clusters(clustered(spark, sf_dir)).selectExpr(
        "read_name", "a.chrom AS chrom1", "a.cluster AS start1", "b.chrom AS chrom2", "b.cluster AS start2", "sv_type"
    )


_SUM = _LINK + """, l2 AS (SELECT a[1] AS chrom1, a[2] AS start1, a[3] AS length1, b[1] AS chrom2, b[2] AS start2, b[3] AS length2, r[1] AS sv_type, r[2] AS library, abs(r[3] - r[4]) AS sz, r[5] AS ref_length FROM lk),
  lt AS (SELECT chrom1, start1, length1, chrom2, start2, length2, sv_type, count(*) AS pairs, sum(sz) / count(*) AS size, max(ref_length) AS ref_length FROM l2 GROUP BY ALL),
  lb AS (SELECT * FROM lt QUALIFY row_number() OVER (PARTITION BY chrom1, start1, length1, chrom2, start2, length2 ORDER BY pairs DESC, sv_type) = 1),
  lf AS (SELECT * FROM lb WHERE pairs >= 2),
  ll AS (SELECT lf.*, library, n FROM lf JOIN (SELECT chrom1, start1, chrom2, start2, sv_type, library, count(*) AS n FROM l2 GROUP BY ALL) x USING (chrom1, start1, chrom2, start2, sv_type)),
  tm AS (SELECT *, (length1 + length2) * n / ref_length AS lam FROM ll),
  tk AS (SELECT *, unnest(range(n, CAST(n + ceil(lam) * 2 + 201 AS BIGINT))) AS k FROM tm),
  tp AS (SELECT *, k * ln(lam) - lam - CASE WHEN k = 0 THEN 0 ELSE k * ln(k) - k + 0.5 * ln(2 * pi() * k) END AS lp FROM tk),
  tq AS (SELECT *, max(lp) OVER w AS mx FROM tp WINDOW w AS (PARTITION BY chrom1, start1, chrom2, start2, library)),
  te AS (SELECT chrom1, start1, chrom2, start2, library, any_value(mx) + ln(sum(exp(lp - mx))) AS lt FROM tq GROUP BY ALL),
  tz AS (SELECT chrom1, start1, chrom2, start2, -10 * sum(lt) / ln(10) AS ph FROM te GROUP BY ALL)"""


@query(
    "sv_calls",
    "pairs",
    _SUM + """ SELECT chrom1, start1, length1, chrom2, start2, length2, sv_type, pairs, round(size, 6) AS size, CASE WHEN ph > 99 THEN 99 ELSE CAST(floor(ph + 0.5) AS INT) END AS score FROM lf JOIN tz USING (chrom1, start1, chrom2, start2)""",
)
def _(spark, sf_dir):
    links = sv.summarise_links(sv.link_clusters(clustered(spark, sf_dir)))
    return sv.sv_score(links).withColumn("size", F.round("size", 6)).drop("libraries", "ref_length")

"""Interval queries: joins, merges, tiles, segments, neighbours, set operations on intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from locuswise.operators import intervals as iv
from locuswise.operators import coverage as cov
from locuswise.plans import fixtures as fx
from locuswise.plans.registry import query

_R = """m AS (SELECT read_name, mate_no, chrom, pos AS "start", pos + read_len - 1 AS "end" FROM reads WHERE NOT is_unmapped)"""


def mapped(spark, sf_dir):
    return fx.reads(spark, sf_dir).filter("NOT is_unmapped").selectExpr(
        "read_name", "mate_no", "chrom", "pos AS start", "pos + read_len - 1 AS end"
    )


_ON = 'm.chrom = g.chrom AND m."start" <= g."end" AND m."end" >= g."start"'


@query(
    "interval_join_inner",
    "reads regions",
    _R + f"SELECT m.*, g.name FROM m JOIN regions g ON {_ON}",
)
def _(spark, sf_dir):
    g = fx.regions(spark, sf_dir)
    return iv.interval_join(mapped(spark, sf_dir), g, "inner", bin_size=128, salt=4).select(
        "read_name", "mate_no", "chrom", "start", "end", "name"
    )


@query("interval_join_left", "reads regions", _R + f"SELECT m.*, g.name FROM m LEFT JOIN regions g ON {_ON}")
def _(spark, sf_dir):
    g = fx.regions(spark, sf_dir)
    return iv.interval_join(mapped(spark, sf_dir), g, "left", bin_size=128).select(
        "read_name", "mate_no", "chrom", "start", "end", "name"
    )


@query("interval_join_semi", "reads regions", _R + f"SELECT m.* FROM m WHERE EXISTS (SELECT 1 FROM regions g WHERE {_ON})")
def _(spark, sf_dir):
    return iv.interval_join(mapped(spark, sf_dir), fx.regions(spark, sf_dir), "semi", bin_size=64, salt=4)


@query("interval_join_anti", "reads regions", _R + f"SELECT m.* FROM m WHERE NOT EXISTS (SELECT 1 FROM regions g WHERE {_ON})")
def _(spark, sf_dir):
    return iv.interval_join(mapped(spark, sf_dir), fx.regions(spark, sf_dir), "anti", bin_size=64)


_MERGE = """o AS (SELECT chrom, "start", "end", max("end") OVER (PARTITION BY chrom ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {src}),
    i AS (SELECT *, sum(CASE WHEN reach IS NULL OR "start" > reach + {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY "start", "end") AS isl FROM o)
    SELECT chrom, min("start") AS "start", max("end") AS "end", count(*) AS n FROM i GROUP BY chrom, isl"""


@query("merge_intervals", "regions", _MERGE.format(src="regions", gap=0))
def _(spark, sf_dir):
    return iv.merge_intervals(fx.regions(spark, sf_dir), tile=256)


@query(
    "merge_intervals_padded",
    "regions",
    """p AS (SELECT chrom, "start" - 15 AS "start", "end" + 15 AS "end" FROM regions), """ + _MERGE.format(src="p", gap=10),
)
def _(spark, sf_dir):
    return iv.merge_intervals(fx.regions(spark, sf_dir), gap=10, pad=15, tile=256)


@query(
    "assign_windows",
    "reads",
    """w AS (SELECT read_name, mate_no, chrom, pos, unnest(list_distinct([CAST(floor(pos / 1000) AS BIGINT), CAST(floor(greatest(pos - 100, 0) / 1000) AS BIGINT),
       CAST(floor((pos + 31 + 100) / 1000) AS BIGINT)])) AS "window" FROM reads WHERE NOT is_unmapped)
    SELECT read_name, mate_no, chrom, "window", "window" = CAST(floor(pos / 1000) AS BIGINT) AS is_owner FROM w""",
)
def _(spark, sf_dir):
    r = mapped(spark, sf_dir)
    return iv.assign_windows(r, 1000, 100, "start", "end").select("read_name", "mate_no", "chrom", "window", "is_owner")


@query(
    "explode_windows",
    "regions",
    """SELECT name, chrom, CAST(unnest(range(CAST(floor("start" / 64) AS BIGINT), CAST(floor("end" / 64) AS BIGINT) + 1)) AS BIGINT) AS "window" FROM regions""",
)
def _(spark, sf_dir):
    return iv.explode_windows(fx.regions(spark, sf_dir), 64).select("name", "chrom", "window")


_CONTIGS = "contigs AS (SELECT chrom, CAST(substr(chrom, 4) AS INT) AS idx, max(pos) + 31 AS length FROM reads WHERE NOT is_unmapped GROUP BY ALL)"


def contigs(spark, sf_dir):
    """Contig dictionary seen in the reads."""
    return (
        fx.reads(spark, sf_dir).filter("NOT is_unmapped").groupBy("chrom").agg((F.max("pos") + 31).alias("length"))
        .withColumn("idx", F.expr("CAST(substr(chrom, 4) AS INT)"))
    )


@query(
    "window_scaffold",
    "reads",
    _CONTIGS
    + """, t AS (SELECT chrom, length, unnest(range(CAST(floor((length - 1) / 500) AS BIGINT) + 1)) AS "window" FROM contigs)
    SELECT chrom, "window", "window" * 500 + 1 AS "start", least(("window" + 1) * 500, length) AS "end", sample FROM t, (SELECT DISTINCT sample FROM reads)""",
)
def _(spark, sf_dir):
    return iv.window_scaffold(contigs(spark, sf_dir), 500, fx.reads(spark, sf_dir).select("sample"))


@query(
    "segments",
    "regions",
    """c AS (SELECT chrom, "start" AS p FROM regions UNION SELECT chrom, "end" + 1 FROM regions),
    n AS (SELECT chrom, p, lead(p) OVER (PARTITION BY chrom ORDER BY p) AS nx FROM c)
    SELECT chrom, p AS "start", nx - 1 AS "end" FROM n WHERE nx IS NOT NULL""",
)
def _(spark, sf_dir):
    return iv.segments(fx.regions(spark, sf_dir))


@query(
    "interval_intersect",
    "reads regions",
    _R + f"""SELECT m.read_name, m.mate_no, m.chrom, greatest(m."start", g."start") AS "start", least(m."end", g."end") AS "end" FROM m JOIN regions g ON {_ON}""",
)
def _(spark, sf_dir):
    return iv.interval_intersect(mapped(spark, sf_dir), fx.regions(spark, sf_dir))


@query(
    "uncovered_runs",
    "reads refseq",
    """c AS (SELECT DISTINCT chrom, pos + i AS pos FROM reads, (SELECT unnest(range(32)) AS i) WHERE NOT is_unmapped),
    u AS (SELECT chrom, pos FROM refseq ANTI JOIN c USING (chrom, pos)),
    g AS (SELECT *, pos - row_number() OVER (PARTITION BY chrom ORDER BY pos) AS isl FROM u)
    SELECT chrom, min(pos) AS "start", max(pos) AS "end" FROM g GROUP BY chrom, isl""",
)
def _(spark, sf_dir):
    size = fx.refseq(spark, sf_dir).groupBy("chrom").agg(F.max("pos").alias("length"))
    return cov.gaps(mapped(spark, sf_dir), size)


@query(
    "uncovered_sites",
    "variants genotypes",
    """u AS (SELECT DISTINCT chrom, CAST((pos - 1) // 6 AS BIGINT) AS pos FROM variants ANTI JOIN (SELECT DISTINCT chrom, pos FROM genotypes WHERE dp > 30) USING (chrom, pos)),
    g AS (SELECT *, pos - row_number() OVER (PARTITION BY chrom ORDER BY pos) AS isl FROM u)
    SELECT chrom, min(pos) AS "start", max(pos) AS "end" FROM g GROUP BY chrom, isl""",
)
def _(spark, sf_dir):
    deep = fx.genotypes(spark, sf_dir).filter("dp > 30").selectExpr("chrom", "CAST((pos - 1) div 6 AS BIGINT) AS pos")
    sites = fx.variants(spark, sf_dir).selectExpr("chrom", "CAST((pos - 1) div 6 AS BIGINT) AS pos").distinct()
    return iv.uncovered_runs(deep, sites)


@query(
    "linear_coord",
    "reads",
    _CONTIGS + " SELECT chrom, idx, length, CAST(coalesce(sum(length) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM contigs",
)
def _(spark, sf_dir):
    return iv.linear_coord(contigs(spark, sf_dir))


@query(
    "closest_gene",
    "variants regions",
    """c AS (SELECT v.chrom, v.pos, v.ref, v.alt, g.name AS gene,
        CASE WHEN v.pos < g."start" THEN g."start" - v.pos WHEN v.pos > g."end" THEN v.pos - g."end" ELSE 0 END AS distance, is_minus
      FROM variants v LEFT JOIN regions g USING (chrom))
    SELECT chrom, pos, ref, alt, gene, distance FROM c
    QUALIFY row_number() OVER (PARTITION BY chrom, pos, ref, alt ORDER BY distance, NOT is_minus, gene) = 1""",
)
def _(spark, sf_dir):
    v = fx.variants(spark, sf_dir).select("chrom", "pos", "ref", "alt")
    return iv.closest_gene(v, fx.regions(spark, sf_dir), coding="is_minus", tile=512)

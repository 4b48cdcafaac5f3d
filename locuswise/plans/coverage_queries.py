"""Depth, coverage and quality-report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from locuswise.operators import coverage as cov
from locuswise.plans import fixtures as fx
from locuswise.plans.read_queries import with_duplicates
from locuswise.plans.registry import query


def spans(spark, sf_dir):
    """Mapped reads as ungapped spans with the duplicate flag."""
    return with_duplicates(spark, sf_dir).filter("NOT is_unmapped").withColumns(
        {"start": F.col("pos"), "end": F.col("pos") + F.col("read_len") - 1, "is_del": F.lit(False)}
    )


# SQL: one row per covered position with raw and duplicate-removed depth
_DEPTH = """pos_depth AS (SELECT chrom, pos + i AS pos, count(*) AS depth, count(*) FILTER (NOT is_duplicate) AS dedup,
    count(*) FILTER (mapq >= 20) AS mapq_depth, count(*) FILTER (mapq > 20 AND NOT is_duplicate) AS sex_depth
  FROM dups, (SELECT unnest(range(32)) AS i) WHERE NOT is_unmapped GROUP BY ALL)"""


@query(
    "depth",
    "dups",
    """SELECT sample, chrom, pos + i AS pos, count(*) AS depth, count(*) FILTER (NOT is_duplicate) AS dedup,
    count(*) FILTER (mapq >= 20) AS mapq_depth, count(*) FILTER (mapq > 20 AND NOT is_duplicate) AS sex_depth
  FROM dups, (SELECT unnest(range(32)) AS i) WHERE NOT is_unmapped GROUP BY ALL""",
)
def _(spark, sf_dir):
    seg = cov.standard_depth(spans(spark, sf_dir), ["sample", "chrom"])
    return cov.depth_positions(seg).select("sample", "chrom", "pos", "depth", "dedup", "mapq_depth", "sex_depth")


_SHAPES = """shapes(cigar, s, e, d) AS (VALUES ('2S30M',0,29,FALSE),('10M2I20M',0,9,FALSE),('10M2I20M',10,29,FALSE),('10M3D22M',0,9,FALSE),
  ('10M3D22M',10,12,TRUE),('10M3D22M',13,34,FALSE),('4D32M',0,3,TRUE),('4D32M',4,35,FALSE),('10M2I3D20M',0,9,FALSE),('10M2I3D20M',10,12,TRUE),
  ('10M2I3D20M',13,32,FALSE),('5H30M2S',0,29,FALSE),('10M5N22M',0,9,FALSE),('10M5N22M',15,36,FALSE),('32M',0,31,FALSE))"""


@query(
    "depth_cigar",
    "aligned",
    _SHAPES
    + """, p AS (SELECT chrom, unnest(range(pos + s, pos + e + 1)) AS pos, d FROM aligned JOIN shapes USING (cigar) WHERE pos IS NOT NULL)
    SELECT chrom, pos, count(*) FILTER (NOT d) AS depth, count(*) FILTER (d) AS deleted FROM p GROUP BY ALL""",
)
def _(spark, sf_dir):
    a = fx.aligned(spark, sf_dir).filter("pos IS NOT NULL").select("chrom", "pos", "cigar")
    seg = cov.depth_segments(
        cov.aligned_spans(a), ["chrom"], {"depth": ~F.col("is_del"), "deleted": F.col("is_del")}, tile=512
    )
    return cov.depth_positions(seg)


_RULES = {
    "covered": "depth > 0", "ge4": "dedup >= 4", "ge10": "dedup >= 10", "ge30": "dedup >= 30",
}
_REF_N = "refn AS (SELECT chrom, pos, CASE WHEN pos % 50 < 3 THEN 'N' ELSE base END AS base FROM refseq)"


def ref_with_n(spark, sf_dir):
    return fx.refseq(spark, sf_dir).selectExpr("chrom", "pos", "CASE WHEN pos % 50 < 3 THEN 'N' ELSE base END AS base")


@query(
    "coverage_report",
    "dups refseq",
    _DEPTH
    + ", "
    + _REF_N
    + """, c AS (SELECT chrom, count(*) AS length, count(*) FILTER (base <> 'N') AS known_length FROM refn GROUP BY chrom),
    d AS (SELECT p.*, base <> 'N' AS known FROM pos_depth p LEFT JOIN refn USING (chrom, pos)),
    s AS (SELECT chrom, """
    + ", ".join(f"count(*) FILTER ({r}) AS {n}, count(*) FILTER ({r} AND known) AS known_{n}" for n, r in _RULES.items())
    + """, CAST(sum(depth) AS BIGINT) AS depth_sum, CAST(sum(dedup) AS BIGINT) AS dedup_sum FROM d GROUP BY chrom),
    j AS (SELECT * FROM s JOIN c USING (chrom)),
    t AS (SELECT * FROM j UNION ALL BY NAME SELECT 'total' AS chrom, """
    + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in [*_RULES, *[f"known_{n}" for n in _RULES], "depth_sum", "dedup_sum", "length", "known_length"])
    + """ FROM j)
    SELECT *, round(depth_sum / covered, 6) AS mean_depth, round(dedup_sum / covered, 6) AS mean_dedup_depth, """
    + ", ".join(f"round(100.0 * {n} / length, 6) AS {n}_rate, round(100.0 * known_{n} / known_length, 6) AS known_{n}_rate" for n in _RULES)
    + " FROM t",
)
def _(spark, sf_dir):
    ref = ref_with_n(spark, sf_dir)
    seg = cov.standard_depth(spans(spark, sf_dir), ["chrom"])
    size = ref.groupBy("chrom").agg(F.count("*").alias("length"))
    out = cov.coverage_report(seg, size, cov.unknown_runs(ref))
    rounded = [c for c in out.columns if c.endswith("_rate") or c.startswith("mean")]
    return out.withColumns({c: F.round(c, 6) for c in rounded})


@query("depth_histogram", "dups", _DEPTH + " SELECT dedup AS depth, count(*) AS bases FROM pos_depth GROUP BY ALL")
def _(spark, sf_dir):
    seg = cov.depth_segments(
        spans(spark, sf_dir), ["chrom"], {"depth": ~F.col("is_del"), "dedup": ~F.col("is_duplicate")}
    )
    return cov.depth_histogram(seg)


@query(
    "insert_size_histogram",
    "aligned",
    """SELECT abs(insert_size) AS insert_size, count(*) AS pairs, count(*) FILTER ((flag & 1024) = 0) AS unique_pairs FROM aligned
    WHERE (flag & 64) <> 0 AND abs(insert_size) < 2000 GROUP BY ALL""",
)
def _(spark, sf_dir):
    from locuswise.functions.flags import has

    a = fx.aligned(spark, sf_dir).withColumns({"is_first": has(F.col("flag"), "first"), "is_duplicate": has(F.col("flag"), "duplicate")})
    return cov.insert_size_histogram(a)


@query(
    "read_metrics",
    "aligned dups pileup refseq",
    """mm AS (SELECT sample, read_name, mate_no, count(*) FILTER (p.base <> r.base) AS mismatches FROM pileup p JOIN refseq r USING (chrom, pos) GROUP BY ALL),
    x AS (SELECT a.sample, d.is_unmapped, a.mapq > 3 AS uniq, d.is_duplicate, (flag & 64) <> 0 AND (flag & 8) = 0 AS pe, cigar, coalesce(mismatches, 0) AS mm
      FROM aligned a JOIN dups d USING (sample, read_name, mate_no) LEFT JOIN mm USING (sample, read_name, mate_no)),
    s AS (SELECT sample, count(*) AS total, count(*) FILTER (NOT is_unmapped) AS mapped, count(*) FILTER (NOT is_unmapped AND uniq) AS "unique",
      count(*) FILTER (NOT is_unmapped AND is_duplicate) AS duplicate, count(*) FILTER (NOT is_unmapped AND pe) AS paired,
      count(*) FILTER (NOT is_unmapped AND (cigar LIKE '%S%' OR cigar LIKE '%H%')) AS clipped,
      count(*) FILTER (NOT is_unmapped AND (cigar LIKE '%I%' OR cigar LIKE '%D%')) AS indel, count(*) FILTER (NOT is_unmapped AND mm > 0) AS mismatch,
      CAST(count(*) FILTER (NOT is_unmapped) * 32 AS BIGINT) AS mapped_bases, CAST(sum(mm) AS BIGINT) AS mismatch_bases FROM x GROUP BY sample)
    SELECT *, """
    + ", ".join(
        f'round("{n}" * 100.0 / total, 6) AS {n}_rate' for n in ("mapped", "unique", "duplicate", "paired", "clipped", "indel", "mismatch")
    )
    + " FROM s",
)
def _(spark, sf_dir):
    from locuswise.functions.flags import has

    a = fx.aligned(spark, sf_dir).select(
        "sample", "read_name", "mate_no", "cigar", (F.col("mapq") > 3).alias("is_unique"),
        has(F.col("flag"), "first").alias("is_first"), has(F.col("flag"), "mate_unmapped").alias("mate_unmapped"),
    )
    d = with_duplicates(spark, sf_dir).select("sample", "read_name", "mate_no", "is_unmapped", "is_duplicate", "read_len")
    mm = cov.mismatch_counts(fx.reads(spark, sf_dir).filter("NOT is_unmapped"), fx.refseq(spark, sf_dir), ["sample"])
    key = ["sample", "read_name", "mate_no"]
    out = cov.basic_report(d.join(a, key).join(mm, key, "left"))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.endswith("_rate")})


_TARGET = """tpos AS (SELECT DISTINCT chrom, unnest(range("start", "end" + 1)) AS pos FROM regions),
    fpos AS (SELECT DISTINCT chrom, unnest(range("start" - 200, "end" + 201)) AS pos FROM regions)"""


@query(
    "target_report",
    "dups regions",
    _DEPTH
    + ", "
    + _TARGET
    + """, m AS (SELECT chrom, pos AS s, pos + 31 AS e, mapq > 3 AS u FROM dups WHERE NOT is_unmapped),
    rt AS (SELECT count(*) AS target_reads, count(*) FILTER (u) AS target_unique_reads FROM m WHERE EXISTS (SELECT 1 FROM regions g WHERE m.chrom = g.chrom AND s <= g."end" AND e >= g."start")),
    rf AS (SELECT count(*) AS flank_reads FROM m WHERE EXISTS (SELECT 1 FROM regions g WHERE m.chrom = g.chrom AND s <= g."end" + 200 AND e >= g."start" - 200)),
    rw AS (SELECT count(*) FILTER (u) AS unique_reads, CAST(count(*) * 32 AS BIGINT) AS mapped_bases FROM m),
    bt AS (SELECT """
    + ", ".join(f"count(*) FILTER ({d} >= {k}) AS target_{d}_ge{k}" for d in ("depth", "dedup") for k in cov.LEVELS)
    + """, CAST(sum(depth) AS BIGINT) AS target_depth_sum, CAST(sum(dedup) AS BIGINT) AS target_dedup_sum, CAST(0 AS BIGINT) AS x_depth_sum, CAST(0 AS BIGINT) AS y_depth_sum
      FROM pos_depth JOIN tpos USING (chrom, pos)),
    bf AS (SELECT CAST(sum(depth) AS BIGINT) AS flank_depth_sum FROM pos_depth JOIN fpos USING (chrom, pos)),
    sz AS (SELECT count(*) AS target_size FROM tpos)
    SELECT *, round(target_depth_sum / target_depth_ge1, 6) AS mean_target_depth, round(100.0 * target_depth_ge1 / target_size, 6) AS target_coverage,
      round(100.0 * target_unique_reads / unique_reads, 6) AS capture_specificity, round(100.0 * target_depth_sum / mapped_bases, 6) AS capture_efficiency
    FROM rt, rf, rw, bt, bf, sz""",
)
def _(spark, sf_dir):
    sp = spans(spark, sf_dir)
    reads = sp.select("chrom", "start", "end", (F.col("mapq") > 3).alias("is_unique"), "read_len")
    seg = cov.depth_segments(sp, ["chrom"], {"depth": ~F.col("is_del"), "dedup": ~F.col("is_duplicate")})
    out = cov.target_report(reads, seg, fx.regions(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_target_depth", "target_coverage", "capture_specificity", "capture_efficiency")})


_REGION_STATS = (
    _DEPTH
    + """, rp AS (SELECT name, chrom, "start", "end", "end" - "start" + 1 AS size, unnest(range("start", "end" + 1)) AS pos FROM regions),
    rd AS (SELECT rp.*, coalesce(depth, 0) AS depth, coalesce(dedup, 0) AS dedup FROM rp LEFT JOIN pos_depth USING (chrom, pos)),
    rs AS (SELECT name, chrom, "start", "end", size, count(*) FILTER (dedup > 0) AS covered, count(*) FILTER (dedup >= 4) AS ge4, count(*) FILTER (dedup >= 10) AS ge10,
      count(*) FILTER (dedup >= 30) AS ge30, CAST(coalesce(sum(depth) FILTER (dedup > 0), 0) AS BIGINT) AS depth_sum,
      CAST(coalesce(sum(dedup) FILTER (dedup > 0), 0) AS BIGINT) AS dedup_sum, median(depth) AS median_depth, median(dedup) AS median_dedup FROM rd GROUP BY ALL),
    st AS (SELECT *, CASE WHEN covered = 0 THEN 0.0 ELSE depth_sum / covered END AS mean_depth, CASE WHEN covered = 0 THEN 0.0 ELSE dedup_sum / covered END AS mean_dedup,
      (depth_sum / size) / (SELECT sum(depth_sum) / sum(size) FROM rs) AS normalised_depth FROM rs)"""
)
_GC = """wide AS (SELECT chrom, name, greatest("start" - x, 1) AS s, "end" + x AS e FROM (SELECT *, CASE WHEN "end" - "start" + 1 < 200 THEN (200 - ("end" - "start" + 1)) // 2 + 1 ELSE 0 END AS x FROM regions)),
    gc AS (SELECT name, count(*) FILTER (base IN ('G', 'C')) / count(*) AS gc FROM wide JOIN refseq r ON wide.chrom = r.chrom AND r.pos BETWEEN s AND e GROUP BY name)"""


def stats_with_gc(spark, sf_dir):
    seg = cov.depth_segments(
        spans(spark, sf_dir), ["chrom"], {"depth": ~F.col("is_del"), "dedup": ~F.col("is_duplicate")}
    )
    g = fx.regions(spark, sf_dir)
    return cov.region_stats(seg, g).join(cov.region_gc(g, fx.refseq(spark, sf_dir)), "name", "left")


@query(
    "region_stats",
    "dups regions refseq",
    _REGION_STATS
    + ", "
    + _GC
    + """ SELECT * REPLACE (round(mean_depth, 6) AS mean_depth, round(mean_dedup, 6) AS mean_dedup, round(normalised_depth, 6) AS normalised_depth, round(gc, 6) AS gc)
    FROM st LEFT JOIN gc USING (name)""",
)
def _(spark, sf_dir):
    out = stats_with_gc(spark, sf_dir)
    return out.withColumns({c: F.round(c, 6) for c in ("mean_depth", "mean_dedup", "normalised_depth", "gc")})


@query(
    "lane_depth",
    "reads regions",
    _TARGET
    + """ SELECT read_group, chrom, pos, count(*) AS depth FROM (SELECT read_group, chrom, pos + i AS pos FROM reads, (SELECT unnest(range(32)) AS i) WHERE NOT is_unmapped)
    JOIN tpos USING (chrom, pos) GROUP BY ALL""",
)
def _(spark, sf_dir):
    r = fx.reads(spark, sf_dir).filter("NOT is_unmapped").selectExpr("read_group", "chrom", "pos AS start", "pos + read_len - 1 AS end")
    return cov.lane_depth(r, fx.regions(spark, sf_dir))


@query(
    "predict_sex",
    "dups regions refseq",
    _REGION_STATS
    + ", "
    + _GC
    + """, u AS (SELECT CASE chrom WHEN 'chr2' THEN 'chrX' WHEN 'chr3' THEN 'chrY' ELSE chrom END AS chrom, mean_depth, gc, CAST(floor(round(gc / 0.05, 6)) AS BIGINT) AS gc_bin
       FROM st JOIN gc USING (name) WHERE mean_depth > 0 AND mean_depth < 1e9 AND covered / size >= 0.5 AND size >= 10 AND gc BETWEEN 0.1 AND 0.9),
    w AS (SELECT gc_bin, (SELECT avg(mean_depth) FROM u) / median(mean_depth) AS weight FROM u WHERE chrom NOT IN ('chrX', 'chrY') GROUP BY gc_bin),
    f AS (SELECT chrom, round(mean_depth * coalesce(weight, 1.0), 9) AS d, row_number() OVER (PARTITION BY chrom ORDER BY round(mean_depth * coalesce(weight, 1.0), 9)) - 1 AS rk,
       count(*) OVER (PARTITION BY chrom) AS n FROM u LEFT JOIN w USING (gc_bin)),
    t AS (SELECT chrom, count(*) AS n, avg(d) AS m FROM f WHERE rk >= floor(n * 0.05) AND rk < least(n, floor(n * 0.95) + 1) GROUP BY chrom),
    a AS (SELECT sum(m * n) FILTER (chrom NOT IN ('chrX', 'chrY')) / sum(n) FILTER (chrom NOT IN ('chrX', 'chrY')) AS autosome_depth,
       max(m) FILTER (chrom = 'chrX' AND n > 5) AS x_depth, max(m) FILTER (chrom = 'chrY' AND n > 5) AS y_depth, (SELECT count(*) FROM u) AS regions FROM t)
    SELECT round(autosome_depth, 6) AS autosome_depth, round(x_depth, 6) AS x_depth, round(y_depth, 6) AS y_depth, regions,
       round(x_depth / autosome_depth, 6) AS x_ratio, round(y_depth / autosome_depth, 6) AS y_ratio,
       CASE WHEN regions < 10 OR (x_depth IS NULL AND y_depth IS NULL) THEN 'unknown'
            WHEN x_depth IS NOT NULL AND y_depth IS NOT NULL AND (x_depth / autosome_depth > 0.75) <> (y_depth / autosome_depth < 0.25) THEN 'unknown'
            WHEN coalesce(x_depth / autosome_depth > 0.75, y_depth / autosome_depth < 0.25) THEN 'F' ELSE 'M' END AS sex FROM a""",
)
def _(spark, sf_dir):
    st = stats_with_gc(spark, sf_dir).withColumn(
        "chrom", F.expr("CASE chrom WHEN 'chr2' THEN 'chrX' WHEN 'chr3' THEN 'chrY' ELSE chrom END")
    )
    out = cov.predict_sex(st, span=0.05)
    return out.withColumns({c: F.round(c, 6) for c in ("autosome_depth", "x_depth", "y_depth", "x_ratio", "y_ratio")})


@query(
    "trimmed_mean",
    "genotypes",
    """f AS (SELECT chrom, dp, row_number() OVER (PARTITION BY chrom ORDER BY dp) - 1 AS rk, count(*) OVER (PARTITION BY chrom) AS n FROM genotypes)
    SELECT chrom, count(*) AS n, round(avg(dp), 6) AS trimmed_mean FROM f WHERE rk >= floor(n * 0.05) AND rk < least(n, floor(n * 0.95) + 1) GROUP BY chrom""",
)
def _(spark, sf_dir):
    return cov.trimmed_mean(fx.genotypes(spark, sf_dir), ["chrom"], "dp").withColumn("trimmed_mean", F.round("trimmed_mean", 6))

"""Genomic tables derived from the driver's tables, as DataFrames and as SQL for the check.

Every function takes (spark, sf_dir) and reads the parquet files there; all rows are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SQL["reads"] = """
SELECT concat('r', CAST(k AS VARCHAR)) AS read_name, mate_no,
  concat('s', CAST(c % 4 AS VARCHAR)) AS sample, concat('rg', CAST(c % 8 AS VARCHAR)) AS read_group,
  concat('lib', CAST(c % 4 AS VARCHAR)) AS library,
  CASE WHEN k % 97 = 0 THEN NULL ELSE concat('chr', CAST(c % 3 + 1 AS VARCHAR)) END AS chrom,
  CASE WHEN k % 97 = 0 THEN NULL ELSE CAST((c * 41) % 5000 + 1 + (mate_no - 1) * (60 + k % 7) AS BIGINT) END AS pos,
  32 AS read_len, CAST((k * 13) % 61 AS INT) AS mapq,
  (mate_no = 2) AS is_reverse, (k % 97 = 0) AS is_unmapped, (k % 53 = 0) AS is_secondary,
  translate(md5(concat('b', id)), '0123456789abcdef', 'ACGTACGTACGTACGN') AS bases,
  translate(md5(concat('q', id)), '0123456789abcdef', '#&),/258;=>?@ADG') AS quals
FROM (SELECT o_orderkey AS k, o_custkey AS c, m.mate_no,
        concat(CAST(o_orderkey AS VARCHAR), '.', CAST(m.mate_no AS VARCHAR)) AS id
      FROM orders CROSS JOIN (SELECT unnest([1, 2]) AS mate_no) m) b
"""


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two mates per order; orders of one customer share a start, which makes duplicates."""
    # two narrow columns are dealt out before they grow into reads, so that the work on reads does not follow the files' layout
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c")).repartition(parts, "k")
    b = o.select("k", "c", F.explode(F.array(F.lit(1), F.lit(2))).alias("mate_no")).withColumn("id", F.expr("concat(k, '.', mate_no)"))
    return b.selectExpr(
        "concat('r', k) AS read_name",
        "mate_no",
        "concat('s', c % 4) AS sample",
        "concat('rg', c % 8) AS read_group",
        "concat('lib', c % 4) AS library",
        "CASE WHEN k % 97 = 0 THEN NULL ELSE concat('chr', c % 3 + 1) END AS chrom",
        "CASE WHEN k % 97 = 0 THEN NULL ELSE CAST((c * 41) % 5000 + 1 + (mate_no - 1) * (60 + k % 7) AS BIGINT) END AS pos",
        "32 AS read_len",
        "CAST((k * 13) % 61 AS INT) AS mapq",
        "(mate_no = 2) AS is_reverse",
        "(k % 97 = 0) AS is_unmapped",
        "(k % 53 = 0) AS is_secondary",
        "translate(md5(concat('b', id)), '0123456789abcdef', 'ACGTACGTACGTACGN') AS bases",
        "translate(md5(concat('q', id)), '0123456789abcdef', '#&),/258;=>?@ADG') AS quals",
    )


SQL["pileup"] = """
SELECT r.sample, r.read_group, r.chrom, r.pos + CAST(i.i AS BIGINT) AS pos, r.read_name, r.mate_no, r.mapq, r.is_reverse,
  CAST(i.i AS INT) AS "offset", r.read_len,
  substr(r.bases, CAST(i.i AS INT) + 1, 1) AS base, CAST(ascii(substr(r.quals, CAST(i.i AS INT) + 1, 1)) - 33 AS INT) AS qual
FROM reads r CROSS JOIN (SELECT unnest(range(32)) AS i) i WHERE NOT r.is_unmapped
"""


def pileup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per mapped base: the operator of the same name on the read fixture."""
    from locuswise.operators.pileup import explode_bases

    return explode_bases(reads(spark, sf_dir).filter("NOT is_unmapped"))


SQL["refseq"] = """
SELECT concat('chr', CAST(c.c AS VARCHAR)) AS chrom, CAST(p.p AS BIGINT) + 1 AS pos,
  substr('ACGT', CAST((p.p * 7 + CAST(floor(p.p / 3) AS BIGINT) * 5 + CAST(floor(p.p / 11) AS BIGINT) + c.c) % 4 AS INT) + 1, 1) AS base
FROM (SELECT unnest(range(1, 4)) AS c) c CROSS JOIN (SELECT unnest(range(5200)) AS p) p
"""


def refseq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference bases 1..5200 of three contigs, one row per base."""
    p = spark.range(5200).select(F.col("id").alias("p"), F.explode(F.array(*[F.lit(i).cast("long") for i in (1, 2, 3)])).alias("c"))
    return p.selectExpr(
        "concat('chr', c) AS chrom",
        "p + 1 AS pos",
        "substr('ACGT', CAST((p * 7 + CAST(floor(p / 3) AS BIGINT) * 5 + CAST(floor(p / 11) AS BIGINT) + c) % 4 AS INT) + 1, 1) AS base",
    )


SQL["variants"] = """
SELECT DISTINCT concat('chr', CAST(p_partkey % 3 + 1 AS VARCHAR)) AS chrom, CAST(p_partkey * 2 + 1 AS BIGINT) AS pos,
  CASE WHEN p_size % 5 = 1 THEN concat(substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1), 'TG')
       ELSE substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1) END AS ref,
  CASE WHEN p_size % 5 = 0 THEN concat(substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1), 'TG')
       WHEN p_size % 5 = 1 THEN substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1)
       ELSE substr('ACGT', CAST((p_partkey + 1 + p_size % 3) % 4 AS INT) + 1, 1) END AS alt,
  CAST(p_retailprice AS DOUBLE) AS qual, CASE WHEN p_size % 11 = 0 THEN 'LowQual' ELSE 'PASS' END AS filter,
  CASE WHEN p_size % 2 = 0 THEN concat('rs', CAST(p_partkey AS VARCHAR)) END AS rsid, p_size AS size FROM part
"""


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One variant per part: SNPs, insertions of TG and deletions of TG."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('chr', p_partkey % 3 + 1) AS chrom",
        "CAST(p_partkey * 2 + 1 AS BIGINT) AS pos",
        """CASE WHEN p_size % 5 = 1 THEN concat(substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1), 'TG')
           ELSE substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1) END AS ref""",
        """CASE WHEN p_size % 5 = 0 THEN concat(substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1), 'TG')
           WHEN p_size % 5 = 1 THEN substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1)
           ELSE substr('ACGT', CAST((p_partkey + 1 + p_size % 3) % 4 AS INT) + 1, 1) END AS alt""",
        "CAST(p_retailprice AS DOUBLE) AS qual",
        "CASE WHEN p_size % 11 = 0 THEN 'LowQual' ELSE 'PASS' END AS filter",
        "CASE WHEN p_size % 2 = 0 THEN concat('rs', p_partkey) END AS rsid",
        "p_size AS size",
    ).distinct()


SQL["genotypes"] = """
SELECT chrom, pos, sample, max(gt_code) AS gt_code, max(gq) AS gq, max(dp) AS dp FROM (
SELECT concat('chr', CAST(l_partkey % 3 + 1 AS VARCHAR)) AS chrom, CAST(l_partkey * 2 + 1 AS BIGINT) AS pos,
  concat('s', CAST(l_suppkey % 12 AS VARCHAR)) AS sample,
  CAST((l_partkey * 3 + l_suppkey) % 4 AS INT) AS gt_code, CAST((l_partkey * 5 + l_suppkey * 7) % 99 AS INT) AS gq,
  CAST((l_partkey + l_suppkey) % 40 AS INT) AS dp FROM lineitem) GROUP BY ALL
"""


def genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (site, sample); gt_code 0 hom-ref, 1 het, 2 hom-alt, 3 no-call."""
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr(
            "concat('chr', l_partkey % 3 + 1) AS chrom",
            "CAST(l_partkey * 2 + 1 AS BIGINT) AS pos",
            "concat('s', l_suppkey % 12) AS sample",
            "CAST((l_partkey * 3 + l_suppkey) % 4 AS INT) AS gt_code",
            "CAST((l_partkey * 5 + l_suppkey * 7) % 99 AS INT) AS gq",
            "CAST((l_partkey + l_suppkey) % 40 AS INT) AS dp",
        )
        .groupBy("chrom", "pos", "sample")
        .agg(F.max("gt_code").alias("gt_code"), F.max("gq").alias("gq"), F.max("dp").alias("dp"))
    )


SQL["regions"] = """
SELECT concat('chr', CAST(s_suppkey % 3 + 1 AS VARCHAR)) AS chrom, CAST((s_suppkey * 43) % 4900 + 1 AS BIGINT) AS "start",
  CAST((s_suppkey * 43) % 4900 + 20 + s_nationkey * 4 AS BIGINT) AS "end", concat('gene', CAST(s_suppkey AS VARCHAR)) AS name,
  (s_nationkey % 2 = 0) AS is_minus FROM supplier
"""


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One region per supplier, 1-based closed, overlapping and of different length."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('chr', s_suppkey % 3 + 1) AS chrom",
        "CAST((s_suppkey * 43) % 4900 + 1 AS BIGINT) AS start",
        "CAST((s_suppkey * 43) % 4900 + 20 + s_nationkey * 4 AS BIGINT) AS end",
        "concat('gene', s_suppkey) AS name",
        "(s_nationkey % 2 = 0) AS is_minus",
    )


SQL["pairs"] = """
SELECT concat('r', CAST(o_orderkey AS VARCHAR)) AS read_name, concat('lib', CAST(o_custkey % 3 AS VARCHAR)) AS library,
  concat('chr', CAST(o_custkey % 3 + 1 AS VARCHAR)) AS chrom, CAST((o_custkey * 41) % 5000 + 1 + o_orderkey % 9 AS BIGINT) AS pos,
  CASE WHEN o_orderkey % 31 = 0 THEN concat('chr', CAST((o_custkey + 1) % 3 + 1 AS VARCHAR)) ELSE concat('chr', CAST(o_custkey % 3 + 1 AS VARCHAR)) END AS mate_chrom,
  CAST((o_custkey * 41) % 5000 + 1 + o_orderkey % 9 + CASE WHEN o_custkey % 10 = 0 THEN 1500 WHEN o_custkey % 10 = 1 THEN 10 ELSE 168 + o_orderkey % 11 END AS BIGINT) AS mate_pos,
  (o_custkey % 10 = 2) AS is_reverse, (o_custkey % 10 <> 3) AS mate_reverse, (o_custkey % 10 > 3) AS is_proper,
  CAST(CASE WHEN o_custkey % 10 = 0 THEN 1500 WHEN o_custkey % 10 = 1 THEN 10 ELSE 168 + o_orderkey % 11 END + 32 AS INT) AS insert_size,
  CAST(20 + o_orderkey % 41 AS INT) AS mapq, (o_orderkey % 17 = 0) AS is_dup, 32 AS read_len
FROM orders
"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One first-of-pair read per order with its mate's place, for structural-variant evidence."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('r', o_orderkey) AS read_name",
        "concat('lib', o_custkey % 3) AS library",
        "concat('chr', o_custkey % 3 + 1) AS chrom",
        "CAST((o_custkey * 41) % 5000 + 1 + o_orderkey % 9 AS BIGINT) AS pos",
        "CASE WHEN o_orderkey % 31 = 0 THEN concat('chr', (o_custkey + 1) % 3 + 1) ELSE concat('chr', o_custkey % 3 + 1) END AS mate_chrom",
        "CAST((o_custkey * 41) % 5000 + 1 + o_orderkey % 9 + CASE WHEN o_custkey % 10 = 0 THEN 1500 WHEN o_custkey % 10 = 1 THEN 10 ELSE 168 + o_orderkey % 11 END AS BIGINT) AS mate_pos",
        "(o_custkey % 10 = 2) AS is_reverse",
        "(o_custkey % 10 <> 3) AS mate_reverse",
        "(o_custkey % 10 > 3) AS is_proper",
        "CAST(CASE WHEN o_custkey % 10 = 0 THEN 1500 WHEN o_custkey % 10 = 1 THEN 10 ELSE 168 + o_orderkey % 11 END + 32 AS INT) AS insert_size",
        "CAST(20 + o_orderkey % 41 AS INT) AS mapq",
        "(o_orderkey % 17 = 0) AS is_dup",
        "32 AS read_len",
    )


# Aligned reads: the read fixture with flag bits, cigars and mate columns. The expressions are valid in both dialects.
_K = "CAST(substr(read_name, 2) AS BIGINT)"
_ALIGNED = [
    ("read_name", "read_name"), ("mate_no", "mate_no"), ("sample", "sample"), ("read_group", "read_group"), ("library", "library"),
    ("flag", f"""CAST(1 + CASE WHEN {_K} % 3 = 0 THEN 2 ELSE 0 END + CASE WHEN is_unmapped THEN 12 ELSE 0 END
       + CASE WHEN mate_no = 2 THEN 16 ELSE 32 END + CASE WHEN mate_no = 1 THEN 64 ELSE 128 END
       + CASE WHEN is_secondary THEN 256 ELSE 0 END + CASE WHEN {_K} % 71 = 0 THEN 512 ELSE 0 END
       + CASE WHEN {_K} % 17 = 0 THEN 1024 ELSE 0 END + CASE WHEN {_K} % 59 = 0 THEN 2048 ELSE 0 END AS INT)"""),
    ("chrom", "chrom"), ("pos", "pos"), ("mapq", "mapq"),
    ("cigar", f"""CASE {_K} % 12 WHEN 0 THEN '2S30M' WHEN 1 THEN '10M2I20M' WHEN 2 THEN '10M3D22M' WHEN 3 THEN '4D32M'
       WHEN 4 THEN '10M2I3D20M' WHEN 5 THEN '5H30M2S' WHEN 6 THEN '32S' WHEN 7 THEN '10M5N22M' ELSE '32M' END"""),
    ("mate_chrom", f"CASE WHEN {_K} % 31 = 0 THEN 'chrX' ELSE '=' END"),
    ("insert_size", f"CAST(CASE WHEN mate_no = 1 THEN 92 + {_K} % 7 ELSE -92 - {_K} % 7 END AS INT)"),
    ("bases", "bases"), ("quals", "quals"),
]
SQL["aligned"] = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _ALIGNED) + " FROM reads"


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in _ALIGNED])


_G = "CAST(size % 7 = 0 AND dp % 3 = 0 AS INT)"
_COHORT = [
    ("chrom", "chrom"), ("pos", "pos"), ("ref", "ref"), ("alt1", "alt"), ("alt2", "CASE WHEN size % 7 = 0 THEN concat(alt, 'A') END"),
    ("qual", "qual"), ("filter", "filter"), ("rsid", "rsid"), ("sample", "sample"), ("gq", "gq"), ("dp", "dp"),
    ("a1", f"CASE gt_code WHEN 0 THEN 0 WHEN 1 THEN {_G} WHEN 2 THEN 1 ELSE -1 END"),
    ("a2", f"CASE gt_code WHEN 0 THEN 0 WHEN 1 THEN 1 + {_G} WHEN 2 THEN 1 ELSE -1 END"),
    ("ad0", "CASE gt_code WHEN 2 THEN dp % 2 WHEN 1 THEN dp - CAST(floor(dp / 2) AS INT) ELSE dp END"),
    ("ad1", "CASE gt_code WHEN 2 THEN dp - dp % 2 WHEN 1 THEN CAST(floor(dp / 2) AS INT) ELSE 0 END"),
    ("ad2", "CASE WHEN size % 7 = 0 THEN dp % 5 END"),
]
SQL["cohort"] = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _COHORT) + " FROM genotypes JOIN variants USING (chrom, pos)"


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genotypes with their site: ref, alts (one or two), gt, ad, gq, dp, qual, filter and id."""
    j = genotypes(spark, sf_dir).join(variants(spark, sf_dir), ["chrom", "pos"])
    return j.selectExpr(*[f"{e} AS {n}" for n, e in _COHORT]).selectExpr(
        "chrom", "pos", "ref", "array_compact(array(alt1, alt2)) AS alts", "qual", "filter", "filter <> 'PASS' AS is_filtered", "rsid AS id",
        "sample", "array(a1, a2) AS gt", "gq", "dp", "array_compact(array(ad0, ad1, ad2)) AS ad",
    )


SQL["sites"] = """SELECT chrom, pos, ref, alt AS alt1, CASE WHEN size % 7 = 0 THEN concat(alt, 'A') END AS alt2, qual, filter, rsid, size FROM variants"""


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites of the variant fixture with one or two alternate alleles and an INFO map."""
    return variants(spark, sf_dir).selectExpr(
        "chrom", "pos", "pos + length(ref) - 1 AS end", "ref",
        "array_compact(array(alt, CASE WHEN size % 7 = 0 THEN concat(alt, 'A') END)) AS alts", "qual",
        "CASE WHEN filter = 'PASS' THEN array() ELSE array(filter) END AS filters", "filter <> 'PASS' AS is_filtered", "rsid AS id", "size",
        """map_filter(map('QD', CAST(size % 13 AS STRING), 'FS', CASE WHEN size % 3 <> 0 THEN CAST(size AS STRING) END,
             'AC', CASE WHEN size % 7 = 0 THEN concat(size % 5, ',', size % 4) ELSE CAST(size % 5 AS STRING) END), (k, v) -> v IS NOT NULL) AS info""",
    )

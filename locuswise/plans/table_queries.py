"""Sort, text-form and table-layout queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from locuswise.operators import sorting as so
from locuswise.operators.fastq import split_mates
from locuswise.plans import fixtures as fx
from locuswise.plans.interval_queries import contigs
from locuswise.plans.registry import query
from locuswise.session import checkpoint_dir
from locuswise.sources import sinks
from locuswise.sources.reads import read_fastq
from locuswise.sources.variants import known_in_window, known_sites


@query(
    "sort_coordinate",
    "reads",
    "SELECT read_name, mate_no, chrom, pos, CAST(substr(chrom, 4) AS INT) AS contig_idx FROM reads WHERE NOT is_unmapped",
)
def _(spark, sf_dir):
    r = fx.reads(spark, sf_dir).filter("NOT is_unmapped").select("read_name", "mate_no", "chrom", "pos")
    return so.sort_coordinate(r, contigs(spark, sf_dir), ties=["read_name", "mate_no"])


@query("sort_by_sample", "genotypes", "SELECT * FROM genotypes")
def _(spark, sf_dir):
    return so.sort_by_sample(fx.genotypes(spark, sf_dir))


@query("window_sorted", "reads", 'SELECT read_name, mate_no, chrom, pos, CAST(floor(pos / 1000) AS BIGINT) AS "window" FROM reads WHERE NOT is_unmapped')
def _(spark, sf_dir):
    r = fx.reads(spark, sf_dir).filter("NOT is_unmapped").selectExpr("read_name", "mate_no", "chrom", "pos", "floor(pos / 1000) AS window")
    return so.window_sorted(r, ["chrom", "window"], ["pos"])


@query("only_unmapped", "reads", "SELECT read_name, mate_no FROM reads WHERE is_unmapped")
def _(spark, sf_dir):
    return so.only_unmapped(fx.reads(spark, sf_dir)).select("read_name", "mate_no")


@query(
    "top1",
    "genotypes",
    "SELECT chrom, pos, sample, gq FROM genotypes QUALIFY row_number() OVER (PARTITION BY chrom, pos ORDER BY gq DESC, sample DESC) = 1",
)
def _(spark, sf_dir):
    g = fx.genotypes(spark, sf_dir).select("chrom", "pos", "sample", "gq")
    return so.top1(g, ["chrom", "pos"], F.col("gq"), ["sample"])


@query(
    "split_mates",
    "reads",
    """SELECT CAST(mate_no AS VARCHAR) AS mate, concat('@', read_name, chr(10), bases, chr(10), '+', chr(10), quals) AS value FROM reads""",
)
def _(spark, sf_dir):
    parts = split_mates(fx.reads(spark, sf_dir))
    out = None
    for name, d in parts.items():
        d = d.withColumn("mate", F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out


@query(
    "vcf_lines",
    "sites",
    """i AS (SELECT *, array_to_string(list_sort(list_filter([concat('QD=', CAST(size % 13 AS VARCHAR)), CASE WHEN size % 3 <> 0 THEN concat('FS=', CAST(size AS VARCHAR)) END,
        concat('AC=', CASE WHEN size % 7 = 0 THEN concat(CAST(size % 5 AS VARCHAR), ',', CAST(size % 4 AS VARCHAR)) ELSE CAST(size % 5 AS VARCHAR) END)], lambda x: x IS NOT NULL)), ';') AS info FROM sites)
    SELECT concat_ws(chr(9), chrom, CAST(pos AS VARCHAR), coalesce(rsid, '.'), ref, concat_ws(',', alt1, alt2), regexp_replace(printf('%.2f', qual), '\\.?0+$', ''), CASE WHEN filter = 'PASS' THEN '.' ELSE filter END, info) AS value FROM i""",
)
def _(spark, sf_dir):
    return sinks.vcf_lines(fx.sites(spark, sf_dir))


@query(
    "tsv_lines",
    "sites",
    """SELECT concat_ws(chr(9), chrom, CAST(pos AS VARCHAR), coalesce(rsid, 'novel'), ref) AS value FROM sites""",
)
def _(spark, sf_dir):
    return sinks.tsv_lines(fx.sites(spark, sf_dir), ["chrom", "pos", "id", "ref"], {"id": "novel"})


@query(
    "known_in_window",
    "sites regions",
    """SELECT DISTINCT s.chrom, s.pos, s.ref FROM sites s JOIN regions g ON s.chrom = g.chrom AND s.pos BETWEEN g."start" AND g."end" """,
)
def _(spark, sf_dir):
    k = known_sites(fx.sites(spark, sf_dir), 128)
    return known_in_window(k, fx.regions(spark, sf_dir), 128).select("chrom", "pos", "ref")


@query("fastq_source", "reads", "SELECT read_name, mate_no, sample, bases, quals FROM reads")
def _(spark, sf_dir):
    # the table's reads as files of four lines each, read back; mates and samples stand in the lines
    path = f"{checkpoint_dir(spark)}/fastq-{uuid.uuid4().hex}"
    r = fx.reads(spark, sf_dir)
    r.select(F.concat_ws("\n", F.concat(F.lit("@"), "read_name", F.lit("/"), "mate_no"), "bases", F.concat(F.lit("+"), "sample"), "quals")).write.text(path)
    return read_fastq(spark, path).drop("file")

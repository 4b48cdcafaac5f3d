"""VCF, BED, reference, gene-model and annotation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuswise.functions.lambdas import first_of_key
from locuswise.operators.scan import running
from locuswise.sources.text import numbered_lines, read_lines


def _cell(i: int):
    return F.get("c", F.lit(i))


def read_vcf(spark: SparkSession, path) -> DataFrame:
    """Records of VCF text files: file, chrom, pos, end, id, ref, alts, qual, filters, info, format, samples_text."""
    c = read_lines(spark, path).filter("value NOT LIKE '#%' AND value <> ''").select(F.split("value", "\t").alias("c"), "file")
    dot = lambda x: F.when(x != ".", x)
    info = F.when(
        dot(_cell(7)).isNotNull(),
        first_of_key(
            F.transform(
                F.filter(F.split(_cell(7), ";"), lambda x: x != ""),
                lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.when(x.contains("="), F.substr(x, F.instr(x, "=") + 1)).otherwise("").alias("v")),
            )
        ),
    ).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    d = c.select(
        "file", _cell(0).alias("chrom"), _cell(1).cast("long").alias("pos"), dot(_cell(2)).alias("id"), _cell(3).alias("ref"),
        F.when(dot(_cell(4)).isNotNull(), F.split(_cell(4), ",")).otherwise(F.array().cast("array<string>")).alias("alts"),
        dot(_cell(5)).cast("double").alias("qual"),
        F.when(dot(_cell(6)).isNotNull(), F.split(_cell(6), ";")).otherwise(F.array().cast("array<string>")).alias("filters"),
        info.alias("info"), F.split(_cell(8), ":").alias("format"), F.slice("c", F.lit(10), F.greatest(F.size("c") - 9, F.lit(0))).alias("samples_text"),
    )
    end = F.coalesce(F.try_element_at("info", F.lit("END")).try_cast("long"), F.col("pos") + F.length("ref") - 1)
    return d.withColumns(
        {"end": end, "is_filtered": (F.size("filters") > 0) & ~F.array_contains("filters", "PASS")}
    )


def vcf_samples(spark: SparkSession, path) -> DataFrame:
    """Sample names of every file in column order: file, idx, sample."""
    head = read_lines(spark, path).filter("value LIKE '#CHROM%'").select("file", F.split("value", "\t").alias("c"))
    return head.select("file", F.posexplode(F.slice("c", F.lit(10), F.greatest(F.size("c") - 9, F.lit(0)))).alias("idx", "sample"))


def vcf_genotypes(records: DataFrame, samples: DataFrame) -> DataFrame:
    """One row per record and sample with gt, gq, dp, ad and pl; other FORMAT fields stay in ``fields``."""
    d = records.select("*", F.posexplode("samples_text").alias("idx", "_t")).join(samples, ["file", "idx"])
    d = d.withColumn("fields", F.map_from_arrays(F.slice("format", F.lit(1), F.size(F.split("_t", ":"))), F.split("_t", ":")))
    get = lambda k: F.try_element_at("fields", F.lit(k))
    ints = lambda k: F.transform(F.when(get(k) != ".", F.split(get(k), ",")), lambda x: x.try_cast("int"))
    gt = F.transform(F.split(get("GT"), r"[/|]"), lambda a: F.coalesce(a.try_cast("int"), F.lit(-1)))
    return d.withColumns(
        {
            "gt": F.coalesce(gt, F.array(F.lit(-1), F.lit(-1))), "phased": F.coalesce(get("GT").contains("|"), F.lit(False)), "gq": get("GQ").try_cast("int"),
            "dp": get("DP").try_cast("int"), "ad": ints("AD"), "pl": ints("PL"),
        }
    ).drop("samples_text", "_t", "format")


def read_bed(spark: SparkSession, path) -> DataFrame:
    """Regions as 1-based closed intervals; ``#`` and blank lines are skipped.

    Lines may open with two name columns before contig, start and end; a fourth column is the name.
    """
    c = read_lines(spark, path).filter("trim(value) <> '' AND value NOT LIKE '#%' AND value NOT LIKE 'track%'").select(F.split("value", r"\s+").alias("c"))
    named = ~_cell(1).rlike(r"^\d+$")
    shift = F.when(named, F.lit(2)).otherwise(F.lit(0))
    at = lambda i: F.get("c", shift + i)
    return c.select(
        at(0).alias("chrom"), (at(1).cast("long") + 1).alias("start"), at(2).cast("long").alias("end"),
        F.when(named, F.concat_ws(":", _cell(0), _cell(1))).otherwise(at(3)).alias("name"),
    )


def read_reference(spark: SparkSession, path) -> DataFrame:
    """FASTA as blocks in file order: chrom, first (1-based), bases.

    The contig of a line is the last header above it and its first base follows from the lengths of
    the lines before it; both are running values over tiles of lines, so a contig is not held by one task.
    """
    lines = numbered_lines(spark, path)
    head = F.col("value").startswith(">")
    d = running(lines, ["file"], "line_no", {"_h": ("max", F.when(head, F.struct("line_no", F.regexp_extract("value", r"^>(\S+)", 1).alias("name"))))})
    d = d.filter(~head & (F.col("value") != "")).select("file", "line_no", F.col("_h.name").alias("chrom"), F.trim("value").alias("bases"))
    d = running(d, ["file", "chrom"], "line_no", {"_upto": ("sum", F.length("bases").cast("long"))})
    return d.select("chrom", (F.col("_upto") - F.length("bases") + 1).alias("first"), "bases")


def reference_positions(blocks: DataFrame) -> DataFrame:
    """One row per base: chrom, pos, base."""
    return blocks.select("chrom", "first", F.posexplode(F.split("bases", "")).alias("i", "base")).select(
        "chrom", (F.col("first") + F.col("i")).alias("pos"), F.upper("base").alias("base")
    )


def read_gene_model(spark: SparkSession, path) -> DataFrame:
    """Exon rows of a RefSeq-style table: transcript, gene, chrom, start, end, cds_start, cds_end, is_minus, exon.

    Starts in the file are 0-based; an optional leading bin column is recognised by its number.
    """
    c = read_lines(spark, path).filter("value <> '' AND value NOT LIKE '#%'").select(F.split("value", "\t").alias("c"))
    shift = F.when(_cell(0).rlike(r"^\d+$"), F.lit(1)).otherwise(F.lit(0))
    at = lambda i: F.get("c", shift + i)
    longs = lambda x: F.transform(F.filter(F.split(x, ","), lambda v: v != ""), lambda v: v.cast("long"))
    d = c.select(
        at(0).alias("transcript"), at(11).alias("gene"), at(1).alias("chrom"), (at(2) == "-").alias("is_minus"),
        (at(5).cast("long") + 1).alias("cds_start"), at(6).cast("long").alias("cds_end"),
        F.posexplode(F.arrays_zip(longs(at(8)).alias("s"), longs(at(9)).alias("e"))).alias("exon", "x"),
    )
    return d.select("transcript", F.coalesce("gene", "transcript").alias("gene"), "chrom", (F.col("x.s") + 1).alias("start"), F.col("x.e").alias("end"), "cds_start", "cds_end", "is_minus", "exon")


def genes_of(exons: DataFrame) -> DataFrame:
    """Gene spans of a gene model, with a flag for coding genes."""
    return exons.groupBy(F.col("gene").alias("name"), "chrom", "is_minus").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.bool_or(F.col("cds_end") >= F.col("cds_start")).alias("is_coding")
    )


def load_annotation_table(spark: SparkSession, path, key_columns=(0, 1, 3)) -> DataFrame:
    """Tab-separated annotation table with a ``#`` header: every column kept, plus a row key of some of them."""
    d = spark.read.option("sep", "\t").option("header", "true").option("recursiveFileLookup", "true").csv(path)
    first = d.columns[0]
    d = d.withColumnRenamed(first, first.lstrip("#"))
    return d.withColumn("row_key", F.concat_ws("-", *[F.col(f"`{d.columns[i]}`") for i in key_columns]))


def known_sites(variants: DataFrame, bin_size: int = 10_000) -> DataFrame:
    """Known variants with a genome bin, the layout for pruning by contig and window."""
    return variants.withColumn("bin", F.floor(F.col("pos") / bin_size)).select("chrom", "bin", "pos", "end", "ref", "alts", "id")


def known_in_window(known: DataFrame, windows: DataFrame, bin_size: int = 10_000) -> DataFrame:
    """Known variants that start inside one of the windows (chrom, start, end): an equi join on bins."""
    w = windows.select("chrom", F.col("start").alias("_s"), F.col("end").alias("_e"), F.explode(F.sequence(F.floor(F.col("start") / bin_size), F.floor(F.col("end") / bin_size))).alias("bin"))
    return known.join(w, ["chrom", "bin"]).filter("pos BETWEEN _s AND _e").drop("_s", "_e").distinct()

"""FASTQ, adapter lists, manifests and SAM text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuswise.functions import cigar as cg
from locuswise.functions.flags import expand
from locuswise.functions.lambdas import first_of_key
from locuswise.sources.text import numbered_lines, read_lines, records


def _name_and_mate(header: Column, style: str) -> tuple[Column, Column]:
    """Read name and mate number from a header line without its ``@``."""
    if style == "slash":  # name/1
        mate = F.regexp_extract(header, r"/([12])\s*$", 1)
        name = F.regexp_replace(header, r"/[12]\s*$", "")
    elif style == "space":  # name 1:N:0:BARCODE
        mate = F.regexp_extract(header, r"\s([12])(?::\S*)?", 1)
        name = F.regexp_extract(header, r"^(\S+)", 1)
    elif style == "bare":
        return F.regexp_extract(header, r"^(\S+)", 1), F.lit(None).cast("int")
    else:
        raise ValueError(f"unknown read name style: {style}")
    return name, F.when(mate != "", mate.cast("int"))


def read_fastq(spark: SparkSession, path, name_style: str = "slash", sample: str | None = None) -> DataFrame:
    """read_name, mate_no, sample, bases, quals and file, one row per four lines.

    ``sample`` names all reads; without it the third line after ``+`` is taken, as in cleaned files
    that carry the sample there, else it is null. What isn't a record of four lines is an error.
    """
    rec = records(spark, path, 4).select("file", *[F.get("parts", F.lit(i)).alias(n) for i, n in enumerate(("_head", "bases", "_plus", "quals"))])
    broken = ~F.col("_head").startswith("@") | ~F.coalesce(F.col("_plus").startswith("+"), F.lit(False))
    head = F.when(
        broken, F.raise_error(F.concat(F.lit("not a FASTQ record: "), F.col("_head")))
    ).otherwise(F.substr("_head", F.lit(2)))
    rec = rec.withColumn("_head", head)
    name, mate = _name_and_mate(F.col("_head"), name_style)
    in_line = F.when(F.length("_plus") > 1, F.substr("_plus", F.lit(2)))
    return rec.select(
        name.alias("read_name"), mate.alias("mate_no"), (F.lit(sample) if sample else in_line).alias("sample"), "bases", "quals", "file"
    )


def read_adapters(spark: SparkSession, path) -> DataFrame:
    """(read_name, mate_no) of reads that contain adapter: first tab-separated field, ``#`` lines skipped."""
    lines = read_lines(spark, path).filter("value <> '' AND value NOT LIKE '#%'")
    name, mate = _name_and_mate(F.split("value", "\t")[0], "slash")
    return lines.select(name.alias("read_name"), mate.alias("mate_no"))


def read_manifest(spark: SparkSession, path) -> DataFrame:
    """Samples and their files from tab-separated lines: sample, fastq 1, fastq 2, adapters 1, adapters 2.

    Output: one row per file (sample, sample_idx, kind, mate_no, file_name).
    """
    cells = read_lines(spark, path).filter("value <> '' AND value NOT LIKE '#%'").select(F.split("value", "\t").alias("c"))
    kinds = F.array(
        *[
            F.struct(F.lit(k).alias("kind"), F.lit(m).alias("mate_no"), F.get("c", F.lit(i)).alias("path"))
            for i, (k, m) in enumerate([("fastq", 1), ("fastq", 2), ("adapter", 1), ("adapter", 2)], start=1)
        ]
    )
    rows = cells.select(F.get("c", F.lit(0)).alias("sample"), F.explode(kinds).alias("k")).select("sample", "k.*").filter("path IS NOT NULL AND path <> ''")
    idx = cells.select(F.get("c", F.lit(0)).alias("sample")).distinct()
    from pyspark.sql import Window

    # a manifest has one row per sample
    idx = idx.withColumn("sample_idx", F.row_number().over(Window.orderBy("sample")) - 1)
    return rows.join(idx, "sample").withColumn("file_name", F.element_at(F.split("path", "/"), -1)).drop("path")


def tag_samples(reads: DataFrame, manifest: DataFrame) -> DataFrame:
    """Set ``sample`` and missing mate numbers of reads from the manifest by file name."""
    m = manifest.filter("kind = 'fastq'").select("file_name", F.col("sample").alias("_s"), F.col("mate_no").alias("_m"))
    j = reads.withColumn("file_name", F.element_at(F.split("file", "/"), -1)).join(m, "file_name", "left")
    return j.withColumns({"sample": F.coalesce("_s", "sample"), "mate_no": F.coalesce("mate_no", "_m")}).drop("_s", "_m", "file_name")


def read_sam(spark: SparkSession, path) -> DataFrame:
    """Alignment lines of SAM text with one boolean per flag bit and tags as a map."""
    c = read_lines(spark, path).filter("value NOT LIKE '@%' AND value <> ''").select(F.split("value", "\t").alias("c"), "file")
    star = lambda x: F.when(x != "*", x)
    tags = first_of_key(
        F.transform(
            F.slice("c", F.lit(12), F.greatest(F.size("c") - 11, F.lit(0))),
            lambda t: F.struct(F.left(t, F.lit(2)).alias("k"), F.substr(t, F.lit(6)).alias("v")),
        )
    )
    d = c.select(
        F.get("c", F.lit(0)).alias("read_name"), F.get("c", F.lit(1)).cast("int").alias("flag"), star(F.get("c", F.lit(2))).alias("chrom"),
        F.get("c", F.lit(3)).cast("long").alias("pos"), F.get("c", F.lit(4)).cast("int").alias("mapq"), F.get("c", F.lit(5)).alias("cigar"),
        star(F.get("c", F.lit(6))).alias("mate_chrom"), F.get("c", F.lit(7)).cast("long").alias("mate_pos"), F.get("c", F.lit(8)).cast("int").alias("insert_size"),
        F.get("c", F.lit(9)).alias("bases"), F.get("c", F.lit(10)).alias("quals"), tags.alias("tags"), "file",
    )
    d = d.withColumns(
        {
            "mate_chrom": F.when(F.col("mate_chrom") == "=", F.col("chrom")).otherwise(F.col("mate_chrom")),
            "read_group": F.try_element_at("tags", F.lit("RG")),
            "end": cg.alignment_end(F.col("pos"), F.col("cigar")),
        }
    )
    return expand(d)


def read_groups(spark: SparkSession, path, unknown_library: str = "unknown") -> DataFrame:
    """@RG header lines: read_group, sample, library (falls back to sample, then to a constant), platform."""
    lines = read_lines(spark, path).filter("value LIKE '@RG%'").select(F.split("value", "\t").alias("c")).distinct()
    tag = lambda t: F.get(F.transform(F.filter("c", lambda x: x.startswith(t + ":")), lambda x: F.substr(x, F.lit(4))), F.lit(0))
    return lines.select(
        tag("ID").alias("read_group"), tag("SM").alias("sample"), F.coalesce(tag("LB"), tag("SM"), F.lit(unknown_library)).alias("library"), tag("PL").alias("platform")
    )


def contigs(spark: SparkSession, path) -> DataFrame:
    """@SQ header lines in order: chrom, idx, length."""
    lines = numbered_lines(spark, path).filter("value LIKE '@SQ%'")
    tag = lambda t: F.regexp_extract("value", rf"\t{t}:([^\t]+)", 1)
    from pyspark.sql import Window

    # a dictionary has one row per contig
    d = lines.groupBy(tag("SN").alias("chrom")).agg(F.min("line_no").alias("_n"), F.max(tag("LN").cast("long")).alias("length"))
    return d.select("chrom", (F.row_number().over(Window.orderBy("_n", "chrom")) - 1).alias("idx"), "length")

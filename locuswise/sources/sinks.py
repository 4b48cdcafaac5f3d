"""Text and table writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswise.operators.fastq import split_mates


def write_by_sample(df: DataFrame, path: str, order: Sequence[str] = ("chrom", "pos"), partitions: int | None = None, fmt: str = "parquet") -> None:
    """One folder per sample, files sorted by position.

    Range partitioning on sample and position splits a large sample over many files.
    """
    keys = ["sample", *order]
    d = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    d.sortWithinPartitions(*keys).write.mode("overwrite").partitionBy("sample").format(fmt).save(path)


def text_or(value: Column, default: str = ".") -> Column:
    return F.coalesce(value.cast("string"), F.lit(default))


def vcf_lines(sites: DataFrame) -> DataFrame:
    """Site records as VCF text: value. INFO keys are sorted; missing fields become a dot."""
    info = F.array_sort(F.transform(F.map_entries("info"), lambda e: F.when(e["value"] == "", e["key"]).otherwise(F.concat_ws("=", e["key"], e["value"]))))
    join = lambda c, sep: F.when(F.size(c) > 0, F.array_join(c, sep)).otherwise(F.lit("."))
    qual = F.regexp_replace(F.format_string("%.2f", "qual"), r"\.?0+$", "")
    return sites.select(
        F.concat_ws(
            "\t", "chrom", F.col("pos").cast("string"), text_or(F.col("id")), "ref", join("alts", ","), F.when(F.col("qual").isNull(), ".").otherwise(qual), join("filters", ";"), join(info, ";")
        ).alias("value")
    )


def write_vcf(sites: DataFrame, path: str, header: Sequence[str] = ()) -> None:
    """VCF text in position order; the header goes to its own file that sorts first."""
    spark = sites.sparkSession
    lines = ["##fileformat=VCFv4.2", *header, "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/0_header")
    ordered = sites.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos")
    vcf_lines(ordered).write.mode("overwrite").text(f"{path}/1_records")


def tsv_lines(df: DataFrame, fields: Sequence[str], defaults: Mapping[str, str] | None = None) -> DataFrame:
    """Tab-separated text with a default per field for missing and empty values."""
    defaults = defaults or {}
    cell = lambda f: F.coalesce(F.nullif(F.col(f).cast("string"), F.lit("")), F.lit(defaults.get(f, ".")))
    return df.select(F.concat_ws("\t", *[cell(f) for f in fields]).alias("value"))


def write_tsv(df: DataFrame, path: str, fields: Sequence[str], defaults: Mapping[str, str] | None = None) -> None:
    tsv_lines(df, fields, defaults).write.mode("overwrite").text(path)


def write_mates(reads: DataFrame, path: str) -> None:
    """FASTQ text of mate 1, mate 2 and single reads in three folders."""
    for name, lines in split_mates(reads).items():
        lines.write.mode("overwrite").text(f"{path}/{name}")


def export_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def write_warehouse(rows: DataFrame, path: str) -> None:
    """Variant warehouse rows partitioned by contig and sorted by key, so that scans prune."""
    d = rows.withColumn("chrom", F.substring_index("row_key", "-", 1))
    d.repartitionByRange("chrom", "row_key").sortWithinPartitions("row_key").write.mode("overwrite").partitionBy("chrom").parquet(path)

"""Read filters and trims for a stream of reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from locuswise.operators.fastq import classify_reads, trim_reads


def filter_reads(stream: DataFrame, drop: Column) -> DataFrame:
    """Reads for which ``drop`` is not true."""
    return stream.filter(~drop | drop.isNull())


def clean_single_reads(stream: DataFrame, trim=(0, 0, 0, 0), **limits) -> DataFrame:
    """Trim reads and drop those with too many N or low qualities; mates are judged one by one."""
    c = classify_reads(trim_reads(stream, *trim), **limits)
    return c.filter("NOT has_adapter AND NOT too_many_n AND NOT low_quality").select(*stream.columns)

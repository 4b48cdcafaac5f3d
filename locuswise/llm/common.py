"""Helpers that the operators of this folder share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuswise.session import checkpoint_dir

#: white space of the word rules, as a character class: blank, tab, line feed, vertical tab, form feed, carriage return
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: tables stored within each open ``scratch`` block, innermost last
_OPEN: list[list[tuple[SparkSession, str]]] = []


def _write(df: DataFrame, level: int, codec: str | None = None) -> DataFrame:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/locuswise-{uuid.uuid4().hex}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    if len(_OPEN) >= level:
        _OPEN[-level].append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Cuts the lineage by a table that outlives executors, and lets several readers share one computation. Within a ``scratch``
    block the table lives until the block ends. ``codec`` takes the place of the session's Parquet compression.
    """
    return _write(df, 1, codec)


def kept(df: DataFrame) -> DataFrame:
    """``stored`` for what a ``scratch`` block gives to the code around it: the table outlives the block."""
    return _write(df, 2)


@contextmanager
def scratch(shuffles: bool = False) -> Iterator[None]:
    """Deletes the tables stored in the block when it ends; whatever is still read from them has to be ``kept`` by then.

    With ``shuffles``, Spark is also made to look for the shuffle files of plans that nobody holds any more.
    """
    made: list[tuple[SparkSession, str]] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.remove(made)
        for spark, name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        if made and shuffles:
            gc.collect()
            made[0][0]._jvm.java.lang.System.gc()


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n``; the fold of a document without an id is that of an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def whole_text(text: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """Rows of a stored table with the column ``c`` whose count no more than ``limit`` rows reach or exceed, cut at a sixteenth of an octave.

    The histogram behind it has a bounded number of rows, whatever the table's size.
    """
    bucket = F.floor(F.log2("c") * 16)
    sizes = sorted(((r["b"], r["n"]) for r in counts.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, n = (sizes[0][0] + 1 if sizes else 0), 0
    for b, m in sizes:
        n += m
        if n > limit:
            break
        least = b
    return counts.filter(bucket >= least)

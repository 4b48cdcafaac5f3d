"""Text files by lines, and by records of several lines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path, recursive: bool = True) -> DataFrame:
    """Text lines with their file. Sub-folders are searched; names that start with ``_`` or ``.`` are skipped."""
    return (
        spark.read.option("recursiveFileLookup", str(recursive).lower())
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"))
    )


def numbered_lines(spark: SparkSession, path, recursive: bool = True) -> DataFrame:
    """Lines with their 0-based number in the file: file, line_no, value.

    Rows of one scan block carry rising ids, so a line's place in its block is its id minus the
    smallest id there; block sizes, one row per block, give the lines before the block.
    """
    lines = read_lines(spark, path, recursive).withColumn("_id", F.monotonically_increasing_id())
    blocks = lines.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    w = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(w), F.lit(0).cast("long"))).drop("_rows")
    return lines.join(blocks, ["file", "_block"]).select(
        "file", (F.col("_before") + F.col("_id") - F.col("_first")).alias("line_no"), "value"
    )


#: file splits whose places are broadcast at most (about 100 bytes each); more are joined
BROADCAST_SPLITS = 200_000


def records(spark: SparkSession, path, size: int, recursive: bool = True) -> DataFrame:
    """file, parts: each ``size`` lines of a file as one array; a last array may be shorter.

    Records are put together inside the file splits, in the order of the scan. A first pass gives one row per split: its number of
    lines and the few lines at both ends that may belong to a record of another split. Only these lines are exchanged.
    """
    lines = read_lines(spark, path, recursive).select("file", "_block", "value")
    ends = _split_ends(lines, size - 1)
    w = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    placed = ends.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0).cast("long")))
    need = F.least(F.pmod(-F.col("_before"), F.lit(size)), F.col("_n")).cast("int")  # lines of a record that began earlier
    over = F.when(F.col("_n") > need, F.pmod(F.col("_n") - need, F.lit(size))).otherwise(0).cast("int")
    numbered = lambda part, first: F.transform(part, lambda v, i: F.struct((first + i).alias("at"), v.alias("value")))
    loose = F.concat(numbered(F.slice("_head", F.lit(1), need), F.col("_before")), numbered(F.slice("_tail", F.size("_tail") - over + 1, over), F.col("_before") + F.col("_n") - over))
    cut = placed.select("file", F.explode(loose).alias("l")).groupBy("file", F.floor(F.col("l.at") / size).alias("_rec")).agg(F.sort_array(F.collect_list("l")).alias("l"))
    cut = cut.select("file", F.transform("l", lambda x: x["value"]).alias("parts"))
    skips = placed.select("file", "_block", need.alias("_skip"))
    if skips.count() <= BROADCAST_SPLITS:
        known = lines.join(F.broadcast(skips), ["file", "_block"])
    else:  # beyond that the lines are dealt by split and put back in order
        known = lines.withColumn("_id", F.monotonically_increasing_id()).join(skips, ["file", "_block"]).sortWithinPartitions("file", "_block", "_id")
    return _whole_records(known, size).unionByName(cut)


def _runs(batch: pa.RecordBatch):
    """(file, block, rows) of neighbouring rows of one split."""
    if not batch.num_rows:
        return
    file, block = batch.column("file"), batch.column("_block")
    new = np.ones(batch.num_rows, bool)
    new[1:] = np.asarray(pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1])))
    at = np.r_[np.flatnonzero(new), batch.num_rows]
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield file[a].as_py(), block[a].as_py(), batch.slice(a, b - a)


def _split_ends(lines: DataFrame, n: int) -> DataFrame:
    """file, _block, _n lines, the first and the last ``n`` of them: a row per split."""

    def run(batches):
        key, count, head, tail = None, 0, [], []

        def row():
            return pa.RecordBatch.from_pylist([{"file": key[0], "_block": key[1], "_n": count, "_head": head, "_tail": tail}], schema)

        schema = pa.schema([("file", pa.string()), ("_block", pa.int64()), ("_n", pa.int64()), ("_head", pa.list_(pa.string())), ("_tail", pa.list_(pa.string()))])
        for b in batches:
            for file, block, part in _runs(b):
                if (file, block) != key:
                    if key:
                        yield row()
                    key, count, head, tail = (file, block), 0, [], []
                value = part.column("value")
                count += len(value)
                head = (head + value[:n].to_pylist())[:n] if len(head) < n else head
                tail = (tail + value[-n:].to_pylist())[-n:]
        if key:
            yield row()

    return lines.mapInArrow(run, "file string, _block bigint, _n bigint, _head array<string>, _tail array<string>")


def _whole_records(lines: DataFrame, size: int) -> DataFrame:
    """file, parts of the records that lie within one split; ``_skip`` lines of a split belong to an earlier one."""

    def run(batches):
        key, held, skip = None, None, 0
        for b in batches:
            for file, block, part in _runs(b):
                value = part.column("value")
                if (file, block) != key:
                    key, held, skip = (file, block), None, part.column("_skip")[0].as_py()
                gone = min(skip, len(value))
                value, skip = value[gone:], skip - gone
                if held is not None:
                    value = pa.concat_arrays([held, value])
                n = len(value) // size
                held = value[n * size :]
                if n:
                    parts = pa.ListArray.from_arrays(pa.array(np.arange(0, n * size + 1, size), pa.int32()), value[: n * size])
                    yield pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), parts], names=["file", "parts"])

    return lines.select("file", "_block", "value", "_skip").mapInArrow(run, "file string, parts array<string>")

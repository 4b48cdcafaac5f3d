"""Exact copies by sorting contents.

Rows are dealt to ranges by sampled splitters over (start of the normalised text, its digest, length, id) and sorted inside
each range, so equal texts are neighbours and the row that stays comes first. Neighbours are compared in full. A group that
reaches over several ranges is put together from the ends of the ranges, two rows per range, so a large group never meets in
one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from locuswise.llm.common import BLANKS, stored, whole_text

#: characters of the normalised text that splitters see; texts that agree on them are split by their digest
LEAD = 24


def normalised(text: str):
    """The text without its ASCII white space; empty where null."""
    return F.translate(whole_text(text), BLANKS, "")


def _sorted(docs: DataFrame, doc_id: str, text: str, carry: list[str]) -> DataFrame:
    """Rows in content order, of a group the longest original (then the smallest id, nulls last) first."""
    keys = docs.select(
        F.col(f"`{doc_id}`").alias("_id"), F.substring(normalised(text), 1, LEAD).alias("_lead"), F.unhex(F.sha2(normalised(text).cast("binary"), 256)).alias("_sha"),
        (-F.char_length(whole_text(text))).alias("_less"), F.col(f"`{doc_id}`").isNull().alias("_none"), whole_text(text).alias("_text"),
        *([F.struct(*(F.col(f"`{c}`") for c in carry)).alias("_row")] if carry else []),
    )
    order = ["_lead", "_sha", "_less", "_none", "_id"]
    return keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_norm", normalised("_text").cast("binary"))


def _runs(col: pa.Array, last: bytes | None) -> np.ndarray:
    """Whether each value differs from the one before it (``last`` before the first)."""
    new = np.ones(len(col), bool)
    if last is not None:
        new[0] = col[0].as_py() != last
    if len(col) > 1:
        new[1:] = ~np.asarray(pc.equal(col[1:], col[:-1]))
    return new


def _edge_chains(edges: DataFrame) -> DataFrame:
    """pid, run, keep_id, group_size, later for runs at range ends that belong to one group; two rows per range at most.

    ``edges`` has pid, run, keep, size, edge (the normalised text). Texts of neighbouring ends are compared in full.
    """
    order = Window.orderBy("pid", "run")  # a row per end of a range, without texts
    place = edges.select("pid", "run", "keep", "size", F.row_number().over(order).alias("at"))
    texts = edges.select("pid", "run", "edge").join(place.select("pid", "run", "at"), ["pid", "run"])
    before = texts.select((F.col("at") + 1).alias("at"), F.col("edge").alias("before"))
    same = texts.join(before, "at").filter("edge = before").select("at", F.lit(0).alias("fresh"))
    chain = place.join(same, "at", "left").withColumn("chain", F.sum(F.coalesce("fresh", F.lit(1))).over(Window.orderBy("at")))
    whole = chain.groupBy("chain").agg(F.min(F.struct("at", "keep")).alias("head"), F.sum("size").alias("group_size"))
    return chain.join(whole, "chain").select("pid", "run", F.col("head.keep").alias("chain_keep"), "group_size", (F.col("at") > F.col("head.at")).alias("later"))


def exact_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row.

    Texts are equal when they agree after their ASCII white space is deleted; null counts as empty, so null, empty and blank
    texts form one group. Of a group the row with the most code points stays, then the smallest id (a null id last); of
    repeated rows with one id exactly one stays. Extra columns are not read; an empty table gives an empty result.
    """

    def mark(batches):
        pid = TaskContext.get().partitionId()
        ids, shas, news, last, ends = [], [], [], None, {}
        run = -1
        for b in batches:
            if not b.num_rows:
                continue
            norm = b.column("_norm")
            new = _runs(norm, last)
            ids.append(b.column("_id"))
            shas.append(b.column("_sha"))
            news.append(new)
            last = norm[-1].as_py()
            if run < 0:
                ends[0] = norm[0].as_py()
            run += int(new.sum())
        if run < 0:
            return
        ends[run] = last
        new = np.concatenate(news)
        runs = new.cumsum() - 1
        heads = np.flatnonzero(new)
        size = np.bincount(runs)
        all_ids = pa.chunked_array(ids).combine_chunks()
        keep = all_ids.take(pa.array(heads[runs]))
        edge = [None] * len(new)
        for r, t in ends.items():
            edge[heads[r]] = t
        table = pa.table({
            "doc_id": all_ids, "keep": keep, "size": size[runs].astype(np.int64), "head": new, "sha": pa.chunked_array(shas),
            "pid": np.full(len(new), pid, np.int32), "run": runs.astype(np.int64), "edge": pa.array(edge, pa.binary()),
        })
        yield from table.to_batches(max_chunksize=50_000)

    kind = dict(docs.dtypes)[doc_id]
    rows = stored(_sorted(docs, doc_id, text, []).select("_id", "_sha", "_norm").mapInArrow(mark, f"doc_id {kind}, keep {kind}, size bigint, head boolean, sha binary, pid int, run bigint, edge binary"))
    chains = _edge_chains(rows.filter("edge IS NOT NULL"))
    return rows.join(F.broadcast(chains), ["pid", "run"], "left").select(
        "doc_id", F.when(F.col("later").isNotNull(), F.col("chain_keep")).otherwise(F.col("keep")).alias("keep_id"), F.coalesce("group_size", "size").alias("group_size"),
        (F.col("head") & ~F.coalesce("later", F.lit(False))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns whatever their names; rules as in ``exact_copies``: of null, empty and blank texts
    one row stays in all, of repeated rows one, and an empty table stays empty."""
    fields = docs.schema

    def heads(batches):
        pid, run, last, held = TaskContext.get().partitionId(), -1, None, []
        names = ["_row", "pid", "run", "keep", "size", "edge"]

        def out(rows, runs, edge):
            n = len(rows)
            return pa.RecordBatch.from_arrays([rows, pa.array([pid] * n, pa.int32()), pa.array(runs, pa.int64()), pa.array(runs, pa.int64()), pa.array([1] * n, pa.int64()), pa.array(edge, pa.binary())], names=names)

        for b in batches:
            if not b.num_rows:
                continue
            norm = b.column("_norm")
            new = _runs(norm, last)
            last = norm[-1].as_py()
            at = np.flatnonzero(new)
            runs = run + 1 + np.arange(len(at))
            edge = [norm[i].as_py() if r == 0 else None for i, r in zip(at[:1], runs[:1], strict=True)] + [None] * max(0, len(at) - 1)
            if len(at):
                # the newest run may be the last of the range: it is held until the next one begins
                if held and runs[0] > 0:
                    yield held.pop()
                rows = b.column("_row").take(pa.array(at))
                if len(at) > 1:
                    yield out(rows[:-1], runs[:-1], edge[:-1])
                held = [out(rows[-1:], runs[-1:], edge[-1:])]
                run = int(runs[-1])
        if held:
            (h,) = held
            yield h.set_column(5, "edge", pa.array([last], pa.binary()))

    marked = _sorted(docs, doc_id, text, docs.columns).select("_norm", "_row")
    schema = StructType([marked.schema["_row"]]).add("pid", "integer").add("run", "long").add("keep", "long").add("size", "long").add("edge", "binary")
    kept = stored(marked.mapInArrow(heads, schema))
    later = _edge_chains(kept.filter("edge IS NOT NULL")).filter("later").select("pid", "run")
    out = kept.join(F.broadcast(later), ["pid", "run"], "left_anti").select("_row.*")
    return out.select(*(F.col(f"`{f.name}`") for f in fields))

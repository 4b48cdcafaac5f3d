"""Packing documents into windows by best fit in falling order, over all documents at once.

Documents are tokenized; longer ones are first cut into full windows, and what is left over is a short piece. Short pieces
differ in nothing but their length, so the packing is decided on the histogram of lengths (at most one row a length): a
segment tree indexed by the room left in open windows finds the tightest window that still takes a piece, and windows with
the same content are handled together. The steps that this gives tell the place of the r-th piece of each length; ranks are
taken inside hash buckets of a length, so no length, however frequent, meets in one task. The outcome is that of best fit in
falling order run piece by piece over the whole table.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locuswise.llm.common import stored, whole_text
from locuswise.llm.packing import encoder

#: pieces of a length that meet in one task, about; and buckets of a length at least
BUCKET, BUCKETS = 1 << 15, 256


def pieces(docs: DataFrame, vocab: str, *, doc_id: str = "doc_id", text: str = "text", limit: int = 1024, end: int = 0) -> DataFrame:
    """doc_id, row, start, length, ids_crc32, doc_tokens of each piece: full windows, then what is left over. ``row`` tells repeated rows apart."""

    def run(batches):
        enc, close = encoder(vocab), np.asarray([end], "<u4").tobytes()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                own, rows = [], []
                for i, ids in enumerate(enc.batch(part.column("text").to_pylist())):
                    ids += close
                    n = len(ids) // 4
                    for s in range(0, n, limit):
                        own.append(i)
                        rows.append((s, min(limit, n - s), zlib.crc32(ids[4 * s : 4 * (s + limit)]), n))
                take = pa.array(own, pa.int64())
                cols = [part.column("doc_id").take(take), part.column("row").take(take), *(pa.array(x, pa.int64()) for x in zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens"])

    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.monotonically_increasing_id().alias("row"), whole_text(f"`{text}`").alias("text"))
    return slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, row bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


class RoomTree:
    """Segment tree over the rooms 1 to ``limit``: a leaf counts the groups of open windows with that room, a node those below it."""

    def __init__(self, limit: int):
        self.size = 1 << limit.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        k = room + self.size
        while k:
            self.count[k] += n
            k >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` that an open window has."""
        count, k = self.count, least + self.size
        while not count[k]:
            # the next subtree to the right; none is left once the path runs along the right edge
            while k & 1:
                k >>= 1
            if not k:
                return None
            k += 1
        while k < self.size:
            k *= 2
            if not count[k]:
                k += 1
        return k - self.size


def steps(counts: dict[int, int], limit: int) -> np.ndarray:
    """Best fit in falling order of ``counts[length]`` pieces: rows (length, rank, n, each, window, offset).

    The pieces of ``length`` from ``rank`` on, ``n`` of them, go ``each`` to a window, into windows numbered from ``window`` on,
    where ``offset`` tokens lie already. A piece goes to the tightest window; it stays the tightest for pieces of its length
    until it has no room for another, so windows with the same room take their pieces alike and are one group.
    """
    tree = RoomTree(limit)
    groups: list[list[tuple[int, int]]] = [[] for _ in range(limit + 1)]  # by room: first window, number of windows
    made, out = 0, []

    def leave(room: int, first: int, n: int) -> None:
        if n and room:
            groups[room].append((first, n))
            tree.add(room, 1)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, n = limit, made, -(-left // (limit // length))
                made += n
            else:
                first, n = groups[room].pop()
                tree.add(room, -1)
            each = room // length
            full = min(n, left // each)
            for windows, take in ((full, each), (1, left % each if full < n else 0)):
                if windows and take:
                    out.append((length, rank, windows * take, take, first, limit - room))
                    leave(room - take * length, first, windows)
                    rank, left, first, n = rank + windows * take, left - windows * take, first + windows, n - windows
            leave(room, first, n)
    return np.array(out, np.int64).reshape(-1, 6)


def ranked(short: DataFrame, total: int) -> DataFrame:
    """``short`` (a stored table) with ``rank``: the number of the row among those of its length, from 0."""
    buckets = max(BUCKETS, -(-total // BUCKET))
    dealt = short.withColumn("_b", F.pmod(F.xxhash64("row", "start"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "_b").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = dealt.withColumn("_k", F.row_number().over(Window.partitionBy("length", "_b").orderBy("row", "start")))
    return inside.join(before, ["length", "_b"]).withColumn("rank", F.col("_before") + F.col("_k") - 1).drop("_b", "_n", "_before", "_k")


def pack_windows(parts: DataFrame, *, limit: int = 1024) -> DataFrame:
    """``parts`` (a stored table of pieces with row, start, length) plus sequence_id and offset."""
    full = parts.filter(F.col("length") >= limit).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    short = parts.filter(F.col("length") < limit)
    counts = {r["length"]: r["n"] for r in short.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a row a length below the limit
    plan = steps(counts, limit)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    shared = parts.sparkSession.sparkContext.broadcast(plan)
    names = parts.columns

    def place(batches):
        p = shared.value
        starts = (p[:, 0] << 48) + p[:, 1]
        for b in batches:
            length, rank = np.asarray(b.column("length")), np.asarray(b.column("rank"))
            at = p[np.searchsorted(starts, (length << 48) + rank, "right") - 1]
            nth = rank - at[:, 1]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(at[:, 4] + nth // at[:, 3]), pa.array(at[:, 5] + nth % at[:, 3] * length)], names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    placed = ranked(short, sum(counts.values())).select(*names, "rank").mapInArrow(place, f"{fields}, sequence_id bigint, offset bigint")
    return full.unionByName(placed)


def windows(docs: DataFrame, vocab: str, *, doc_id: str = "doc_id", text: str = "text", limit: int = 1024, end: int = 0) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece.

    Every row of ``docs`` becomes pieces, repeated rows and rows without an id too; a null text counts as empty and is one
    piece of the end id. Full windows have numbers below 0. Pieces of equal length are interchangeable and go by bucket and row
    number. Extra columns are not read; an empty table gives an empty result.
    """
    parts = stored(pieces(docs, vocab, doc_id=doc_id, text=text, limit=limit, end=end))
    return pack_windows(parts, limit=limit).drop("row")

"""SentencePiece encoding and decoding over a relational lattice.

Texts are divided where no piece can reach over: between two characters that no piece has side by side. The distinct segments
are counted; the frequent ones get a lattice: substrings up to the longest piece are exploded and joined with the piece table,
edges are grouped by segment, and a higher-order aggregate folds them. For a unigram model the fold is Viterbi's. A merge
model (BPE) is not the best path of its scores, so its fold takes edges by falling score from left to right, and an edge
that spans exactly two symbols merges them; this is exact where each piece is itself made of two symbols when its turn comes,
which is checked for every piece. Runs of blanks (whose pieces share one score), segments that are too rare for the shipped
table, and those too long for a 64-bit set of boundaries are merged inside the tasks, pair by pair.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import cached_property
from itertools import filterfalse
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from locuswise.llm.common import most_frequent, scratch, stored, whole_text

SPACE = "▁"
#: bound of the table of encoded segments that is shipped; longest segment that has a lattice
FREQUENT, LONGEST = 1 << 18, 60
#: bytes of a worker's memory of counted or encoded chunks; what an entry takes besides its key and value
MEMORY, ENTRY = 64 << 20, 200
UNIGRAM, BPE = 1, 2


@dataclass(frozen=True)
class Pieces:
    """What a model file says: pieces by id with scores, and the kind of model."""

    kind: int
    names: list[str]
    scores: list[float]
    byte_ids: list[int]  # by byte
    normal: dict[str, int]  # pieces that text can have

    @staticmethod
    def load(path: str) -> Pieces:
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        n = m.normalizer_spec
        if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix or not n.escape_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: only models that leave text as it is, but for a blank in front, are supported")
        by_byte = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == 6}
        return Pieces(m.trainer_spec.model_type, [p.piece for p in m.pieces], [p.score for p in m.pieces], [by_byte[b] for b in range(256)], {p.piece: i for i, p in enumerate(m.pieces) if p.type == 1})

    @cached_property
    def side_by_side(self) -> set[str]:
        return {p[i : i + 2] for p in self.normal for i in range(len(p) - 1)}

    @cached_property
    def rank(self) -> dict[str, int]:
        """Pieces of two characters or more: 0 for the best score, equal scores alike."""
        scores = sorted({self.scores[i] for p, i in self.normal.items() if len(p) > 1}, reverse=True)
        at = {s: k for k, s in enumerate(scores)}
        return {p: at[self.scores[i]] for p, i in self.normal.items() if len(p) > 1}

    @cached_property
    def blank_inside(self) -> bool:
        """Whether a piece has a blank after another character."""
        return any(b[1] == SPACE != b[0] for b in self.side_by_side)

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.normal), default=1)

    def segments(self, text: str) -> list[str]:
        """Parts of an escaped text between which no piece reaches."""
        ok = self.side_by_side
        cuts = [i for i, pair in enumerate(map(add, text, text[1:]), 1) if pair not in ok]
        if not cuts:
            return [text]
        return [text[i:j] for i, j in zip([0, *cuts], [*cuts, len(text)], strict=True)]

    def merged(self, segment: str) -> list[int]:
        """Starts of the symbols of a segment after merging the best-scored (then leftmost) pair again and again."""
        n, rank = len(segment), self.rank.get
        after, before = [*range(1, n + 1), n], list(range(-1, n))  # of a symbol's start
        alive = bytearray([1]) * (n + 1)
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(segment[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, s, m, e = heapq.heappop(heap)
            if not (alive[s] and alive[m] and after[s] == m and after[m] == e):
                continue  # one of the two has grown meanwhile
            alive[m] = 0
            after[s] = e
            if e < n:
                before[e] = s
                if (r := rank(segment[s : after[e]])) is not None:
                    heapq.heappush(heap, (r, s, e, after[e]))
            if s and (r := rank(segment[before[s] : e])) is not None:
                heapq.heappush(heap, (r, before[s], s, e))
        return [i for i in range(n) if alive[i]]

    def ids(self, segment: str, starts: list[int]) -> list[int]:
        """Ids of the symbols; a character without a piece gives the ids of its bytes."""
        out = []
        for s, e in zip(starts, [*starts[1:], len(segment)], strict=True):
            i = self.normal.get(segment[s:e])
            if i is None:
                out += [self.byte_ids[b] for b in segment[s:e].encode("utf-8", "surrogatepass")]
            else:
                out.append(i)
        return out

    def check(self) -> None:
        """Each piece but runs of blanks must consist of two symbols when edges of better score than its own are folded in their order."""
        for p, r in self.rank.items():
            if SPACE * 2 in p:
                continue
            n = len(p)
            inner = sorted((x, i, j) for i in range(n - 1) for j in range(i + 2, n + 1) if (x := self.rank.get(p[i:j])) is not None and x < r)
            ends = set(range(n + 1))
            for _, s, e in inner:
                inside = [b for b in ends if s < b < e]
                if s in ends and e in ends and len(inside) == 1:
                    ends.discard(inside[0])
            if len(ends) != 3:
                raise ValueError(f"the piece {p!r} isn't made of two others: the fold would not be exact")


@dataclass(frozen=True)
class Masks:
    """Boundaries of encoded segments in flat arrays, by the hash of the segment; the segment itself decides."""

    hashes: np.ndarray
    ends: np.ndarray  # of the segments in ``data``, one more in front
    data: bytes
    masks: np.ndarray

    @staticmethod
    def of(made: pa.Table) -> Masks:
        names = made["segment"].to_pylist()
        raw = [x.encode() for x in names]
        hashes = np.fromiter(map(xxh3_64_intdigest, raw), np.uint64, len(raw))
        order = np.argsort(hashes, kind="stable")
        raw = [raw[i] for i in order]
        ends = np.cumsum([0, *map(len, raw)], dtype=np.int64)
        return Masks(hashes[order], ends, b"".join(raw), made["mask"].to_numpy().astype(np.int64)[order])

    def get(self, segment: str) -> int | None:
        b = segment.encode("utf-8", "surrogatepass")
        h = np.uint64(xxh3_64_intdigest(b))
        i = int(self.hashes.searchsorted(h))
        while i < len(self.hashes) and self.hashes[i] == h:
            if self.data[self.ends[i] : self.ends[i + 1]] == b:
                return int(self.masks[i])
            i += 1
        return None


class Remembered(dict):
    """Encoded chunks, emptied when keys and values take more than MEMORY bytes."""

    def __init__(self):
        super().__init__()
        self.size = 0

    def put(self, key: str, value: bytes) -> None:
        self.size += len(key) + len(value) + ENTRY
        self[key] = value

    def trim(self) -> None:
        if self.size > MEMORY:
            self.clear()
            self.size = 0


def escaped(text: str) -> str:
    """Blanks as the piece table has them, one more in front; nothing of nothing."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def lattice(segments: DataFrame, pieces: Pieces, singles: bool) -> DataFrame:
    """segment, edges: arrays of (order, s, e, score) with the pieces of two characters and more (``singles``: of one too, unknown ones at ten below
    the worst score). Needs segments of at most LONGEST characters."""
    spark = segments.sparkSession
    worst = min(pieces.scores) - 10.0
    rows = [(p, 0 if singles else pieces.rank[p], pieces.scores[i]) for p, i in pieces.normal.items() if singles or len(p) > 1]
    table = spark.createDataFrame(rows, "piece string, rank int, score double")  # as large as the model file
    n = F.char_length("segment")
    subs = segments.select("segment", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("s"))
    subs = subs.select("segment", "s", F.explode(F.sequence(F.col("s") + 1, F.least(F.col("n"), F.col("s") + pieces.longest))).alias("e"))
    subs = subs.filter(F.lit(singles) | (F.col("e") > F.col("s") + 1)).withColumn("piece", F.substring("segment", F.col("s") + 1, F.col("e") - F.col("s")))
    edges = subs.join(F.broadcast(table), "piece", "left").filter(F.col("rank").isNotNull() | (F.lit(singles) & (F.col("e") == F.col("s") + 1)))
    edge = F.struct(F.coalesce("rank", F.lit(0)).alias("order"), "s", "e", F.coalesce("score", F.lit(worst)).alias("score"))
    # the longest segment has LONGEST times the longest piece edges: groups are bounded
    return edges.groupBy("segment").agg(F.sort_array(F.collect_list(edge)).alias("edges"))


def merge_fold(edges: Column, n: Column) -> Column:
    """Set of boundaries (bit i: a symbol begins or ends at i) after merging along the edges in their order."""
    one = F.lit(1).cast("long")
    shl, shr = (lambda x, k: F.call_function("shiftleft", x, k)), (lambda x, k: F.call_function("shiftrightunsigned", x, k))

    def step(mask: Column, edge: Column) -> Column:
        inside = shr(mask, edge["s"] + 1).bitwiseAND(shl(one, edge["e"] - edge["s"] - 1) - 1)
        ends = shr(mask, edge["s"]).bitwiseAND(shr(mask, edge["e"])).bitwiseAND(one)
        return F.when((ends == 1) & (F.bit_count(inside) == 1), mask - shl(inside, edge["s"] + 1)).otherwise(mask)

    return F.aggregate(edges, shl(one, n + 1) - 1, step)


def viterbi_fold(edges: Column, n: Column) -> Column:
    """Set of boundaries on the path of the largest sum of scores; edges come by start, then end. Of equal sums the first edge wins."""
    one = F.lit(1).cast("long")
    shl = lambda x, k: F.call_function("shiftleft", x, k)
    start = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(F.when(i == 0, 0.0).otherwise(float("-inf")).alias("w"), F.lit(0).alias("back")))

    def step(best: Column, edge: Column) -> Column:
        w = F.get(best, edge["s"])["w"] + edge["score"]
        return F.transform(best, lambda x, i: F.when((i == edge["e"]) & (w > x["w"]), F.struct(w.alias("w"), edge["s"].alias("back"))).otherwise(x))

    def walk(best: Column) -> Column:
        first = F.struct(n.alias("at"), shl(one, n).alias("mask"))
        back = lambda a: F.get(best, a["at"])["back"]
        return F.aggregate(F.sequence(F.lit(1), n), first, lambda a, _: F.struct(back(a).alias("at"), a["mask"].bitwiseOR(shl(one, back(a))).alias("mask")))["mask"]

    return F.aggregate(edges, start, step, walk)


def folded(segments: DataFrame, pieces: Pieces) -> DataFrame:
    """segment, mask of boundaries, for segments of 1 to LONGEST characters."""
    unigram = pieces.kind == UNIGRAM
    n = F.char_length("segment")
    fold = viterbi_fold(F.col("edges"), n) if unigram else merge_fold(F.col("edges"), n)
    made = lattice(segments, pieces, singles=unigram).select("segment", fold.alias("mask"))
    all_ends = F.call_function("shiftleft", F.lit(1).cast("long"), n + 1) - 1
    return segments.join(made, "segment", "left").select("segment", F.coalesce("mask", all_ends).alias("mask"))


def segment_counts(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """segment, c over the column ``text``; ``shared`` is the piece table. Partial counts are made in the tasks."""

    def run(batches):
        p = shared.value
        chunk_counts: Counter[str] = Counter()
        total: Counter[str] = Counter()  # of segments
        size = 0

        def out():
            for chunk, k in chunk_counts.items():
                for s in p.segments(chunk):
                    total[s] += k
            made = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["segment", "c"])
            chunk_counts.clear()
            total.clear()
            return made

        for b in batches:
            for t in b.column("text"):
                parts = chunks(t.as_py(), p)
                if len(parts) == 1:  # maybe a whole text: not worth remembering
                    before = len(total)
                    segments = p.segments(parts[0])
                    total.update(segments)
                    size += (len(total) - before) * ENTRY
                else:
                    before = len(chunk_counts)
                    chunk_counts.update(parts)
                    size += (len(chunk_counts) - before) * ENTRY
                if size > MEMORY // 2:
                    yield out()
                    size = 0
        if chunk_counts or total:
            yield out()

    return docs.select("text").mapInArrow(run, "segment string, c bigint").groupBy("segment").agg(F.sum("c").alias("c"))


def id_type(n: int) -> type:
    """Unsigned 16-bit numbers as long as the table of ``n`` pieces allows it."""
    return np.uint16 if n <= 1 << 16 else np.uint32


def chunks(text: str, pieces: Pieces) -> list[str]:
    """The escaped text cut in front of single blanks; whole where blanks stand together, where the table's own blank occurs, or where a piece would
    reach over a blank from the left."""
    if not text:
        return []
    if pieces.blank_inside or "  " in text or SPACE in text or text[0] == " ":
        return [escaped(text)]
    return [SPACE + x for x in text.split(" ")]


def encode(docs: DataFrame, model: str, *, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """doc_id, text, ids (unsigned 16-bit little-endian, 32-bit for tables of more than 65,536 pieces): one row per input row.

    Ids are those of the library. A null or empty text has no ids; texts are read whole; repeated rows are encoded each; extra columns are not
    read; an empty table gives an empty result.
    """
    pieces = Pieces.load(model)
    if pieces.kind != BPE:
        raise ValueError(f"{model}: encoding of whole texts is for merge models; folded() serves unigram tables")
    pieces.check()
    slim = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(pieces)
    with scratch():
        counts = stored(segment_counts(slim, shared).filter((F.char_length("segment") <= LONGEST) & ~F.contains("segment", F.lit(SPACE * 2))))
        chosen = stored(most_frequent(counts, frequent).select("segment"))
        table = sc.broadcast(Masks.of(folded(chosen, pieces).toArrow()))  # at most ``frequent`` rows
    code = id_type(len(pieces.names))

    def run(batches):
        p, masks = shared.value, table.value
        memo, known = Remembered(), Remembered()

        def of_segment(s: str) -> bytes:
            mask = masks.get(s)
            starts = p.merged(s) if mask is None else [i for i in range(len(s)) if mask >> i & 1]
            return np.array(p.ids(s, starts), code).tobytes()

        def of_chunk(c: str) -> bytes:
            segments = p.segments(c)
            if len(segments) == 1:  # remembered as a chunk
                return of_segment(segments[0])
            parts = []
            for s in segments:
                b = known.get(s)
                if b is None:
                    known.trim()
                    known.put(s, b := of_segment(s))
                parts.append(b)
            return b"".join(parts)

        for b in batches:
            out = []
            for t in b.column("text"):
                parts = chunks(t.as_py(), p)
                if len(parts) == 1:  # maybe a whole text: not remembered
                    out.append(of_chunk(parts[0]))
                    continue
                memo.trim()
                for c in set(filterfalse(memo.__contains__, parts)):
                    memo.put(c, of_chunk(c))
                out.append(b"".join(map(memo.__getitem__, parts)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(out, pa.binary())], names=["doc_id", "text", "ids"])

    return slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, text string, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with the column ``decoded``: the text of ``ids``; bytes that are no UTF-8 become replacement characters."""
    pieces = Pieces.load(model)
    byte_of = {i: b for b, i in enumerate(pieces.byte_ids)}
    parts = [bytes([byte_of[i]]) if i in byte_of else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces.names)]
    shared = encoded.sparkSession.sparkContext.broadcast(parts)
    code = id_type(len(parts))

    @F.arrow_udf("string")
    def text_of(ids: pa.Array) -> pa.Array:
        part = shared.value
        out = []
        for x in ids:
            t = b"".join(map(part.__getitem__, np.frombuffer(x.as_py(), code).tolist())).decode("utf-8", "replace")
            out.append(t[1:] if t[:1] == " " else t)
        return pa.array(out, pa.string())

    return encoded.withColumn("decoded", text_of("ids"))


def digest(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (of unsigned 32-bit little-endian ids), round_trip of decoded texts (a blank of the piece table counts as a blank)."""

    code = id_type(len(Pieces.load(model).names))

    @F.arrow_udf("struct<n:bigint,crc:bigint>")
    def of(ids: pa.Array) -> pa.Array:
        wide = [np.frombuffer(x.as_py(), code).astype("<u4") for x in ids]
        return pa.StructArray.from_arrays([pa.array([len(w) for w in wide], pa.int64()), pa.array([zlib.crc32(w.tobytes()) for w in wide], pa.int64())], names=["n", "crc"])

    same = F.col("decoded") == F.replace(F.col("text"), F.lit(SPACE), F.lit(" "))
    return encoded.withColumn("d", of("ids")).select("doc_id", F.col("d.n").alias("n_pieces"), F.col("d.crc").alias("ids_crc32"), same.alias("round_trip"))

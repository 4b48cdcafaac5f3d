"""Packing documents into sequences: best fit, then a swap-based local search between underfull bins.

Documents are tokenized and cut into pieces; full pieces are sequences of their own. The others are dealt to shards by a
hash. In a shard, best fit in falling order fills bins; then tokens are moved from emptier to fuller bins (a document moves,
or is exchanged for one or two others), which raises the sum of squared fills, until bins run empty. Bins that stay underfull
are opened and packed again together with those of other shards, in rounds that shrink.
"""

from __future__ import annotations

import json
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuswise.llm.common import stored, whole_text
from locuswise.llm.tokens import WORDS, byte_letters

#: pieces that one task packs at a time
SHARD = 8_192
#: emptiest bins that give tokens away in one round of the search, rounds, and rounds over shards
DONORS, SWEEPS, ROUNDS = 48, 6, 6
#: texts that both libraries have to agree on before one stands in for the other
PROBE = ("", " ", "a", "The cat's 12 hats,\n\tand they'll go.  \r\n  ", "\u00e9t\u00e9 \u6f22\u5b57 \U0001f600\u200d\x85\xa0x", "x" * 700, "\x1c\u2028 ~~~ __init__ 3.14159")


class Encoder:
    """Token ids as little-endian 32-bit bytes, as the ``tokenizers`` library gives them for a vocabulary file.

    Whole texts are encoded by ``tiktoken`` with the vocabulary and word pattern of the same file, which gives the same ids in a
    third of the time (a fixed set of texts is compared when the file is loaded). Texts that hold a special string go to the
    library itself. Nothing is remembered between texts.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"][a + b] for a, b in pairs]
        if ids != sorted(ids):
            raise ValueError(f"{path}: merges must come in the order of ids")
        byte = byte_letters()
        ranks = {bytes(byte[c] for c in k): i for k, i in model["vocab"].items()}
        self.bpe = tiktoken.Encoding("words", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        if self.batch(list(PROBE)) != self._encode(list(PROBE)):
            raise ValueError(f"{path}: the two libraries differ")

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def batch(self, texts: list[str]) -> list[bytes]:
        encode, special = self.bpe.encode_ordinary, self.special
        return [self._encode([t])[0] if any(s in t for s in special) else array("I", encode(t)).tobytes() for t in texts]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: whole if it fits, else full pieces after a first that may be shorter."""
    if n <= limit:
        return [(0, n)]
    first = n % limit or limit
    return [(0, first), *((s, limit) for s in range(first, n, limit))]


def pieces(docs: DataFrame, vocab: str, *, doc_id: str = "doc_id", text: str = "text", limit: int = 1024, end: int = 2) -> DataFrame:
    """doc_id, row, piece, start, length, ids_crc32 of each piece; ``row`` tells repeated rows apart. Null text counts as empty: the end id alone."""

    def run(batches):
        enc, close = encoder(vocab), np.asarray([end], "<u4").tobytes()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                own, rows = [], []
                for i, ids in enumerate(enc.batch(part.column("text").to_pylist())):
                    ids += close
                    for p, (s, n) in enumerate(cut(len(ids) // 4, limit)):
                        own.append(i)
                        rows.append((p, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])))
                p, s, n, c = zip(*rows, strict=True)
                take = pa.array(own, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(take), part.column("row").take(take), pa.array(p, pa.int32()), *(pa.array(x, pa.int64()) for x in (s, n, c))],
                    names=["doc_id", "row", "piece", "start", "length", "ids_crc32"],
                )

    # the row number depends on the scan's splits alone, so a task that runs again gives the same
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"), whole_text(text).alias("text"))
    return slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(lengths: np.ndarray, limit: int) -> list[list[int]]:
    """Bins of item numbers: items in falling length, each into the fullest bin that still takes it."""
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(limit + 1)]  # bins by room left
    some = 0  # bit r: a bin with room r exists
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        above = some >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                some &= ~(1 << room)
            bins[b].append(i)
        else:
            b, room = len(bins), limit
            bins.append([i])
        if room > n:
            free[room - n].append(b)
            some |= 1 << (room - n)
    return bins


def _transfer(room: int, taker: list[int], donor: list[int], size: list[int]) -> tuple[int, list[int], list[int]] | None:
    """The exchange that brings most tokens, at most ``room``, from ``donor`` to ``taker``: (tokens, given by donor, given back)."""
    best = None
    gain = 0
    for x in donor:
        n = size[x]
        if gain < n <= room:
            best, gain = (n, [x], []), n
        for k, y in enumerate(taker):
            d = n - size[y]
            if gain < d <= room:
                best, gain = (d, [x], [y]), d
            if d > gain:  # one of the donor's for two of the taker's
                for z in taker[k + 1 :]:
                    e = d - size[z]
                    if gain < e <= room:
                        best, gain = (e, [x], [y, z]), e
        if gain == room:
            return best
    for k, x in enumerate(donor):
        for z in donor[k + 1 :]:
            pair = size[x] + size[z]
            for y in taker:
                d = pair - size[y]
                if gain < d <= room:
                    best, gain = (d, [x, z], [y]), d
        if gain == room:
            break
    return best


def improve(bins: list[list[int]], lengths: np.ndarray, limit: int) -> list[list[int]]:
    """Local search over underfull bins; every step moves tokens from an emptier to a fuller bin, so squared fill rises and the search ends."""
    size = lengths.tolist()
    fill = [sum(size[i] for i in b) for b in bins]
    least = -(-sum(fill) // limit)
    alive = [k for k in range(len(bins)) if fill[k] < limit]
    count = len(bins)
    for _ in range(SWEEPS):
        if count <= least:
            break
        changed = False
        alive = sorted((k for k in alive if 0 < fill[k] < limit), key=lambda k: (fill[k], k))
        for d in alive[:DONORS]:
            # fullest first: they need least
            for t in reversed(alive):
                if not fill[d]:
                    break
                if t == d or fill[t] < fill[d] or fill[t] >= limit or not fill[t]:
                    continue
                step = _transfer(limit - fill[t], bins[t], bins[d], size)
                if step:
                    n, out, back = step
                    bins[d] = [x for x in bins[d] if x not in out] + back
                    bins[t] = [x for x in bins[t] if x not in back] + out
                    fill[d] -= n
                    fill[t] += n
                    changed = True
            if not fill[d]:
                count -= 1
                if count <= least:
                    break
        if not changed:
            break
    return [b for b in bins if b]


def pack(lengths: np.ndarray, limit: int) -> list[list[int]]:
    return improve(best_fit(lengths, limit), lengths, limit)


def _packer(limit: int, round_: int, last: bool):
    """Packs the pieces of one shard; ``_open`` marks the pieces of bins that go to the next round."""

    def pack_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="_shard").sort_values(["length", "row", "piece"], ignore_index=True)
        lengths = rows["length"].to_numpy()
        at, seq, offset, again = [], [], [], []
        for k, b in enumerate(pack(lengths, limit)):
            ends = np.cumsum(lengths[b])
            at += b
            seq += [(round_ << 56) + (int(key[0]) << 20) + k] * len(b)
            offset += [0, *ends[:-1].tolist()]
            again += [bool(not last and ends[-1] < limit)] * len(b)
        return rows.iloc[at].reset_index(drop=True).assign(sequence_id=seq, offset=offset, _open=again)

    return pack_shard


def pack_pieces(parts: DataFrame, *, limit: int = 1024) -> DataFrame:
    """``parts`` (a stored table of pieces with ``length``) plus sequence_id and offset."""
    full = parts.filter(F.col("length") >= limit).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    keys = parts.filter(F.col("length") < limit)
    names = parts.columns
    schema = parts.schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    done, left, n = [full], keys, keys.count()
    for round_ in range(ROUNDS):
        shards = max(1, -(-n // SHARD))
        last = shards == 1 or round_ == ROUNDS - 1

        shard = F.pmod(F.xxhash64("row", "piece", F.lit(round_)), F.lit(shards))
        packed = left.withColumn("_shard", shard).groupBy("_shard").applyInPandas(_packer(limit, round_, last), f"{fields}, sequence_id bigint, offset bigint, _open boolean")
        packed = stored(packed)
        done.append(packed.filter("NOT _open").drop("_open"))
        if last:
            break
        left = packed.filter("_open").select(*names)
        m = left.count()
        if not m:
            break
        if m > 0.9 * n:  # further rounds would not shrink it: what is underfull stays so
            done.append(packed.filter("_open").drop("_open"))
            break
        n = m
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def packed_documents(docs: DataFrame, vocab: str, *, doc_id: str = "doc_id", text: str = "text", limit: int = 1024, end: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    Every row of ``docs`` becomes pieces, repeated rows and rows without an id too; a null text counts as empty and is one
    piece of the end id. Extra columns are not read; an empty table gives an empty result; ties in length go by row number.
    """
    parts = stored(pieces(docs, vocab, doc_id=doc_id, text=text, limit=limit, end=end))
    return pack_pieces(parts, limit=limit).drop("row")

"""Spelling variants: frequent words, their neighbours at one edit, and the form that each rare word stands for.

Words are counted in tasks and summed by Spark. Two words at one edit share the first or the second half of either of them
exactly. So each word goes, as an entry, to the shards of the halves that a neighbour of it may have, and, as a query, to the
shards of its own halves and its neighbours' lengths. A shard builds a bidirectional FM-index over its delimited words (one of
the words, one of the words reversed) and runs the two search schemes of one error: the first half is matched exactly from the
left and the search extends to the right, or the second half from the right and the search extends to the left; one inserted,
deleted or replaced letter is allowed on the way. A search state is an interval of suffix ranks.

A half with many words is split over several blocks, each an index of its own that the half's queries visit.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuswise.llm.common import stored, whole_text

#: one in so many occurrences loses a letter
ONE_IN = 97
LETTERS, LEAST, OCCURRENCES = 5, 5, 3
#: words that a task counts, and MB of text it reads, before it hands its counts on
HELD, HELD_BYTES = 1 << 18, 64 << 20
#: entries of a shard, entries of a half in a block, queries that a shard searches at a time
SHARD, BLOCK, QUERIES = 1 << 16, 1 << 14, 1 << 13
#: letters in code-point order; 0 is the delimiter
ALPHABET = "".join(map(chr, (*range(0x61, 0x7B), *range(0xC0, 0x100))))
SUBSTITUTE, INSERT, DELETE = range(3)


def word_counts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n of all words of at least ``LEAST`` letters, after the deletions; a null id counts as an empty one."""
    runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST)

    def run(batches):
        total: Counter[bytes] = Counter()
        read = 0

        def counted():
            words = [w.decode("latin-1") for w in total]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                # one byte a letter; what is not in Latin-1 becomes a question mark, which is no letter either
                words = runs.findall(t.as_py().encode("latin-1", "replace").lower())
                total.update(words)
                start = zlib.crc32(f"{i}:".encode())
                for w in set(words):
                    h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                    if not h % ONE_IN:
                        n, k = words.count(w), h % len(w)
                        total[w] -= n
                        if len(w) > LEAST:
                            total[w[:k] + w[k + 1 :]] += n
                read += sum(map(len, words))
                if len(total) > HELD or read > HELD_BYTES:
                    yield counted()
                    read = 0
        yield counted()

    slim = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("doc_id"), whole_text(f"`{text}`").alias("text"))
    return slim.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class SuffixRanks:
    """FM-index over sorted distinct words, each followed and the first preceded by the delimiter 0."""

    def __init__(self, words: list[np.ndarray]):
        text = np.zeros(sum(map(len, words)) + len(words) + 1, np.int64)
        at = 1
        for w in words:
            text[at : at + len(w)] = w
            at += len(w) + 1
        self.n, self.words = len(text), len(words)
        bwt = text[self._order(text) - 1]
        order = np.argsort(bwt, kind="stable")
        # place of the r-th occurrence of each letter: a rank query is one binary search, and gives the rank among all suffixes at once
        self.bwt, self.keys = bwt, bwt[order] * self.n + order

    @staticmethod
    def _order(text: np.ndarray) -> np.ndarray:
        """Suffixes in order, by doubling from nine letters on."""
        n, width = len(text), 9
        padded = np.concatenate([text, np.full(width, -1)]) + 1
        key = np.zeros(n, np.int64)
        for k in range(width):
            key = key * 92 + padded[k : k + n]
        while True:
            order = np.argsort(key, kind="stable")
            new = np.empty(n, np.int64)
            new[order] = np.r_[0, np.cumsum(np.diff(key[order]) != 0)]
            if new[order[-1]] == n - 1:
                return order
            after = np.zeros(n, np.int64)
            after[: max(0, n - width)] = new[width:] + 1
            key = new * (n + 1) + after
            width *= 2

    def extend(self, letter, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranks of ``letter`` put in front of what the ranks lo to hi begin with."""
        return np.searchsorted(self.keys, letter * self.n + lo), np.searchsorted(self.keys, letter * self.n + hi)

    def children(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, letter): the letters other than the delimiter that stand in front of each interval. Equal intervals are read once."""
        spans, of = np.unique(lo * (self.n + 1) + hi, return_inverse=True)
        a, size = spans // (self.n + 1), spans % (self.n + 1) - spans // (self.n + 1)
        own = np.repeat(np.arange(len(spans)), size)
        rows = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size) + a[own]
        found = np.unique(own * 128 + self.bwt[rows])
        found = found[found % 128 > 0]
        own, letter = found // 128, found % 128
        first, n = np.searchsorted(own, np.arange(len(spans))), np.bincount(own, minlength=len(spans))
        state = np.repeat(np.arange(len(of)), n[of])
        at = np.arange(len(state)) - np.repeat(np.cumsum(n[of]) - n[of], n[of]) + first[of][state]
        return state, letter[at]


def search(index: SuffixRanks, flat: np.ndarray, end: np.ndarray, size: np.ndarray, exact: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) of the words that arise from a query by one edit of its kind in front of its last ``exact`` letters.

    Query q is ``flat[end - size : end]``. States are (query, letters read, lo, hi).
    """
    letter = lambda q, j: flat[end[q] - 1 - j]
    q = np.arange(len(end))
    j, lo, hi = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), index.words + 1)
    erred = []
    while len(q):
        inner = j >= exact[q]
        for op in (SUBSTITUTE, INSERT, DELETE):
            at = np.flatnonzero(inner & (kind[q] == op) & ((j < size[q]) | (op == INSERT)))
            if not len(at):
                continue
            if op == DELETE:
                erred.append((q[at], j[at] + 1, lo[at], hi[at]))
                continue
            state, c = index.children(lo[at], hi[at])
            state = at[state]
            if op == SUBSTITUTE:
                other = c != letter(q[state], j[state])
                state, c = state[other], c[other]
            a, b = index.extend(c, lo[state], hi[state])
            erred.append((q[state], j[state] + (op == SUBSTITUTE), a, b))
        more = j < size[q]
        q, j, lo, hi = q[more], j[more], lo[more], hi[more]
        lo, hi = index.extend(letter(q, j), lo, hi)
        alive = lo < hi
        q, j, lo, hi = q[alive], j[alive] + 1, lo[alive], hi[alive]
    if not erred:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    q, j, lo, hi = (np.concatenate(x) for x in zip(*erred, strict=True))
    ends = []
    while len(q):
        done = j == size[q]
        ends.append((q[done], lo[done], hi[done]))
        q, j, lo, hi = q[~done], j[~done], lo[~done], hi[~done]
        lo, hi = index.extend(letter(q, j), lo, hi)
        alive = lo < hi
        q, j, lo, hi = q[alive], j[alive] + 1, lo[alive], hi[alive]
    q, lo, hi = (np.concatenate(x) for x in zip(*ends, strict=True))
    lo, hi = index.extend(0, lo, hi)
    whole = lo < hi
    # rank 0 is the last delimiter alone; the others are the words in order
    return q[whole], lo[whole] - 1


def shard_pairs(t: pa.Table) -> pa.Table:
    """word, near, near_n: the queries of one shard with their neighbours among its entries."""
    code = {ch: k for k, ch in enumerate(ALPHABET, 1)}
    entry = np.asarray(t["entry"].to_numpy(zero_copy_only=False), bool)
    words = np.array(t["word"].to_pylist(), object)
    count = dict(zip(words[entry], t["n"].to_numpy()[entry], strict=True))
    asked, side, kind = words[~entry], t["side"].to_numpy()[~entry], t["kind"].to_numpy()[~entry]
    out: list[tuple[str, str, int]] = []
    for s in (0, 1):
        turned = [(w if s else w[::-1], w) for w in count]
        turned.sort()
        index = SuffixRanks([np.fromiter((code[c] for c in w), np.int64, len(w)) for w, _ in turned])
        of = np.flatnonzero(side == s)
        for k in range(0, len(of), QUERIES):
            part = of[k : k + QUERIES]
            texts = [w if s else w[::-1] for w in asked[part]]
            flat = np.fromiter((code[c] for w in texts for c in w), np.int64)
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            exact = size - size // 2 if s else size // 2
            q, w = search(index, flat, np.cumsum(size), size, exact, kind[part])
            for a, b in set(zip(q.tolist(), w.tolist(), strict=True)):
                near = turned[b][1]
                out.append((asked[part[a]], near, count[near]))
    word, near, n = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"word": pa.array(word, pa.string()), "near": pa.array(near, pa.string()), "near_n": pa.array(n, pa.int64())})


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """word, near, near_n for every two words of a stored table (word, n) at one edit, both ways; a pair may come more than once."""
    m = F.char_length("word")
    half = lambda side, size: F.when(F.lit(side == 0), F.substr("word", F.lit(1), size)).otherwise(F.substr("word", m - size + 1, size))
    key = lambda side, size, length, kind: F.struct(F.lit(side).alias("side"), half(side, size).alias("half"), length.cast("int").alias("length"), F.lit(kind).alias("kind"))
    low, high = lambda n: F.floor(n / 2).cast("int"), lambda n: F.ceil(n / 2).cast("int")
    # the halves that neighbours of one letter less, as many, and one more can have
    entries = F.array_distinct(F.array(*(key(s, f(m + d), m, -1) for s, f in ((0, low), (1, high)) for d in (-1, 0, 1))))
    queries = F.array(*(key(s, f(m), m + d, k) for s, f in ((0, low), (1, high)) for d, k in ((0, SUBSTITUTE), (1, INSERT), (-1, DELETE))))
    exploded = lambda keys: vocabulary.select("word", "n", F.explode(keys).alias("k")).select("word", "n", "k.*")
    posted = stored(exploded(entries))
    by = ["side", "half", "length"]
    blocks = stored(posted.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    shards = max(1, -(-posted.count() // SHARD))
    shard = F.pmod(F.xxhash64(*by, "block"), F.lit(shards)).alias("shard")
    placed = posted.join(blocks, by).withColumn("block", F.pmod(F.xxhash64("word"), "blocks").cast("int"))
    # a query visits all blocks of its half; halves that no entry has go nowhere
    asked = exploded(queries).join(blocks, by).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = placed.select(shard, F.lit(True).alias("entry"), "side", "kind", "word", "n").unionByName(asked.select(shard, F.lit(False).alias("entry"), "side", "kind", "word", "n"))
    return rows.repartition(shards, "shard").groupBy("shard").applyInArrow(shard_pairs, "word string, near string, near_n bigint")


def roots(links: DataFrame) -> DataFrame:
    """word, root of a stored table (word, form) without cycles: each round doubles the way that a pointer spans."""
    at = links.select("word", F.col("form").alias("root"))
    while True:
        above = at.select(F.col("word").alias("root"), F.col("root").alias("top"))
        jumped = stored(at.join(above, "root", "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")))
        at = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = OCCURRENCES, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of ``LEAST`` letters and ``least`` occurrences.

    ``form`` is the nearest word of largest count (of equal counts the first in code-point order) if it occurs ``ratio`` times as
    often at least, else null; ``root`` is the end of the chain of forms, the word itself where there is none. Null and empty
    texts have no words, repeated rows count each, a null id counts as an empty one; extra columns are not read; an empty table
    gives an empty result. Texts are read whole, and a word may have any length.
    """
    vocabulary = stored(word_counts(docs, doc_id=doc_id, text=text).filter(F.col("n") >= least))
    near = near_pairs(vocabulary).groupBy("word").agg(F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"), F.size(F.collect_set("near")).cast("long").alias("n_near"))
    best_n = -F.col("best.less")
    often = best_n >= ratio * F.col("n")
    forms = stored(
        vocabulary.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(often, F.col("best.form")).alias("form"), F.when(often, best_n).alias("form_n"))
    )
    ends = roots(forms.filter(F.col("form").isNotNull()))
    return forms.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

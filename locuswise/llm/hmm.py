"""Scores of texts under a hidden Markov language model.

Words are counted over all training texts. States emit word classes: the most frequent words are classes of their own, the
rest share classes by hash, inside which a word has its share of the class's count. Baum-Welch counts are computed in tasks
over all training sequences and summed across partitions; the scaled forward recursion gives the exact likelihood of a text.

Counts reach the tasks in two ways: words above a count that at most FREQUENT words exceed are broadcast, all others are
joined by word, so nothing that is shipped grows with the vocabulary and no word goes uncounted.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswise.llm.common import most_frequent, remainder, stored, whole_text

#: bound of the broadcast word table; classes of single words; classes of hashed words (class 0 is the end of a text)
FREQUENT, OWN_CLASSES, HASH_CLASSES = 1 << 18, 1 << 14, 1 << 12
STATES, PASSES = 8, 3
#: Baum-Welch reads a text as sequences of at most so many tokens (scores are of whole texts)
SEQUENCE = 1024
#: the starting point is fitted on the driver: about so many sequences, so many passes
START_SEQUENCES, START_PASSES = 600, 15
#: weight of the smoothed class distribution in each state's emissions
PRIOR = 200.0
#: words counted in a task before partial counts go out; tokens that are in memory at a time
HELD, TOKENS = 300_000, 400_000
GROUPS = 32


def words_of(text: str) -> list[bytes]:
    """Words by ASCII white space, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()  # both touch ASCII alone on bytes


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 7) == 2


def word_counts(texts: DataFrame) -> DataFrame:
    """word, c over the column ``text``; partial counts are made in the tasks."""

    def run(batches):
        held: Counter[bytes] = Counter()

        def out():
            part = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "c"])
            held.clear()
            return part

        for b in batches:
            for t in b.column("text"):
                held.update(words_of(t.as_py()))
                if len(held) >= HELD:
                    yield out()
        if held:
            yield out()

    return texts.select("text").mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """Frequent words with counts, and what is known of all others by class."""

    index: dict[bytes, int]
    count: np.ndarray  # by index, falling
    tokens: int  # N, ends included
    types: int  # V, the end included
    ends: int
    own: int  # classes set aside for single words
    class_log: np.ndarray  # by hash class: log10(N_c + V_c + 1)
    class_count: np.ndarray  # by class: training tokens

    @property
    def base_log(self) -> float:
        return float(np.log10(self.tokens + 1 * (self.types + 1)))

    def hashed(self, words: list[bytes]) -> np.ndarray:
        """Classes of words that have none of their own, from 0."""
        return np.fromiter((zlib.crc32(w) % HASH_CLASSES for w in words), np.int64, len(words))


def vocabulary(counts: DataFrame, ends: int, frequent: int = FREQUENT, own_classes: int = OWN_CLASSES) -> Vocabulary:
    """``counts`` is a stored table (word, c); ``ends`` is the number of training texts."""
    top = most_frequent(counts, frequent).toArrow()
    words, c = top.column("word").to_pylist(), np.asarray(top.column("c"), np.int64)
    order = sorted(range(len(words)), key=lambda i: (-c[i], words[i]))
    index = {words[i]: k for k, i in enumerate(order)}
    totals = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    own = [words[i] for i in order[:own_classes]]
    # all words that are not classes of their own, by class
    shared = counts.groupBy(F.crc32("word") % HASH_CLASSES).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    n_class, v_class = np.zeros(HASH_CLASSES), np.zeros(HASH_CLASSES)
    for r in shared:
        n_class[r[0]], v_class[r[0]] = r["n"], r["v"]
    count = c[order] if len(order) else np.zeros(0, np.int64)
    for w, k in zip(own, count[: len(own)].tolist(), strict=True):
        h = zlib.crc32(w) % HASH_CLASSES
        n_class[h] -= k
        v_class[h] -= 1
    class_count = np.zeros(1 + own_classes + HASH_CLASSES)
    class_count[0] = ends
    class_count[1 : 1 + len(own)] = count[: len(own)]
    class_count[1 + own_classes :] = n_class
    return Vocabulary(index, count, int(totals["n"] or 0) + ends, int(totals["v"]) + (ends > 0), ends, own_classes, np.log10(n_class + v_class + 1), class_count)


def encoded(docs: DataFrame, vocab: Vocabulary, doc_id: str, text: str) -> DataFrame:
    """Per row: classes of its tokens, the known parts of both scores, and the words whose counts must be joined."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        v = shared.value
        words_by_index = list(v.index)
        n = len(words_by_index)
        own, cls, inside = v.own, np.arange(1, n + 1), np.zeros(n)
        log_count = np.log10(v.count + 1.0)
        shares = v.hashed(words_by_index[own:])
        cls[own:] = 1 + own + shares
        inside[own:] = log_count[own:] - v.class_log[shares]
        end_log = float(np.log10(v.ends + 1.0))
        get = v.index.get
        for b in batches:
            out = []
            for t in b.column("text"):
                words = words_of(t.as_py())
                at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
                codes = np.zeros(len(words) + 1, np.uint16)
                known = at >= 0
                codes[:-1][known] = cls[at[known]]
                other = [words[i] for i in np.flatnonzero(~known).tolist()]
                shares, rare = v.hashed(other), Counter(other)
                codes[:-1][~known] = 1 + own + shares
                part = inside[at[known]].sum() - v.class_log[shares].sum()
                base = log_count[at[known]].sum() + end_log - (len(words) + 1) * v.base_log
                out.append((len(words) + 1, int(known.sum()) + (v.ends > 0), base, part, codes.tobytes(), [{"word": w, "n": k} for w, k in rare.items()]))
            if out:
                cols = zip(*out, strict=True)
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())])))
                yield pa.RecordBatch.from_arrays(
                    [b.column("row"), b.column("doc_id"), b.column("held_out"), *(pa.array(x, k) for x, k in zip(cols, kinds, strict=True))],
                    names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "inside", "codes", "rare"],
                )

    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), whole_text(text).alias("text"))
    kind = dict(slim.dtypes)["doc_id"]
    return slim.mapInArrow(run, f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, known bigint, base double, inside double, codes binary, rare array<struct<word:binary,n:int>>")


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes x states


def _active(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by falling length; flat codes; where each begins; how many are at least t + 1 long."""
    n = np.array([len(s) for s in sequences])
    order = np.argsort(-n, kind="stable")
    n = n[order]
    flat = np.concatenate([sequences[i] for i in order]).astype(np.int64)
    begin = np.r_[0, np.cumsum(n)[:-1]]
    return order, flat, begin, np.searchsorted(-n, -np.arange(1, n[0] + 1), side="right")


def log10_likelihoods(m: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Scaled forward recursion over sequences of one or more classes, all sequences a step at a time."""
    order, flat, begin, active = _active(sequences)
    total = np.zeros(len(sequences))
    alpha = np.zeros(0)
    for t, k in enumerate(active.tolist()):
        e = m.emit[flat[begin[:k] + t]]
        alpha = e * m.start if t == 0 else (alpha[:k] @ m.move) * e
        s = alpha.sum(axis=1)
        alpha /= s[:, None]
        total[:k] += np.log10(s)
    out = np.empty(len(sequences))
    out[order] = total
    return out


def expected_counts(m: Model, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of the sequences (forward-backward)."""
    _, flat, begin, active = _active(sequences)
    alphas, scales, seen = [], [], []
    for t, k in enumerate(active.tolist()):
        e = m.emit[flat[begin[:k] + t]]
        a = e * m.start if t == 0 else (alphas[-1][:k] @ m.move) * e
        s = a.sum(axis=1, keepdims=True)
        a /= s
        alphas.append(a)
        scales.append(s)
        seen.append(e)
    move = np.zeros_like(m.move)
    beta = np.ones_like(alphas[-1])
    for t in range(len(alphas) - 1, -1, -1):
        alphas[t] *= beta  # now the probability of each state
        if t:
            ahead, before = seen[t] * beta / scales[t], alphas[t - 1]
            move += before[: len(ahead)].T @ ahead
            beta = np.ones_like(before)
            beta[: len(ahead)] = ahead @ m.move.T
    start = alphas[0].sum(axis=0)
    where = np.concatenate([flat[begin[: len(a)] + t] for t, a in enumerate(alphas)])
    gamma = np.concatenate(alphas)
    emit = np.stack([np.bincount(where, weights=gamma[:, j], minlength=len(m.emit)) for j in range(gamma.shape[1])], axis=1)
    return start, move * m.move, emit


def updated(start: np.ndarray, move: np.ndarray, emit: np.ndarray, prior: np.ndarray) -> Model:
    """Maximisation, smoothed: every class stays possible in every state."""
    e = emit + PRIOR * prior[:, None]
    mv = move + 0.1
    st = start + 0.1
    return Model(st / st.sum(), mv / mv.sum(axis=1, keepdims=True), e / e.sum(axis=0))


def cut(codes: bytes) -> list[np.ndarray]:
    c = np.frombuffer(codes, np.uint16)
    return [c[i : i + SEQUENCE] for i in range(0, len(c), SEQUENCE)]


def starting_point(sample: list[bytes], prior: np.ndarray, states: int) -> Model:
    """Passes over a bounded sample from seeded states that prefer to stay."""
    rng = np.random.default_rng(0)
    noise = rng.random((len(prior), states)) + 0.5
    m = updated(np.ones(states), np.eye(states) * 20 * states + 1, prior[:, None] * noise, np.zeros(len(prior)))
    sequences = [s for x in sample for s in cut(x)][:START_SEQUENCES]
    if sequences:
        for _ in range(START_PASSES):
            m = updated(*expected_counts(m, sequences), prior)
    return m


def _summed(parts: DataFrame) -> np.ndarray:
    """Element-wise sum of vectors by state, in two levels so that no task meets all partitions' vectors."""
    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, "<f8") for x in rows["counts"]], axis=0)
        return pd.DataFrame({"state": [key[0]], "part": [0], "counts": [total.tobytes()]})

    kind = "state int, part int, counts binary"
    once = parts.groupBy("state", "part").applyInPandas(add, kind)
    rows = once.groupBy("state").applyInPandas(add, kind).collect()
    return np.stack([np.frombuffer(r["counts"], "<f8") for r in sorted(rows, key=lambda r: r["state"])]) if rows else np.zeros((0, 0))


def baum_welch(train: DataFrame, m: Model, prior: np.ndarray) -> Model:
    """One pass over all training sequences (column ``codes``)."""
    shared = train.sparkSession.sparkContext.broadcast(m)
    k = len(m.start)

    def run(batches):
        total, held, size = np.zeros((k, 1 + k + len(prior))), [], 0

        def flush():
            start, move, emit = expected_counts(shared.value, held)
            total[:, 0] += start
            total[:, 1 : 1 + k] += move
            total[:, 1 + k :] += emit.T

        for b in batches:
            for x in b.column("codes"):
                for s in cut(x.as_py()):
                    held.append(s)
                    size += len(s)
                    if size >= TOKENS:
                        flush()
                        held, size = [], 0
        if held:
            flush()
        part = TaskContext.get().partitionId() % GROUPS
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array([part] * k, pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())], names=["state", "part", "counts"])

    total = _summed(train.select("codes").mapInArrow(run, "state int, part int, counts binary"))
    if not total.size:
        return m
    return updated(total[:, 0], total[:, 1 : 1 + k], total[:, 1 + k :].T, prior)


def scores(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", states: int = STATES, passes: int = PASSES, frequent: int = FREQUENT, own_classes: int = OWN_CLASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per input row.

    Null text counts as empty: one token, the end. Learns from rows outside the held-out fold (a null id is in the fold of
    the empty id); without any, every count is 0. Repeated rows count and are scored each; extra columns are not read; an
    empty table gives an empty result.
    """
    train = docs.filter(~held_out(F.col(doc_id)))
    counts = stored(word_counts(train.select(whole_text(text).alias("text"))))
    vocab = vocabulary(counts, train.count(), frequent, own_classes)
    rows = stored(encoded(docs, vocab, doc_id, text))
    learning = rows.filter("NOT held_out").select("codes")
    prior = (vocab.class_count + 0.5) / (vocab.class_count + 0.5).sum()
    share = START_SEQUENCES / max(1, vocab.ends)
    sample = rows.filter("NOT held_out").filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))).orderBy("row").limit(START_SEQUENCES)
    m = starting_point([bytes(r["codes"]) for r in sample.select("codes").collect()], prior, states)
    for _ in range(passes):
        m = baum_welch(learning, m, prior)
    shared = docs.sparkSession.sparkContext.broadcast(m)

    def forward(batches):
        for b in batches:
            if b.num_rows:
                s = log10_likelihoods(shared.value, [np.frombuffer(x.as_py(), np.uint16) for x in b.column("codes")])
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(s, pa.float64())], names=[*names, "path"])

    names = ["row", "doc_id", "held_out", "n_tokens", "known", "base", "inside"]
    kind = dict(rows.dtypes)["doc_id"]
    scored = rows.select(*names, "codes").mapInArrow(forward, f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, known bigint, base double, inside double, path double")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.n").alias("n"))
    joined = rare.join(counts, "word").groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("log_counts"))
    log_counts = F.coalesce("log_counts", F.lit(0.0))
    return scored.join(joined, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + log_counts).alias("base_score"), (F.col("path") + F.col("inside") + log_counts).alias("score"),
    )

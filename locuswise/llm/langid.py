"""Language identification by multinomial naive Bayes over hashed character n-grams.

The matrix of log probabilities (buckets x languages) is broadcast; a batch of texts is scored in numpy as a sparse product:
rows of the matrix are gathered at the n-grams' buckets and summed per text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswise.llm.common import remainder

ORDERS = (1, 2, 3, 4)
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
#: expected number of labelled texts that the classifier is fitted on; languages share it evenly
TRAIN_ROWS = 40_000
#: bound of the matrix: so many languages of 2**16 buckets in 4 bytes are 64 MB
MAX_LANGUAGES = 256
ALPHA = 0.5
#: positions scored at a time
SLICE = 1 << 19
NO_LANGUAGE = "und"


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the lower-case letter (a blank for all else), and whether it is a letter."""
    low = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            x = c.lower()
            low[i] = ord(x) if len(x) == 1 else i
    return low, low != 32


def _spans(texts: list[str]):
    """(index of the first text, code points, owner of each) in slices of bounded size; slices of one text overlap so that no n-gram is lost or met twice."""
    reach = max(ORDERS) - 1
    start, size = 0, 0
    for i, t in enumerate([*texts, None]):
        if t is None or size + len(t) + 1 > SLICE:
            if size:
                part = texts[start:i]
                points = np.frombuffer("\0".join([*part, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
                yield points, np.repeat(np.arange(start, i), [len(x) + 1 for x in part]), len(points)
            start, size = i, 0
        if t is not None and len(t) + 1 > SLICE:
            points = np.frombuffer(f"{t}\0".encode("utf-32-le", "surrogatepass"), np.uint32)
            for k in range(0, len(points), SLICE):
                piece = points[k : k + SLICE + reach]
                yield piece, np.full(len(piece), i), min(SLICE, len(points) - k)
            start, size = i + 1, 0
        elif t is not None:
            size += len(t) + 1


def gram_buckets(texts: list[str]):
    """Yields (owners, buckets): one pair per n-gram that has a letter and starts at a slice's own positions."""
    low, is_letter = _letters()
    for points, owner, own in _spans(texts):
        c = low[points].astype(np.uint64)
        letter = is_letter[points]
        n = len(c)
        for k in ORDERS:
            if n < k:
                break
            h = c[: n - k + 1] + np.uint64(k)
            some = letter[: n - k + 1].copy()
            for j in range(1, k):
                h = h * np.uint64(0x100000001B3) + c[j : n - k + 1 + j]
                some |= letter[j : n - k + 1 + j]
            some &= owner[: n - k + 1] == owner[k - 1 :]
            some[own:] = False
            at = np.flatnonzero(some)
            h = (h[at] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)
            yield owner[at], h.astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and posterior; ``und`` and 0 for null, for texts without a letter, and where nothing was learned."""
        k = len(self.languages)
        total = np.zeros((len(texts), max(k, 1)))
        grams = np.zeros(len(texts), np.int64)
        if k:
            for owner, bucket in gram_buckets([t or "" for t in texts]):
                if not len(owner):
                    continue
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                total[owner[first]] += np.add.reduceat(self.log_prob[bucket], first, axis=0, dtype=np.float64)
                grams[owner[first]] += np.diff(np.r_[first, len(owner)])
        # n-grams of all orders tell of the same letters: the evidence counts once, not once per order
        logit = total / len(ORDERS) + (self.log_prior if k else 0)
        logit -= logit.max(axis=1, keepdims=True)
        p = np.exp(logit)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        sure = grams > 0
        return (
            [self.languages[b] if s else NO_LANGUAGE for b, s in zip(best.tolist(), sure.tolist(), strict=True)],
            np.where(sure, p[np.arange(len(best)), best], 0.0).tolist(),
        )


def fit(labelled: DataFrame, *, text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> LanguageModel:
    """Fits on a hash-chosen sample of about ``rows`` texts; priors come from all labelled rows. Null texts and languages are left out."""
    known = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the matrix would be too large to broadcast")
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros(0), np.zeros((BUCKETS, 0), np.float32))
    share = max(1, rows // len(languages))
    place = F.xxhash64("text", "lang")
    keep = F.create_map(*(F.lit(x) for k in languages for x in (k, min(1.0, share / sizes[k]))))[F.col("lang")]
    sample = known.filter((F.pmod(place, F.lit(1 << 30)) / (1 << 30)) < keep)

    def count(batches):
        found: dict[str, np.ndarray] = {}
        for b in batches:
            langs, texts = b.column("lang").to_pylist(), b.column("text").to_pylist()
            for k in set(langs):
                c = found.setdefault(k, np.zeros(BUCKETS, np.int64))
                for _, bucket in gram_buckets([t for t, x in zip(texts, langs, strict=True) if x == k]):
                    c += np.bincount(bucket, minlength=BUCKETS)
        for k, c in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([c.astype("<i8").tobytes()], pa.binary())], names=["lang", "counts"])

    spread = sample.repartition(8, F.pmod(place, F.lit(1 << 20)))
    counts = np.zeros((len(languages), BUCKETS))
    for r in spread.mapInArrow(count, "lang string, counts binary").toLocalIterator():
        counts[languages.index(r["lang"])] += np.frombuffer(r["counts"], "<i8")
    log_prob = np.log((counts + ALPHA) / (counts.sum(axis=1, keepdims=True) + ALPHA * BUCKETS)).T
    n = np.array([sizes[k] for k in languages], float)
    return LanguageModel(languages, np.log(n / n.sum()), np.ascontiguousarray(log_prob, np.float32))


def predictor(docs: DataFrame, model: LanguageModel):
    """A column function: text to struct<lang_pred, score>."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        lang, score = shared.value.predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["lang_pred", "score"])

    return predict


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 4) == 2


def languages(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per input row.

    Learns from rows with text and language outside the held-out fold. Null text, empty text and text without a letter give
    ``und`` with score 0, and so does everything where there is nothing to learn from. Score is the posterior of the
    predicted language; a tie goes to the language first in the alphabet. A null id is held in the fold of the empty id.
    Repeated rows are predicted each; other columns are not read. More than ``MAX_LANGUAGES`` languages raise an error.
    """
    model = fit(docs.filter(~held_out(F.col(doc_id))), text=text, lang=lang, rows=rows)
    predict = predictor(docs, model)
    out = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), predict(F.col(text).cast("string")).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_known(docs: DataFrame, *, least: float = 0.5, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns whatever their names, whose text has a language predicted with a score of ``least`` or more.

    Null, empty and letterless texts go; repeated rows are judged alike; an empty table, or one to learn nothing from, keeps none.
    """
    predict = predictor(docs, fit(docs.filter(~held_out(F.col(doc_id))), text=text, lang=lang))
    # the row in a struct: its columns may have any name
    marked = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_all")).withColumn("_predicted", predict(F.col(f"_all.`{text}`").cast("string")))
    return marked.filter(f"_predicted.lang_pred <> '{NO_LANGUAGE}' AND _predicted.score >= {least}").select("_all.*")

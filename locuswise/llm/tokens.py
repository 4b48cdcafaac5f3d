"""Token counts by byte-pair merging, without building identifiers.

The vocabulary file gives merge ranks and special strings. A word's bytes start as one symbol each in a doubly linked
list; a heap holds the adjacent pairs that have a rank; the lowest rank (leftmost on a tie) is merged until no pair is
left. The count is the number of bytes less the number of merges.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuswise.llm.common import whole_text

# Unicode white space, and the word pattern of byte-level vocabularies.
SPACE = "\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

#: two white spaces in a row: only there can a word boundary depend on what stands beyond a single blank or line end
DOUBLE = re.compile(rf"[{SPACE}][{SPACE}]")
WORD_PATTERN = regex.compile(WORDS)
#: chunks whose counts a worker remembers; beyond it the memory starts afresh, which costs time and changes nothing
MEMO = 400_000


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: printable Latin-1 stands for itself, the rest follows from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


def merge_count(word: bytes, ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Symbols left of ``word`` after all merges."""
    n = len(word)
    if n < 2:
        return n
    symbol = [word[i : i + 1] for i in range(n)]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    rank = ranks.get
    heap = [(r, i, p) for i in range(n - 1) if (r := rank(p := (symbol[i], symbol[i + 1]))) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i]
        # stale: one of the two symbols has been merged since
        if j >= n or symbol[i] != pair[0] or symbol[j] != pair[1]:
            continue
        symbol[i], symbol[j] = pair[0] + pair[1], None
        left -= 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := rank(p := (symbol[i], symbol[k]))) is not None:
                heapq.heappush(heap, (r, i, p))
        if (h := before[i]) >= 0 and (r := rank(p := (symbol[h], symbol[i]))) is not None:
            heapq.heappush(heap, (r, h, p))
    return left


class _Counts(dict):
    """Tokens of a chunk of text, computed when first asked for."""

    def __init__(self, ranks, lead):
        super().__init__()
        self.ranks, self.lead = ranks, lead

    def __missing__(self, chunk):
        if len(self) >= MEMO:
            self.clear()
        n = sum(merge_count(w.encode(), self.ranks) for w in WORD_PATTERN.findall(self.lead + chunk))
        self[chunk] = n
        return n


class TokenCounter:
    """Counts tokens of texts with the vocabulary file at ``path`` (byte-level, merges and added tokens in JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: only plain byte-level vocabularies are supported")
        byte = byte_letters()
        raw = lambda s: bytes(byte[c] for c in s)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.first, self.later = _Counts(ranks, ""), _Counts(ranks, " ")

    def count(self, text: str) -> int:
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        if not text:
            return 0
        if DOUBLE.search(text):
            return sum(map(self.first.__getitem__, WORD_PATTERN.findall(text)))
        first, later = self.first, self.later
        lines = text.split("\n")
        total = len(lines) - 1  # each line end between non-blanks is a token of its own
        for line in lines:
            head, *rest = line.split(" ")
            total += first[head]
            if rest:
                total += sum(map(later.__getitem__, rest))
        return total


@lru_cache(maxsize=4)
def counter(path: str) -> TokenCounter:
    """One counter per worker process."""
    return TokenCounter(path)


def token_counts(docs: DataFrame, vocab: str, *, doc_id: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per input row.

    No begin, end or padding tokens; special strings inside a text count one token each. A null text counts as empty
    (0 tokens); a null id stays null; repeated rows are counted each; other columns are not read, whatever their names;
    an empty table gives an empty result. Texts of any length are read whole.
    """

    def run(batches):
        c = counter(vocab).count
        for b in batches:
            ids, texts, sizes = b.columns
            n = [c(x.as_py()) for x in texts]
            yield pa.RecordBatch.from_arrays([ids, sizes, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    slim = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = dict(slim.dtypes)["doc_id"]
    return slim.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from locuswise.llm import spelling as sp


def neighbours(words):
    """Both ways, by wildcards: words that agree but for one place, or that one deletion makes equal."""
    words, by, out = set(words), {}, set()
    for w in words:
        for i in range(len(w)):
            by.setdefault((w[:i], w[i + 1 :]), []).append(w)
            if w[:i] + w[i + 1 :] in words:
                out |= {(w, w[:i] + w[i + 1 :]), (w[:i] + w[i + 1 :], w)}
    for same in by.values():
        out |= {(a, b) for a in same for b in same if a != b}
    return out


def brute(docs):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3}
    near = {}
    for a, b in neighbours(counts):
        near.setdefault(a, []).append(b)
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x))
        if counts[best] >= 2 * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near.get(w, [])), counts[form[w]] if w in form else None) for w, n in counts.items()}


def test_suffix_ranks():
    rnd = random.Random(4)
    for _ in range(40):
        words = sorted({tuple(rnd.randint(1, 3) for _ in range(rnd.choice([1, 3, 12, 30]))) for _ in range(40)})
        index = sp.SuffixRanks([np.array(w) for w in words])
        text = [0, *(x for w in words for x in (*w, 0))]
        order = sorted(range(len(text)), key=lambda i: text[i:])
        assert index.bwt.tolist() == [text[i - 1] for i in order]
        for _ in range(20):
            pattern = [rnd.randint(0, 3) for _ in range(rnd.randint(1, 4))]
            if (0, 0) in zip(pattern, pattern[1:], strict=False):  # only the text's two ends together
                continue
            lo, hi = np.array([0]), np.array([index.n])
            for c in reversed(pattern):
                lo, hi = index.extend(c, lo, hi)
            found = [k for k, i in enumerate(order) if text[i : i + len(pattern)] == pattern]
            assert list(range(lo[0], hi[0])) == found if found else lo[0] >= hi[0]


def test_search_schemes_against_wildcards():
    rnd = random.Random(1)
    for trial in range(20):
        words = {"".join(rnd.choice("abcdé") for _ in range(rnd.randint(5, 12 if trial % 3 else 6))) for _ in range(300)}
        words |= {w[:2] + "a" + w[2:] for w in list(words)[:80]} | {w[:-1] for w in list(words) if len(w) > 6} | {w + w[-1] for w in list(words)[:40]}
        rows = [(True, 0, -1, w, 1) for w in words] + [(False, s, k, w, 0) for w in words for s in (0, 1) for k in (sp.SUBSTITUTE, sp.INSERT, sp.DELETE)]
        t = pa.table({c: list(x) for c, x in zip(("entry", "side", "kind", "word", "n"), zip(*rows, strict=True), strict=True)})
        got = sp.shard_pairs(t)
        assert set(zip(got["word"].to_pylist(), got["near"].to_pylist(), strict=True)) == neighbours(words)


def rows(df):
    out = [tuple(r) for r in df.collect()]
    assert len(out) == len(set(out))
    return set(out)


@pytest.mark.parametrize("block", [sp.BLOCK, 3])
def test_small_tables_and_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(sp, "BLOCK", block)
    monkeypatch.setattr(sp, "SHARD", 500)
    rnd = random.Random(7)
    stem = ["hundert", "hunderte", "hunderter", "hundart", "école", "ÉCOLE", "ecole", "colle", "aaaaa", "aaaaaa", "aaaaaaa", "straße", "strasse", "x" * 5000, "x" * 5001]
    docs = [(i, " ".join(rnd.choice(stem) for _ in range(60))) for i in range(60)] + [(None, "aaaaa,aaaaa;AAAAA 1hundert2 漢hundert"), (3, None), (4, ""), (4, ""), (5, "×÷abc ×÷abc ×÷abc")]
    df = spark.createDataFrame([(*d, "clash", 3, 4) for d in docs], "doc_id long, text string, word string, n int, `a.b` int")
    assert rows(sp.spelling_variants(df)) == brute(docs)
    assert sp.spelling_variants(df.limit(0)).count() == 0


def test_counts_handed_on_early(spark, monkeypatch):
    monkeypatch.setattr(sp, "HELD", 10)
    docs = [(i, f"alpha{'abc'[i % 3]} betaa gammaaa deltaa epsilon") for i in range(200)]
    assert rows(sp.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_chains_end_at_the_root(spark):
    words = {"abcdefg": 64, "abcdef": 32, "abcde": 16, "abcdeg": 7, "bcdeg": 3}
    docs = [(k, f"{w} " * n) for k, (w, n) in enumerate(words.items())]
    got = rows(sp.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute(docs) and {r[2] for r in got} == {"abcdefg"}


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert rows(sp.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)

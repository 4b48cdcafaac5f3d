import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from locuswise.llm import divergence as dv

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(docs):
    """docs: (text, lang, source). Python's whole numbers are exact at any size."""
    docs = [tuple(x or "" for x in d) for d in docs]
    terms = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(t)] for t, _, _ in docs]
    out = set()
    for lang in {d[1] for d in docs}:
        mine = [(d[2], w) for d, w in zip(docs, terms, strict=True) if d[1] == lang]
        held = Counter(x for _, w in mine for x in set(w))
        kept = [x for x, n in held.items() if n >= 10]
        counts = {s: Counter() for s, _ in mine}
        for s, w in mine:
            counts[s].update(x for x in w if held[x] >= 10)
        whole = sum(counts.values(), Counter())

        def p(c):
            total = sum(c.values()) + 2 * len(kept)
            return {x: 1 + 10**9 * (c[x] + 2) // total for x in kept}

        f = lambda a, b: (a - b) ** 2 // (a + b)
        ps, q = {s: p(c) for s, c in counts.items()}, p(whole)
        for s in counts:
            pairs = [(-sum(f(ps[s][x], ps[o][x]) for x in kept), o.encode()) for o in counts if o != s]
            top = [(-f(ps[s][x], q[x]), x.encode()) for x in kept if counts[s][x] and ps[s][x] > q[x]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(top)[:10])):
                out |= {(lang, s, part, i.decode(), -v, k) for k, (v, i) in enumerate(found, 1)}
    return out


def rows(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    out = [tuple(r) for r in df.collect()]
    assert len(out) == len(set(out))
    return set(out)


def some_docs(n=400, seed=3):
    rnd = random.Random(seed)
    words = ["Haus", "haus", "Baum", "baumhaus", "baumhausbau", "été", "Été", "漢字漢", "漢字", "x1y", "ab", "abc", "abcd", "abcdef", "abcdefg", "abcdefgh", "z" * 30, "z" * 31, "\U0001f600\U0001f601", "rare0", "rareb", "rarec"]
    rare = [f"abc{chr(97 + k)}" for k in range(26)]
    docs = [(" ".join(rnd.choices(words, k=rnd.randint(0, 12)) + rnd.sample(rare, 2)), rnd.choice(["de", "fr", "en", None, ""]), rnd.choice(["a", "b", "é", None])) for _ in range(n)]
    return docs + [(None, "de", "a"), (None, "xx", "only"), ("", "yy", "one"), ("", "yy", "two"), ("word", "yy", "two"), docs[0], docs[0]]


@pytest.mark.parametrize("sources, terms, held", [(dv.SOURCES, dv.TERMS, dv.HELD), (1, 4, 5)])
def test_small_tables(spark, monkeypatch, sources, terms, held):
    for name, value in (("SOURCES", sources), ("TERMS", terms), ("HELD", held)):
        monkeypatch.setattr(dv, name, value)
    docs = some_docs()
    df = spark.createDataFrame([(*d, "clash", 1, 2) for d in docs], "text string, lang string, source string, term string, n int, `a.b` int")
    assert rows(dv.source_divergence(df.repartition(5))) == brute(docs)


def test_no_terms_and_no_rows(spark):
    docs = [("one two", "en", s) for s in "abc"]
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    assert rows(dv.source_divergence(df)) == brute(docs)
    assert dv.source_divergence(df.limit(0)).count() == 0


def test_chance_hits_of_the_bitmap_change_nothing(spark, monkeypatch):
    docs = some_docs(seed=5)
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    monkeypatch.setattr(dv, "BITS", 64)
    assert rows(dv.source_divergence(df)) == brute(docs)


def test_levels_count_documents_not_occurrences(spark):
    docs = [("abcabc abcabd abcabc", "en", "a")] * 9 + [("abcdef", "en", "a")]
    kept = dv.kept_terms(spark.createDataFrame(docs, "text string, lang string, source string"))
    assert kept.count() == 0
    docs.append(("abcabc", "en", "b"))
    kept = dv.kept_terms(spark.createDataFrame(docs, "text string, lang string, source string"))
    assert [bytes(r.prefix) for r in kept.collect()] == [b"abcabc"]


def test_exact_at_any_size(spark):
    rnd = random.Random(1)
    cases = [(rnd.randrange(10**k), rnd.randrange(10**k)) for k in range(1, 15) for _ in range(20)]
    cases = [(c, c + d + 2) for c, d in cases]
    want = [1 + 10**9 * (c + 2) // t for c, t in cases]
    c, t = (np.array(x, np.int64) for x in zip(*cases, strict=True))
    assert dv.scaled(c, t).tolist() == want
    df = spark.createDataFrame(cases, "c long, t long").select(dv.scaled(F.col("c"), F.col("t")).alias("p"))
    assert [r.p for r in df.collect()] == want
    ends = [(1, 10**9 + 1), (10**9 + 1, 1), (5, 5), (7, 3)]
    assert [r.f for r in spark.createDataFrame(ends, "p long, q long").select(dv.difference(F.col("p"), F.col("q")).alias("f")).collect()] == [(p - q) ** 2 // (p + q) for p, q in ends]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert rows(dv.source_divergence(docs)) == brute([(r.text, r.lang, r.source) for r in docs.collect()])


@pytest.mark.parametrize("known, width", [(0, 4), (4, 12), (0, None)])
def test_tally_counts_documents_and_occurrences(known, width):
    docs = [("de", "a", "ab Abcde  abcdX ab"), ("de", "b", " ab "), ("fr", "a", "ab"), ("de", "a", "abcde abcde"), ("de", "a", ""), ("", "", "1 2")]
    lang, source, text = zip(*docs, strict=True)
    t = dv.tally(pa.array(lang), pa.array(source), pa.array([x.encode() for x in text], pa.binary()), known, width)
    want = Counter()
    for x, s, d in docs:
        terms = [w.encode() for w in TERM.findall(d.lower())]
        if width:
            want.update((x, "", p) for p in {w[:width] for w in terms if len(w) >= known})
        else:
            want.update((x, s, w) for w in terms)
    assert dict(zip(zip(*(t[c].to_pylist() for c in ("lang", "source", "prefix")), strict=True), t["n"].to_pylist(), strict=True)) == want
    # one row a key, also where a task meets it in many texts
    assert len(t) == len(want)

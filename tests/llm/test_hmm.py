import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from locuswise.llm import hmm


def model(rng, k, c):
    return hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(c), k).T)


def paths(m, seq):
    for p in itertools.product(range(len(m.start)), repeat=len(seq)):
        w = m.start[p[0]] * m.emit[seq[0], p[0]]
        for t in range(1, len(seq)):
            w *= m.move[p[t - 1], p[t]] * m.emit[seq[t], p[t]]
        yield p, w


def test_recursions_against_all_paths():
    rng = np.random.default_rng(9)
    m = model(rng, 3, 5)
    seqs = [rng.integers(0, 5, n).astype(np.uint16) for n in (1, 6, 3, 6, 2)]
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for s, got in zip(seqs, hmm.log10_likelihoods(m, seqs), strict=True):
        total = sum(w for _, w in paths(m, s))
        assert abs(got - math.log10(total)) < 1e-9
        for p, w in paths(m, s):
            start[p[0]] += w / total
            for t, z in enumerate(p):
                emit[s[t], z] += w / total
                if t:
                    move[p[t - 1], z] += w / total
    for a, b in zip(hmm.expected_counts(m, seqs), (start, move, emit), strict=True):
        assert np.allclose(a, b)


def test_passes_raise_the_likelihood():
    rng = np.random.default_rng(10)
    seqs = [rng.integers(0, 8, 40).astype(np.uint16) if i % 2 else (rng.integers(0, 8, 40) % 3).astype(np.uint16) for i in range(60)]
    prior = np.full(8, 1 / 8)
    m, was = model(rng, 2, 8), -1e9
    for _ in range(8):
        now = hmm.log10_likelihoods(m, seqs).sum()
        assert now > was - 1.0  # smoothing may cost a little
        was, m = now, hmm.updated(*hmm.expected_counts(m, seqs), prior)


def brute(rows):
    words = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0d]+", t or "")]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter()
    for i, t in rows:
        if not held(i):
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    return [(held(i), len(words(t)) + 1, sum(c[w] > 0 for w in [*words(t), None]), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*words(t), None])) for i, t in rows]


@pytest.mark.parametrize("sizes", [{}, {"frequent": 20, "own_classes": 10}])
def test_rows(spark, sizes):
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(f"W{x}" for x in rng.zipf(1.5, 30) % 90)) for i in range(60)] + [(None, "É w1\x1cx"), (70, None), (71, ""), (72, "w1 w2"), (72, "w1 w2"), (73, "w1 " * 5000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, word string, n_tokens int")
    got = hmm.scores(df, **sizes).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    want = sorted(((r[0], *b) for r, b in zip(rows, brute(rows), strict=True)), key=key)
    for r, w in zip(sorted(got, key=key), want, strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:5] and abs(r.base_score - w[5]) < 1e-6 * abs(w[5]) + 1e-9
        assert r.score < 0
    assert hmm.scores(df.limit(0), **sizes).count() == 0


def test_probabilities_of_words_sum_to_one(spark):
    """Inside each hash class, the shares of its words and of one unknown word sum to 1."""
    texts = [" ".join(f"w{(i * j) % 37}" for j in range(30)) for i in range(40)]
    counts = hmm.stored(hmm.word_counts(spark.createDataFrame([(t,) for t in texts], "text string")))
    v = hmm.vocabulary(counts, len(texts), 1 << 18, 5)
    seen = Counter(w for t in texts for w in t.split())
    assert v.tokens == 40 * 31 and v.class_count.sum() == v.tokens and v.types == len(seen) + 1
    assert dict(zip((w.decode() for w in v.index), v.count.tolist(), strict=True)) == dict(seen)
    words = list(v.index)[5:]
    share = Counter()
    for w, h in zip(words, v.hashed(words).tolist(), strict=True):
        share[h] += (seen[w.decode()] + 1) / 10 ** v.class_log[h]
    assert all(abs(x + 1 / 10 ** v.class_log[h] - 1) < 1e-9 for h, x in share.items())


def test_better_than_the_base_on_held_out_texts(spark):
    from locuswise.llm.queries import load_all

    got = load_all()["op5_hmm_score"].build(spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()
    want = brute(list(zip(docs.doc_id.tolist(), docs.text.tolist(), strict=True)))
    got = got.set_index("doc_id").loc[docs.doc_id]
    assert np.allclose(got.base_score, [w[4] for w in want]) and got.n_known.tolist() == [w[2] for w in want]
    out = got[got.held_out]
    assert out.score.sum() > out.base_score.sum()
    print("log10 per token: base", out.base_score.sum() / out.n_tokens.sum(), "model", out.score.sum() / out.n_tokens.sum())

import math
import random

import numpy as np
from pyspark.sql import functions as F

from locuswise.llm import langid
from locuswise.llm.langid import LanguageModel, gram_buckets, keep_known, languages

SCHEMA = "doc_id long, text string, lang string, score int, held_out string"


def grams(text):
    """Brute force: the n-grams that the model counts."""
    low = [c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text + "\0"]
    src = [c.isalpha() for c in text + "\0"]
    return sum(any(src[i : i + k]) for k in langid.ORDERS for i in range(len(low) - k + 1))


def test_slices_lose_nothing(monkeypatch):
    texts = ["", "abc", "Ünï 12 x" * 40, "q" * 100, "  ", "zz"]
    whole = [np.zeros(langid.BUCKETS, int) for _ in texts]
    for o, b in gram_buckets(texts):
        for i in range(len(texts)):
            whole[i] += np.bincount(b[o == i], minlength=langid.BUCKETS)
    assert [w.sum() for w in whole] == [grams(t) for t in texts]
    monkeypatch.setattr(langid, "SLICE", 23)
    cut = [np.zeros(langid.BUCKETS, int) for _ in texts]
    for o, b in gram_buckets(texts):
        for i in range(len(texts)):
            cut[i] += np.bincount(b[o == i], minlength=langid.BUCKETS)
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))


def test_scores_against_brute_force():
    rnd = random.Random(3)
    lp = np.log(np.random.default_rng(1).dirichlet(np.ones(langid.BUCKETS), 3)).T.astype(np.float32)
    m = LanguageModel(["a", "b", "c"], np.log([0.5, 0.3, 0.2]), lp)
    texts = ["".join(rnd.choice("abc é1") for _ in range(rnd.randrange(30))) for _ in range(50)] + [None, "", "12 !"]
    langs, scores = m.predict(texts)
    for t, g, s in zip(texts, langs, scores, strict=True):
        one = [b for _, bs in gram_buckets([t or ""]) for b in bs]
        if not any(c.isalpha() for c in t or ""):
            assert (g, s) == ("und", 0)
            continue
        logit = [sum(float(lp[b, k]) for b in one) / 4 + math.log(p) for k, p in enumerate((0.5, 0.3, 0.2))]
        z = [math.exp(x - max(logit)) for x in logit]
        assert g == "abc"[z.index(max(z))] and abs(s - max(z) / sum(z)) < 1e-6


def test_rows(spark):
    rows = [(i, f"the house of the king {i}" if i % 2 else f"le roi est dans la maison {i}", "en" if i % 2 else "fr", 1, "x") for i in range(200)]
    rows += [(None, "the king", None, None, None), (300, None, "en", 1, "x"), (301, "123", "fr", 1, "x"), (301, "123", "fr", 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in languages(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert all(got[i][0].lang_pred == ("en" if i % 2 else "fr") and 0.5 < got[i][0].score <= 1 for i in range(200))
    assert got[None][0].lang_pred == "en" and got[300][0].lang_pred == "und" and [r.lang_pred for r in got[301]] == ["und"] * 2
    kept = keep_known(df)
    assert kept.columns == df.columns and kept.count() == 201
    assert languages(df.limit(0)).count() == 0
    assert {r.lang_pred for r in languages(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_held_out_accuracy(spark):
    import zlib

    from locuswise.llm.queries import load_all

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas().set_index("doc_id")
    got = load_all()["op2_language_id"].build(spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    assert got.held_out.to_dict() == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in docs.index}
    out = got[got.held_out & (got.lang_pred != "und")]
    assert (out.lang_pred == docs.lang.loc[out.index]).mean() > 0.95

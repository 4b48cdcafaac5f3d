import random
import re
from collections import Counter

import numpy as np

from locuswise.llm import rules as ru


def brute(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", t)
    win = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = set()
    for i in range(len(words) - 2):
        if win[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(inside)


def test_counts():
    rnd = random.Random(6)
    texts = ["".join(rnd.choice(["a ", "b ", "c", "\n", " \t", "é#", "\x1c", "\x85", "<>"]) for _ in range(rnd.randrange(60))) for _ in range(1500)]
    for t in [*texts, "", "a b a b a b", "word " * 3000]:
        n, chars, symbols, _, dup, rep, *_ = ru.text_counts(t)
        assert (n, chars, symbols, dup, rep) == brute(t), repr(t)


def test_learned_list():
    rng = np.random.default_rng(7)
    x = {"f_a": rng.random(3000), "f_b": rng.random(3000), "f_c": rng.random(3000)}
    bad = ((x["f_a"] > 0.8) & (x["f_b"] < 0.5)) | (x["f_c"] < 0.1)
    rules = ru.learn(x, bad, rng.random(3000) < 0.33)
    said = np.zeros(3000, bool)
    for r in rules:
        said |= ru._covers(r, x, 3000)
    assert (said == bad).mean() > 0.95 and 1 < len(rules) <= ru.MAX_RULES
    assert ru.learn(x, np.zeros(3000, bool), rng.random(3000) < 0.33) == []
    noise = rng.random(3000) < 0.3
    assert all(len(r) <= ru.MAX_CONDITIONS for r in ru.learn(x, noise, rng.random(3000) < 0.33))


def test_expression_follows_the_list(spark):
    rules = [(ru.Condition("f_a", True, 0.5), ru.Condition("f_b", False, 0.25)), (ru.Condition("f_b", True, 0.75),)]
    x = {"f_a": np.array([0.5, 0.9, 0.4, 0.9]), "f_b": np.array([0.2, 0.25, 0.75, 0.8])}
    df = spark.createDataFrame([(i, float(x["f_a"][i]), float(x["f_b"][i])) for i in range(4)], "i int, f_a double, f_b double")
    got = [r[0] for r in df.orderBy("i").selectExpr(f"{ru.as_sql(rules)} AS r").collect()]
    assert got == [1, None, 2, 2]


def test_rows(spark):
    rows = [(1, None), (None, ""), (2, "one two " * 100), (2, "one two " * 100), (3, " ".join(f"w{i}" for i in range(60)))]
    df = spark.createDataFrame([(*r, 5, "clash") for r in rows], "doc_id long, text string, n_words int, kept string")
    labels = spark.createDataFrame([(3, 1), (2, 0), (None, 0), (3, None)], "doc_id long, quality int")
    out = ru.quality_verdicts(df, ru.fit(df, labels)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in out) == [(0, 0, True, False), (1, 0, True, False), (2, 200, True, False), (2, 200, True, False), (3, 60, False, True)]
    assert ru.fit(df, labels.limit(0)) == [] and ru.fit(df.limit(0), labels) == []
    assert ru.quality_verdicts(df.limit(0), []).count() == 0


def test_held_labels(spark):
    from locuswise.llm.queries import load_all

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas().set_index("doc_id")
    got = load_all()["op7_quality_rules"].build(spark, sf).toPandas().set_index("doc_id")
    for i, t in docs.text.items():
        n, chars, symbols, dup, rep = brute(t)
        r = got.loc[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n) and not (r.base_failed and r.kept)
    good = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id").quality
    both = got.loc[good.index]
    assert both[(good == 1) & ~both.base_failed].kept.mean() > 0.97

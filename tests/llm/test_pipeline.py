import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.test_exact_dedup import brute as exact_brute
from tests.llm.test_packing import check as packing_check
from tests.llm.test_shingle_join import brute as near_brute

SF = "/root/testdata/sf0.01"


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, before = docs.columns, rows(docs)
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if name == "packing":
            n, total = packing_check(out.collect(), [(r.doc_id, r.text) for r in before.values()])
            assert n <= 1.01 * total / 1024 + 1
            break
        assert out.columns == names
        after = rows(out)
        assert set(after) <= set(before)
        texts = [(i, r.text) for i, r in before.items()]
        if name == "language":
            assert all(re.search(r"[^\W\d_]", r.text) for r in after.values())
            gone = [r for i, r in before.items() if i not in after and re.search(r"[^\W\d_]", r.text or "")]
            assert len(gone) <= 0.01 * len(before)
        elif name == "exact_copies":
            assert set(after) == {r[0] for r in exact_brute(texts) if r[3]}
        elif name == "near_copies":
            assert set(after) == {d for d, _, c in near_brute(texts)[0] if d == c}
        if name != "personal_data":
            assert all(after[i] == before[i] for i in after)
        else:
            assert set(after) == set(before)
            assert all(r[:1] + r[2:] == before[i][:1] + before[i][2:] for i, r in after.items())
            assert sum(r.text != before[i].text for i, r in after.items()) > 0
        docs, before = out, after


def test_run_equals_the_registered_query(spark):
    from locuswise.llm.queries import load_all

    got = load_all()["pipeline"].build(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.select("doc_id").distinct().count() > 100


@pytest.mark.parametrize("kind", ["empty", "odd"])
def test_odd_tables(spark, tmp_path, kind):
    clash = "row _row keep _found _parts _new _made _predicted _all a.b kept length"
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in clash.split())
    data = [] if kind == "empty" else [(1, None, None, None, None, "a", "b", "c"), (None, "the cat sat on the mat today", "en", "s", 1, None, None, None), (2, "", "en", "s", 0, "a", "b", "c"), (3, "the cat sat on the mat today", "en", "s", 1, "a", "b", "c"), (3, "the cat sat on the mat today", "en", "s", 1, "a", "b", "c"), (4, "le chat " * 9000, "fr", "s", 1, "a", "b", "c")]
    extra = lambda r: tuple(f"{x}1" if r[5] else None for x in clash.split())
    docs = spark.createDataFrame([(*r[:5], *extra(r)) for r in data], schema)
    for k, (name, stage) in enumerate(cp.STAGES):
        docs.write.parquet(str(tmp_path / f"{kind}{k}"))
        docs = stage(spark, spark.read.parquet(str(tmp_path / f"{kind}{k}")), SF)
        if name != "packing":
            assert docs.columns[5:] == clash.split()
            assert all(tuple(r)[5:] in (extra([1] * 6), extra([None] * 6)) for r in docs.collect())
    assert docs.agg(F.sum("length")).first()[0] is None if kind == "empty" else docs.count() > 2

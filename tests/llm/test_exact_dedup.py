import hashlib
import random
import re

import pytest

from locuswise.llm.exact_dedup import drop_copies, exact_copies

SCHEMA = "doc_id long, text string, keep_id string, size int, edge string"


def brute(rows):
    norm = lambda t: re.sub(r"[ \t-\r]", "", t or "")
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r)
    out = []
    for n, g in groups.items():
        g = sorted(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(r[0], g[0][0], len(g), i == 0, hashlib.sha256(n.encode()).hexdigest()) for i, r in enumerate(g)]
    return out


ROWS = (
    [(i, random.Random(i % 40).choice(["a b", "ab", " a\tb ", "", None, "ß é", "x" * 200 + str(i % 7), "long " * 5000]), "k", 1, "e") for i in range(300)]
    + [(5, "ab", "k", 1, "e"), (5, "ab", "k", 1, "e"), (None, "ab", None, None, None), (None, None, None, None, None), (7, "a\x1cb", None, 1, None)]
    + [(1000 + i, "same passage " * 30, None, 1, None) for i in range(400)]
)


@pytest.mark.parametrize("parts", ["1", "7", "40"])
def test_against_brute_force(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
        key = lambda r: (r[0] is None, r[0] or 0, r[4], not r[3], r[1] or 0)
        assert sorted((tuple(r) for r in exact_copies(df).collect()), key=key) == sorted(brute(ROWS), key=key)
        left = drop_copies(df)
        assert left.columns == df.columns
        got = [tuple(r) for r in left.collect()]
        assert sorted((r[0] is None, r[0] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in brute(ROWS) if r[3])
        assert set(got) <= set(ROWS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_copies(df).count() == 0
    assert drop_copies(df).count() == 0

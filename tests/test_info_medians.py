import random

import pytest
from pyspark.sql import functions as F

from locuswise.operators.cohort import info_counts, info_medians, merge_sites, merge_sites_two_level

SCHEMA = "sample string, chrom string, pos long, start long, ref string, alts array<string>, dp int, min_dp int, id string, info map<string,string>"


def records(rnd):
    out = []
    for pos in (5, 9, 40):
        for s in range(rnd.randrange(1, 30)):
            info = {"MQ": str(rnd.randrange(4) / 2), "Big": str(rnd.randrange(-3, 3)), "AC": "7", "T": rnd.choice(["x", "", "1,2", "NaN", "3"])}
            if rnd.random() < 0.3:
                del info["MQ"]
            out.append((f"s{s}", "a", pos, pos - (s % 5 == 4), "A", ["C", "<NON_REF>"], 3, None, None, info))
    return [*out, ("s0", "a", 77, 77, "A", ["C"], 1, None, None, None), ("s0", "a", 78, 78, "A", ["C"], 1, None, None, {"AC": "1", "MQ": None})]


@pytest.mark.parametrize("seed", [1, 2])
def test_upper_median_of_numbers(spark, seed):
    rows = records(random.Random(seed))
    want = {}
    for _, _, pos, start, *_, info in rows:
        for k, v in (info or {}).items():
            if start == pos and k != "AC" and v not in (None, "x", "", "1,2", "NaN"):
                want.setdefault(pos, {}).setdefault(k, []).append(float(v))
    want = {p: {k: sorted(v)[len(v) // 2] for k, v in d.items()} for p, d in want.items()}
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.pos: r["info"] for r in info_medians(info_counts(df, "info")).collect()} == want
    one = {r.pos: r["info"] for r in merge_sites(df, info="info").collect()}
    two = {r.pos: r["info"] for r in merge_sites_two_level(df, 3, info="info").collect()}
    assert one == two == want | {77: None, 78: None}


def test_equal_values_meet_before_a_site_does(spark):
    df = spark.range(20_000).selectExpr("id % 7 AS v").select(
        F.lit("a").alias("chrom"), F.lit(1).alias("pos"), F.lit(1).alias("start"), F.create_map(F.lit("MQ"), F.col("v").cast("string")).alias("info")
    )
    assert info_counts(df, "info").count() == 7
    assert info_medians(info_counts(df, "info")).first()["info"] == {"MQ": 3.0}

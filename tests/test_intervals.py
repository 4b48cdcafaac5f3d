"""Interval operators against brute force on random small inputs, and edge rows."""

import random

import pytest
from pyspark.sql import functions as F

from locuswise.operators import intervals as iv
from locuswise.operators.coverage import depth_segments, gaps
from locuswise.operators.sampling import leveling, reservoir
from locuswise.operators.scan import following, previous, running, top_n


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def spans(rng, n, top=400):
    out = []
    for i in range(n):
        s = rng.randint(1, top)
        out.append((rng.choice(["a", "b"]), s, s + rng.choice([0, 3, 20, 150]), i))
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("how", ["inner", "left", "semi", "anti"])
def test_join_equals_brute_force(spark, seed, how):
    rng = random.Random(seed)
    a, b = spans(rng, 40), spans(rng, 15)
    left = spark.createDataFrame(a, "chrom string, start long, end long, i int")
    right = spark.createDataFrame(b, "chrom string, start long, end long, j int")
    got = iv.interval_join(left, right, how, bin_size=16, salt=3)
    hits = {x[3]: [y[3] for y in b if x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1]] for x in a}
    if how == "inner":
        want = sorted((i, j) for i, js in hits.items() for j in js)
        assert sorted((r.i, r.j) for r in got.collect()) == want
    elif how == "left":
        want = sorted((i, j) for i, js in hits.items() for j in (js or [-1]))
        assert sorted((r.i, -1 if r.j is None else r.j) for r in got.collect()) == want
    else:
        want = sorted(i for i, js in hits.items() if bool(js) == (how == "semi"))
        assert sorted(r.i for r in got.collect()) == want


def test_join_packs_the_rows_of_a_bin(spark, monkeypatch):
    """Arrays of few rows, rows that start before their bin, equal rows, rows without a place and reversed ones."""
    monkeypatch.setattr(iv, "PACK", 3)
    rng = random.Random(5)
    a, b = spans(rng, 60, 2000) + [(None, 5, 9, 60), ("a", None, None, 61), ("a", 900, 700, 62), ("c", 1, 5, 63)], spans(rng, 50, 2000)
    b += [("a", 500, 520, 50 + k) for k in range(8)] + [(None, 5, 9, 58), ("a", None, None, 59)]
    a.append(("a", 510, 512, 64))
    left = spark.createDataFrame(a, "chrom string, start long, end long, i int")
    right = spark.createDataFrame(b, "chrom string, start long, end long, j int")
    meet = lambda x, y: None not in x + y and x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1]
    hits = {x[3]: [y[3] for y in b if meet(x, y)] for x in a}
    for salt in (1, 2):
        inner, outer = (iv.interval_join(left, right, how, salt=salt) for how in ("inner", "left"))
        assert inner.columns == outer.columns == ["chrom", "start", "end", "i", "r_chrom", "r_start", "r_end", "j"]
        assert sorted((r.i, r.j) for r in inner.collect()) == sorted((i, j) for i, js in hits.items() for j in js)
        assert sorted((r.i, -1 if r.j is None else r.j) for r in outer.collect()) == sorted((i, j) for i, js in hits.items() for j in js or [-1])
        for d in (inner, outer):
            plan = d._jdf.queryExecution().optimizedPlan().toString()
            assert "inline" in plan and "Union" not in plan.split("Generate inline")[0]


def test_touching_is_not_overlapping(spark):
    left = spark.createDataFrame([("a", 1, 10)], "chrom string, start long, end long")
    right = spark.createDataFrame([("a", 11, 20), ("a", 10, 10)], "chrom string, start long, end long")
    assert iv.interval_join(left, right).count() == 1


def test_empty_right_side(spark):
    left = spark.createDataFrame([("a", 1, 10)], "chrom string, start long, end long")
    none = spark.createDataFrame([], "chrom string, start long, end long")
    assert iv.interval_join(left, none, "anti").count() == 1
    assert iv.interval_join(left, none, "left").count() == 1
    assert iv.interval_join(left, none, "semi").count() == 0


def test_merge_gap_exactly_tolerated(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 15, 20), ("a", 26, 30), ("a", 2, 3)], "chrom string, start long, end long")
    assert rows(iv.merge_intervals(df, gap=5, tile=4).select("start", "end", "n")) == [(1, 20, 3), (26, 30, 1)]


@pytest.mark.parametrize("tile", [1, 7, 1000])
def test_running_over_tiles(spark, tile):
    rng = random.Random(3)
    data = sorted(rng.sample(range(200), 60))
    df = spark.createDataFrame([("k", p, p % 11) for p in data], "k string, p long, v long")
    out = running(df, ["k"], "p", {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, tile=tile)
    got = {r.p: (r.s, r.m) for r in out.collect()}
    total, top = 0, 0
    for p in data:
        total, top = total + p % 11, max(top, p % 11)
        assert got[p] == (total, top)
    before = {r.p: r.q for r in previous(df, ["k"], "p", {"q": "p"}, tile=tile).collect()}
    after = {r.p: r.q for r in following(df, ["k"], "p", {"q": "p"}, tile=tile).collect()}
    for a, b in zip(data, data[1:]):
        assert before[b] == a and after[a] == b
    assert before[data[0]] is None and after[data[-1]] is None


def test_top_n_is_exact_for_one_hot_key(spark):
    df = spark.range(2000).selectExpr("id", "0 AS k", "(id * 7919) % 2003 AS o")
    got = sorted(r.o for r in top_n(df, ["k"], [F.col("o")], 25).collect())
    assert got == sorted((i * 7919) % 2003 for i in range(2000))[:25]


def test_depth_counts_each_base(spark):
    rng = random.Random(5)
    a = spans(rng, 60, 100)
    df = spark.createDataFrame(a, "chrom string, start long, end long, i int")
    got = {}
    for r in depth_segments(df, ["chrom"], tile=8).collect():
        for p in range(r.start, r.end + 1):
            got[(r.chrom, p)] = r.depth
    want = {}
    for c, s, e, _ in a:
        for p in range(s, e + 1):
            want[(c, p)] = want.get((c, p), 0) + 1
    assert got == want


def test_gaps_of_bare_contig(spark):
    cov = spark.createDataFrame([("a", 3, 5)], "chrom string, start long, end long")
    contigs = spark.createDataFrame([("a", 10), ("b", 4)], "chrom string, length long")
    assert rows(gaps(cov, contigs)) == [("a", 1, 2), ("a", 6, 10), ("b", 1, 4)]


def test_reservoir_size_and_repeat(spark):
    df = spark.range(500)
    one = rows(reservoir(df, 77, ["id"], seed=1))
    assert len(one) == 77 and one == rows(reservoir(df, 77, ["id"], seed=1))
    assert reservoir(df, 9999, ["id"]).count() == 500


@pytest.mark.parametrize("target", [100, 20, 19, 5, 1])
def test_leveling_quota(spark, target):
    sizes = {1: 1, 2: 3, 3: 10, 4: 20}
    want, at, idle = list(sizes.values()), 0, 0
    while sum(want) > target and idle < len(want):  # take one from each stack in turn
        idle = 0 if want[at] > 1 else idle + 1
        want[at] -= want[at] > 1
        at = (at + 1) % len(want)
    df = spark.createDataFrame([(p, i) for p, n in sizes.items() for i in range(n)], "pos long, i int")
    got = {r.pos: r.n for r in leveling(df, target, ["pos", "i"]).groupBy("pos").agg(F.count("*").alias("n")).collect()}
    assert [got[p] for p in sizes] == want


@pytest.mark.parametrize("target", [40, 25, 10])
def test_leveling_of_stacks_on_two_contigs(spark, target):
    sizes = {("a", 5): 3, ("b", 5): 20, ("b", 9): 1, ("c", 5): 30}
    df = spark.createDataFrame([(c, p, i) for (c, p), n in sizes.items() for i in range(n)], "chrom string, pos long, i int")
    got = {(r.chrom, r.pos): r.n for r in leveling(df, target, ["chrom", "pos", "i"]).groupBy("chrom", "pos").agg(F.count("*").alias("n")).collect()}
    assert sum(got.values()) == target and set(got) == set(sizes)
    # levelled: stacks that gave keep the same number, but for one
    given = [n for k, n in got.items() if n < sizes[k]]
    assert max(given) - min(given) <= max(0, max(sizes.values()) - min(sizes.values())) and all(n <= sizes[k] for k, n in got.items())

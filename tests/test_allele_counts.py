"""Copy-number likelihoods by product tree against the sample-by-sample fold."""

import time

import numpy as np
from pyspark.sql import functions as F

from locuswise.operators import allele_counts as ac


def fold(gl):
    """One sample at a time."""
    z = np.ones(1)
    for s in gl:
        w = 10.0 ** (s - s.max())
        z = np.convolve(z, [w[0], 2 * w[1], w[2]])
        z /= z.max()
    n = len(z) - 1
    log = np.r_[0, np.cumsum(np.log(np.arange(1, n + 1)))]
    out = z / np.exp(log[n] - log - log[::-1])
    return out / out.max()


def test_tree_equals_fold():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 5, 8, 17, 64, 101):
        gl = -rng.exponential(3, (4, n, 3))
        got = ac.copy_likelihoods(gl)
        assert got.shape == (4, 2 * n + 1)
        assert np.allclose(got, [fold(x) for x in gl], rtol=1e-9, atol=1e-12)


def test_ten_thousand_samples_in_seconds():
    rng = np.random.default_rng(5)
    carriers = rng.random(10_000) < 0.1
    gl = np.where(carriers[:, None], [-30.0, 0.0, -30.0], [0.0, -30.0, -60.0])
    t = time.time()
    (got,) = ac.copy_likelihoods(gl[None])
    assert time.time() - t < 20 and got.argmax() == carriers.sum() and len(got) == 20_001 and np.isfinite(got).all()


def test_columns(spark):
    rng = np.random.default_rng(7)
    sites = [-rng.exponential(2, (n, 3)) for n in (0, 1, 2, 2, 5, 1)]
    rows = [(k, [tuple(map(float, s)) for s in gl]) for k, gl in enumerate(sites)] + [(6, None), (7, [(0.0, None, -1.0)])]
    df = spark.createDataFrame(rows, "k int, g array<struct<rr:double,ra:double,aa:double>>").repartition(2)
    got = {r.k: r for r in df.select("k", ac.allele_count_likelihoods(F.col("g")).alias("l"), ac.iterated_copies(F.col("g"), 10.0, 0.01, 20).alias("e")).collect()}
    assert got[6].l is None and got[7].l is None and got[0].l == [1.0] and got[0].e[0] == 0
    for k, gl in enumerate(sites[1:], 1):
        assert np.allclose(got[k].l, fold(gl))
        alt = 0.0
        for _ in range(20):
            f = (alt + 0.01) / (2 * len(gl) + 10.01)
            p = 10.0 ** (gl - gl.max(axis=1, keepdims=True)) * [(1 - f) ** 2, 2 * f * (1 - f), f * f]
            p /= p.sum(axis=1, keepdims=True)
            alt = (p[:, 1] + 2 * p[:, 2]).sum()
        assert np.isclose(got[k].e[0], alt)

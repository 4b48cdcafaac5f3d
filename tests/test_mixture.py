import numpy as np
import pytest
from pyspark.sql import functions as F

from locuswise.operators import mixture as mx


def frame(spark, x):
    return spark.createDataFrame([(r.tolist(),) for r in x], "features array<double>").repartition(4)


def test_digamma():
    x = np.array([0.001, 0.5, 1.0, 3.7, 25.0])
    step = 1e-5
    import math

    want = [(math.lgamma(v + step * v) - math.lgamma(v - step * v)) / (2 * step * v) for v in x]
    assert np.allclose(mx.digamma(x), want, rtol=1e-6)


def test_moments_equal_one_pass_in_memory(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3))
    model = mx.maximised(np.array([200.0, 300.0]), rng.normal(size=(2, 3)) * 100, np.tile(np.eye(3) * 400, (2, 1, 1)))
    n, first, second = mx._collected(mx.moments(frame(spark, x), lambda v: mx.responsibilities(v, model)), 2, 3)
    p = mx.responsibilities(x, model)
    assert np.allclose(p.sum(axis=1), 1) and np.allclose(n, p.sum(axis=0)) and np.allclose(first, p.T @ x)
    assert np.allclose(second, np.einsum("nk,ni,nj->kij", p, x, x))


def in_memory(x, k, seed, steps):
    """The same fit over an array, step by step."""
    rng = np.random.default_rng(seed)
    means = rng.uniform(-4, 4, (k, x.shape[1]))
    for _ in range(mx.K_MEANS_STEPS):
        at = ((x[:, None] - means) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[at == c].mean(axis=0) if (at == c).any() else np.full(x.shape[1], np.nan) for c in range(k)])
        gone = np.isnan(moved[:, 0])
        moved[gone] = rng.uniform(-4, 4, (int(gone.sum()), x.shape[1]))
        if np.allclose(moved, means, atol=1e-9):
            break
        means = moved
    ones = np.ones(k)
    model = mx.Posterior(20 * ones, ones, 0.001 * ones, means, np.tile(np.eye(x.shape[1]) * 20, (k, 1, 1)))
    for _ in range(steps):
        p = mx.responsibilities(x, model)
        n = p.sum(axis=0) + 1e-10
        mean = (p.T @ x) / n[:, None]
        scatter = np.array([(p[:, c, None] * (x - mean[c])).T @ (x - mean[c]) for c in range(k)])
        pulled = np.array([n[c] / (1 + n[c]) * np.outer(mean[c], mean[c]) for c in range(k)])
        model = mx.Posterior(n + 20, n + 1, n + 0.001, n[:, None] * mean / (n + 1)[:, None], scatter + pulled + np.eye(x.shape[1]) / 200)
    p = mx.responsibilities(x, model)
    return sorted(p.sum(axis=0) / len(x), reverse=True)


def test_fit_finds_clusters_and_switches_the_rest_off(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal([-2, 0], 0.3, (60, 2)), rng.normal([2, 1], 0.3, (60, 2))])
    got = mx.fit_mixture(frame(spark, x).coalesce(2), k=5, seed=5)
    assert len(got) == 2 and all(g[0] == pytest.approx(0.5, abs=1e-3) for g in got)
    for c in (x[:60], x[60:]):
        g = min(got, key=lambda g: abs(g[1][0] - c[0, 0]))
        assert np.allclose(g[1], c.mean(axis=0), atol=0.01) and np.allclose(g[2], np.cov(c.T, bias=True), atol=0.01)


def test_steps_equal_those_in_memory(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(-1, 1, (200, 2)), rng.normal(1.5, 0.7, (200, 2))])
    got = mx.fit_mixture(frame(spark, x), k=3, seed=5, max_steps=2)
    assert np.allclose([g[0] for g in got], in_memory(x, 3, 5, 2)[: len(got)], atol=1e-6)


def test_no_rows(spark):
    with pytest.raises(ValueError, match="no training rows"):
        mx.fit_mixture(frame(spark, np.zeros((3, 2))).filter(F.lit(False)), 2)


def test_rows_are_packed_into_few_arrays(spark):
    x = np.arange(60.0).reshape(20, 3)
    blocks, n = mx.packed(frame(spark, x).repartition(7))
    try:
        got = blocks.collect()
        assert n == 20 and blocks.getNumPartitions() == 1 and len(got) == 1
        assert sorted(map(tuple, got[0])) == sorted(map(tuple, x))
        added = mx._added(blocks, lambda v: mx.nearest(v, x[[2, 15]]), 2, 3)
        want = mx._collected(mx.moments(frame(spark, x), lambda v: mx.nearest(v, x[[2, 15]])), 2, 3)
        assert all(np.allclose(a, b) for a, b in zip(added, want))
    finally:
        blocks.unpersist()


def test_queries_fit_whole_models(spark, tmp_path, monkeypatch):
    """No query cuts the steps of a fit or the components below the feature's own limits."""
    from locuswise.operators import vqsr as vq
    from locuswise.plans import vqsr_queries as vp

    spark.range(1, 301).selectExpr("id AS p_partkey", "CAST(id * 7 % 50 + 1 AS INT) AS p_size", "CAST(900 + id * 37 % 1000 AS DOUBLE) AS p_retailprice").write.parquet(
        str(tmp_path / "part.parquet")
    )
    seen = []

    def fit(training, k, seed, max_steps):
        seen.append((training.count() > 0, k, max_steps))
        return [(1.0, [0.0] * 3, np.eye(3).tolist())]

    monkeypatch.setattr(vq, "fit_mixture", fit)
    vp.fitted(spark, str(tmp_path))
    assert seen == [(True, 8, mx.MAX_STEPS), (True, 2, mx.MAX_STEPS)]

"""Bayesian Gaussian mixture over an array column, fitted by variational EM in Spark aggregates.

Weights have a Dirichlet prior and covariances a Wishart prior, so components without support lose their weight; centers start from
k-means. The training rows are packed once into arrays of ``BLOCK`` rows or more; a step is one short job over them: tasks turn arrays into
sums per component (weight, first and second moments), Spark adds them up in a tree, and the driver gets one number per component and moment,
whatever the number of rows. ``moments`` gives the same sums as rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Spread of the first centers, k-means steps, steps and change of log10 weights at which the fit ends, and the priors:
# scale of covariances (as an inverse), pull of means to zero, weight and counts.
START_SPREAD = 4.0
K_MEANS_STEPS = 100
MAX_STEPS, TOLERANCE = 150, 2e-3
SCALE, SHRINKAGE, DIRICHLET, PRIOR_COUNTS = 200.0, 1.0, 0.001, 20.0
#: a component that fewer rows than this support has been switched off
SUPPORT = 1e-3
#: rows of an array that a step works on at once, arrays a task gets at least and the largest number of tasks of a step
BLOCK, BLOCKS_A_TASK, MAX_TASKS = 8192, 8, 1024

Parameters = list[tuple[float, list[float], list[list[float]]]]


@dataclass
class Posterior:
    """Hyperparameters of ``k`` components: counts, pulls and weights (k), means (k, d), scale matrices (k, d, d)."""

    counts: np.ndarray
    pulls: np.ndarray
    weights: np.ndarray
    means: np.ndarray
    scales: np.ndarray


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of log-gamma: recurrence up to 6, then the asymptotic series."""
    x = np.array(x, float)
    out = np.zeros_like(x)
    while (x < 6).any():
        low = x < 6
        out[low] -= 1 / x[low]
        x[low] += 1
    y = 1 / x**2
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def responsibilities(x: np.ndarray, model: Posterior) -> np.ndarray:
    """(n, k) posterior share of each component in each row, by expected log weights and densities."""
    d = x.shape[1]
    log = digamma(model.weights) - digamma(model.weights.sum())
    _, logdet = np.linalg.slogdet(model.scales)
    log += 0.5 * (digamma((model.counts[:, None] + 1 - np.arange(1, d + 1)) / 2).sum(axis=1) + d * math.log(2) - logdet) - d / (2 * model.pulls)
    diff = x[:, None, :] - model.means
    log = log - 0.5 * model.counts * np.einsum("nki,kij,nkj->nk", diff, np.linalg.inv(model.scales), diff)
    p = np.exp(log - log.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def nearest(x: np.ndarray, means: np.ndarray) -> np.ndarray:
    """(n, k) with a one at the nearest mean."""
    at = ((x[:, None, :] - means) ** 2).sum(axis=2).argmin(axis=1)
    return np.eye(len(means))[at]


def _sums(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """(k, 1 + d + d * (d + 1) / 2) sums over rows of the shares, share * x_i and share * x_i * x_j, i <= j."""
    i, j = np.triu_indices(x.shape[1])
    return np.concatenate([p.sum(axis=0)[:, None], p.T @ x, p.T @ (x[:, i] * x[:, j])], axis=1)


def moments(rows: DataFrame, share: Callable[[np.ndarray], np.ndarray], features: str = "features") -> DataFrame:
    """component, i, j, value: sums over rows of share (i, j = -1), share * x_i (j = -1) and share * x_i * x_j, i <= j."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            col = b.column(0)
            x = np.asarray(col.flatten(), float).reshape(b.num_rows, -1)
            p = share(x)
            d, k = x.shape[1], p.shape[1]
            i, j = np.triu_indices(d)
            values = _sums(x, p)
            of = lambda v: pa.array(np.tile(v, k), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(k), values.shape[1]), pa.int32()), of(np.r_[-1, np.arange(d), i]), of(np.r_[-1, np.full(d, -1), j]), pa.array(values.ravel())],
                names=["component", "i", "j", "value"],
            )

    parts = rows.select(F.col(features).cast("array<double>")).mapInArrow(run, "component int, i int, j int, value double")
    return parts.groupBy("component", "i", "j").agg(F.sum("value").alias("value"))


def packed(rows: DataFrame, features: str = "features") -> tuple[RDD, int]:
    """The rows as arrays of less than twice ``BLOCK`` rows in few partitions, kept by the executors (``unpersist`` when done), and their number."""

    def arrays(batches):
        for b in batches:
            if b.num_rows:
                x = np.asarray(b.column(0).flatten(), "<f8").reshape(b.num_rows, -1)
                for at in range(0, len(x), BLOCK):
                    part = x[at : at + BLOCK]
                    yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int32()), pa.array([part.tobytes()])], names=["n", "x"])

    raw = rows.select(F.col(features).cast("array<double>")).mapInArrow(arrays, "n int, x binary").rdd.persist(StorageLevel.MEMORY_AND_DISK)
    n = raw.map(lambda r: r.n).sum()
    tasks = max(1, min(raw.getNumPartitions(), MAX_TASKS, -(-n // (BLOCK * BLOCKS_A_TASK))))

    def joined(blocks):
        """Small arrays of several partitions put together to whole blocks."""
        held: list[np.ndarray] = []
        for r in blocks:
            held.append(np.frombuffer(r.x, "<f8").reshape(r.n, -1))
            if sum(map(len, held)) >= BLOCK:
                yield np.concatenate(held)
                held = []
        if held:
            yield np.concatenate(held)

    blocks = raw.coalesce(tasks).mapPartitions(joined).persist(StorageLevel.MEMORY_AND_DISK)
    blocks.count()
    raw.unpersist()
    return blocks, n


def _collected(sums: DataFrame, k: int, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shares (k), first (k, d) and second (k, d, d) moments: k * (1 + d + d * (d + 1) / 2) numbers."""
    n, first, second = np.zeros(k), np.zeros((k, d)), np.zeros((k, d, d))
    for r in sums.collect():
        if r.i < 0:
            n[r.component] = r.value
        elif r.j < 0:
            first[r.component, r.i] = r.value
        else:
            second[r.component, r.i, r.j] = second[r.component, r.j, r.i] = r.value
    return n, first, second


def _added(blocks: RDD, share: Callable[[np.ndarray], np.ndarray], k: int, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers of ``_collected`` over packed rows."""
    sums = blocks.map(lambda x: _sums(x, share(x))).treeReduce(np.add)
    second = np.zeros((k, d, d))
    i, j = np.triu_indices(d)
    second[:, i, j] = second[:, j, i] = sums[:, 1 + d :]
    return sums[:, 0].copy(), sums[:, 1 : 1 + d].copy(), second


def maximised(n: np.ndarray, first: np.ndarray, second: np.ndarray) -> Posterior:
    """Hyperparameters from moments: priors at zero mean and the inverse of ``SCALE``."""
    d = first.shape[1]
    n = n + 1e-10
    mean = first / n[:, None]
    outer = mean[:, :, None] * mean[:, None, :]
    scatter = second - n[:, None, None] * outer
    pulled = (SHRINKAGE * n / (SHRINKAGE + n))[:, None, None] * outer
    return Posterior(n + PRIOR_COUNTS, n + SHRINKAGE, n + DIRICHLET, first / (n + SHRINKAGE)[:, None], scatter + pulled + np.eye(d) / SCALE)


def start_means(blocks: RDD, k: int, d: int, seed: int, steps: int = K_MEANS_STEPS) -> np.ndarray:
    """k-means centers from uniform first ones; a center that no row is nearest to is drawn anew. Ends early when no center moves."""
    rng = np.random.default_rng(seed)
    draw = lambda m: rng.uniform(-START_SPREAD, START_SPREAD, (m, d))
    means = draw(k)
    for _ in range(steps):
        n, first, _s = _added(blocks, lambda x, m=means: nearest(x, m), k, d)
        moved = np.where(n[:, None] > 0, first / np.maximum(n, 1)[:, None], 0.0)
        moved[n == 0] = draw(int((n == 0).sum()))
        if np.allclose(moved, means, atol=1e-9):
            break
        means = moved
    return means


def fit_mixture(training: DataFrame, k: int, seed: int = 7, max_steps: int = MAX_STEPS, k_means_steps: int = K_MEANS_STEPS, features: str = "features") -> Parameters:
    """(weight, mean, covariance) of the components that rows support, heaviest first. ``features`` is an array without nulls.

    The fit ends when the log10 weights change by less than ``TOLERANCE`` in all, or after ``max_steps``. An empty table is an error.
    """
    blocks, total = packed(training, features)
    try:
        if not total:
            raise ValueError("no training rows")
        d = blocks.first().shape[1]
        means = start_means(blocks, k, d, seed, k_means_steps)
        ones = np.ones(k)
        model = Posterior(PRIOR_COUNTS * ones, SHRINKAGE * ones, DIRICHLET * ones, means, np.tile(np.eye(d) * PRIOR_COUNTS, (k, 1, 1)))
        before = None
        for step in range(max_steps):
            sums = _added(blocks, lambda x, m=model: responsibilities(x, m), k, d)
            model = maximised(*sums)
            weights = np.log10(sums[0] + 1e-10) - math.log10((sums[0] + 1e-10).sum())
            if step > 1 and np.abs(weights - before).sum() < TOLERANCE:
                break
            before = weights
        n, first, second = _added(blocks, lambda x, m=model: responsibilities(x, m), k, d)
    finally:
        blocks.unpersist()
    out = []
    for c in np.argsort(-n, kind="stable"):
        if n[c] >= SUPPORT:
            mean = first[c] / n[c]
            out.append((float(n[c] / n[n >= SUPPORT].sum()), mean.tolist(), (second[c] / n[c] - np.outer(mean, mean)).tolist()))
    return out

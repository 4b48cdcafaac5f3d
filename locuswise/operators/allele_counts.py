"""Alternate-copy counts of whole cohorts: per site a product tree over its samples, in Arrow batches.

A sample is the polynomial rr + 2 ra x + aa x^2; the product over a site's samples has the likelihood of each number of alternate copies
as its coefficients. Neighbours are multiplied in pairs, and the products again, so most of the work is on short polynomials; sites of
a batch with equally many samples are multiplied together.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def weights(gl: np.ndarray) -> np.ndarray:
    """(..., 3) genotype likelihoods, the largest of a sample 1, from log10 ones."""
    return 10.0 ** (gl - gl.max(axis=-1, keepdims=True))


def product_tree(poly: np.ndarray) -> np.ndarray:
    """(sites, 2 n + 1) coefficients of the product of (sites, n, 3) polynomials, each site's largest 1."""
    sites, n, _ = poly.shape
    if not n:
        return np.ones((sites, 1))
    while poly.shape[1] > 1:
        if poly.shape[1] % 2:
            one = np.zeros((sites, 1, poly.shape[2]))
            one[..., 0] = 1
            poly = np.concatenate([poly, one], axis=1)
        a, b = poly[:, 0::2], poly[:, 1::2]
        size = poly.shape[2]
        poly = np.zeros((sites, a.shape[1], 2 * size - 1))
        for k in range(size):
            poly[..., k : k + size] += a[..., k : k + 1] * b
        top = poly.max(axis=2, keepdims=True)
        poly /= np.where(top > 0, top, 1)
    return poly[:, 0, : 2 * n + 1]


def copy_likelihoods(gl: np.ndarray) -> np.ndarray:
    """(sites, 2 n + 1) likelihoods of 0 to 2 n alternate copies, up to a factor, of (sites, n, 3) log10 genotype likelihoods."""
    z = product_tree(weights(gl) * np.array([1.0, 2.0, 1.0]))
    n = z.shape[1] - 1
    log_factorial = np.r_[0.0, np.cumsum(np.log(np.arange(1, n + 1)))]
    with np.errstate(divide="ignore"):
        log = np.log(z) - (log_factorial[n] - log_factorial - log_factorial[::-1])
    return np.exp(log - log.max(axis=1, keepdims=True))


def expected_copies(gl: np.ndarray, ref_count: float, alt_count: float, steps: int) -> np.ndarray:
    """(sites, 2): alternate copies after ``steps`` rounds of frequencies and genotype posteriors, and log10 P(no variant)."""
    w, n = weights(gl), 2.0 * gl.shape[1]

    def posterior(alt):
        f = ((alt + alt_count) / (n + ref_count + alt_count))[:, None]
        p = w * np.stack([(1 - f) ** 2, 2 * f * (1 - f), f**2], axis=-1)
        return p / p.sum(axis=-1, keepdims=True)

    alt = np.zeros(len(gl))
    for _ in range(steps):
        p = posterior(alt)
        alt = (p[..., 1] + 2 * p[..., 2]).sum(axis=1)
    with np.errstate(divide="ignore"):
        return np.stack([alt, np.log10(posterior(alt)[..., 0]).sum(axis=1)], axis=1)


def _by_cohort(col: pa.Array, of: Callable[[np.ndarray], np.ndarray]) -> pa.Array:
    """``of`` applied to sites with equally many samples at a time; null for null sites and for sites with a null likelihood."""
    sizes = np.asarray(col.value_lengths().fill_null(0))
    flat = col.flatten()
    gl = np.stack([flat.field(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("rr", "ra", "aa")], axis=1) if len(flat) else np.zeros((0, 3))
    starts = np.cumsum(sizes) - sizes
    out: list = [None] * len(col)
    for n in np.unique(sizes):
        sites = np.flatnonzero(sizes == n)
        part = gl[starts[sites][:, None] + np.arange(n)]
        fine = ~np.isnan(part).any(axis=(1, 2))
        for k, v in zip(sites[fine], of(part[fine]), strict=True):
            out[k] = v
    null = np.asarray(col.is_null())
    return pa.array([None if z else v for z, v in zip(null, out, strict=True)], pa.list_(pa.float64()))


def allele_count_likelihoods(gl3: Column) -> Column:
    """Likelihood of every alternate copy number of a site, up to a shared factor; ``gl3`` is an array of structs (rr, ra, aa) of log10
    likelihoods, one per sample. A site without samples has the one number 1."""

    @F.arrow_udf("array<double>")
    def of(gl: pa.Array) -> pa.Array:
        return _by_cohort(gl, copy_likelihoods)

    return of(_doubles(gl3))


def iterated_copies(gl3: Column, ref_count: float, alt_count: float, steps: int) -> Column:
    """Array of alternate copies and log10 P(no variant) of a site, see ``expected_copies``."""

    @F.arrow_udf("array<double>")
    def of(gl: pa.Array) -> pa.Array:
        return _by_cohort(gl, lambda x: expected_copies(x, ref_count, alt_count, steps))

    return of(_doubles(gl3))


def _doubles(gl3: Column) -> Column:
    return F.transform(gl3, lambda s: F.struct(*(s[c].cast("double").alias(c) for c in ("rr", "ra", "aa"))))

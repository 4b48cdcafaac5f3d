"""Variant score recalibration: features, normalisation, mixture model, tranches, filters."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswise.functions.alleles import site_type
from locuswise.operators.mixture import Parameters, fit_mixture
from locuswise.operators.sampling import reservoir
from locuswise.operators.scan import scan, with_row

# Outlier bound, cut-off of the negative set, default prior, cap of training rows, largest numbers of components.
STD_THRESHOLD = 10.0
BAD_LOD = -5.0
DEFAULT_PRIOR = 2.0
MAX_TRAINING = 2_500_000
MAX_GAUSSIANS, MAX_GAUSSIANS_NEGATIVE = 8, 2
MIN_LOD = -20000.0


def hash_gauss(*key: Column) -> Column:
    """Standard normal number drawn from the md5 of a key, the same in every run."""
    h = F.md5(F.concat_ws("|", *[k.cast("string") for k in key]))
    u = lambda i: (F.conv(F.substr(h, F.lit(i), F.lit(8)), 16, 10).cast("double") + 1) / (16.0**8 + 1)
    return F.sqrt(-2.0 * F.log(u(1))) * F.cos(2.0 * math.pi * u(9))


def mq_logit(mq: Column, cap: float, jitter: Column | None = None) -> Column:
    """Mapping quality on an open scale below ``cap``; values at the cap may get jitter."""
    eps = 0.01
    logit = lambda x: F.log((x + eps) / (cap + eps - x))
    value = logit(mq)
    return value if jitter is None else F.when(mq >= cap, value + jitter).otherwise(value)


def vqsr_features(variants: DataFrame, names: Sequence[str], from_map: str | None = None, every: int = 1) -> DataFrame:
    """Adds ``features`` (array of doubles, null where missing or not finite) from columns or an INFO map.

    ``every`` > 1 keeps each k-th variant by hash, an option of the model-building step only.
    """
    raw = lambda n: F.try_element_at(from_map, F.lit(n)).try_cast("double") if from_map else F.col(n).cast("double")
    fine = lambda c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
    d = variants.withColumn("features", F.array(*[fine(raw(n)) for n in names]))
    return d if every <= 1 else d.filter(F.pmod(F.xxhash64("chrom", "pos"), F.lit(every)) == 0)


def log_odds(prior: Column) -> Column:
    """Phred prior as log10 odds."""
    p = 1.0 - F.pow(F.lit(10.0), -prior / 10.0)
    return F.log10(p) - F.log10(1.0 - p)


def label_training_sites(
    variants: DataFrame, resources: DataFrame, by_allele: bool = False, trust_all: bool = False
) -> DataFrame:
    """Flags is_known, at_truth, at_training, at_anti and the prior of each variant.

    ``resources`` has chrom, pos, ref, alts, is_filtered, known, truth, training, anti, prior and,
    if genotypes exist, polymorphic. Only unfiltered records of the same class count; flags are OR-ed.
    """
    small = lambda r, a: site_type(r, a).isin("SNP", "MNP")
    res = resources.filter(~F.col("is_filtered") & (F.size("alts") > 0))
    if "polymorphic" in resources.columns and not trust_all:
        res = res.filter(F.coalesce("polymorphic", F.lit(True)))
    res = res.withColumn("_snp", small(F.col("ref"), F.col("alts")))
    keys = ["chrom", "pos", "_snp"]
    v = variants.withColumn("_snp", small(F.col("ref"), F.col("alts")))
    if by_allele:
        v = v.withColumn("_alt", F.get("alts", F.lit(0)))
        res = res.withColumn("_alt", F.explode("alts"))
        keys.append("_alt")
    flags = res.groupBy(*keys).agg(
        F.bool_or("known").alias("is_known"), F.bool_or("truth").alias("at_truth"), F.bool_or("training").alias("at_training"),
        F.bool_or("anti").alias("at_anti"), F.max("prior").alias("_prior"),
    )
    j = v.join(flags, keys, "left")
    return j.withColumns(
        {
            **{c: F.coalesce(c, F.lit(False)) for c in ("is_known", "at_truth", "at_training", "at_anti")},
            "prior": F.greatest(F.lit(DEFAULT_PRIOR), F.coalesce("_prior", F.lit(DEFAULT_PRIOR))),
        }
    ).drop("_snp", "_alt", "_prior")


def vqsr_normalise(variants: DataFrame, names: Sequence[str], key: Sequence[str] = ("chrom", "pos")) -> DataFrame:
    """``features`` as z-scores of the training rows; adds ``failing_sd``.

    Missing values become a small normal number drawn from the key; an annotation without variance
    is an error.
    """
    train = variants.filter("at_training").select("features")
    stats = train.agg(
        *[F.avg(F.get("features", F.lit(i))).alias(f"_m{i}") for i in range(len(names))],
        *[F.stddev_pop(F.get("features", F.lit(i))).alias(f"_s{i}") for i in range(len(names))],
    )
    j = with_row(variants, stats)

    def z(i, n):
        sd = F.when(
            F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) < 1e-5, F.raise_error(F.lit(f"annotation {n} has no variance in the training rows")).cast("double")
        ).otherwise(F.col(f"_s{i}"))
        x = F.get("features", F.lit(i))
        noise = 0.1 * hash_gauss(*[F.col(c) for c in key], F.lit(n))
        return F.when(x.isNull(), noise).otherwise((x - F.col(f"_m{i}")) / sd)

    d = j.withColumns(
        {"is_null": F.transform("features", lambda x: x.isNull()), "_z": F.array(*[z(i, n) for i, n in enumerate(names)])}
    )
    return d.withColumns({"features": F.col("_z"), "failing_sd": F.exists("_z", lambda x: F.abs(x) > STD_THRESHOLD)}).drop(
        "_z", *[f"_m{i}" for i in range(len(names))], *[f"_s{i}" for i in range(len(names))]
    )


def sample_training(variants: DataFrame, n: int = MAX_TRAINING, key: Sequence[str] = ("chrom", "pos", "ref"), seed: int = 0) -> DataFrame:
    """A uniform subset when there are more than ``n`` training rows: the feature's own limit on model input."""
    return reservoir(variants.filter("at_training AND NOT failing_sd"), n, key, seed)


def worst_variants(scored: DataFrame, cutoff: float = BAD_LOD) -> DataFrame:
    """Rows for the negative model."""
    return scored.filter((F.col("lod") < cutoff) & ~F.col("failing_sd"))


def fit_vqsr(training: DataFrame, k: int, seed: int = 7, max_iter: int = 150) -> Parameters:
    """(weight, mean, covariance) of the components of a Bayesian mixture over ``features``; ``k`` is their largest number, as
    components that no rows support switch themselves off."""
    return fit_mixture(training, k, seed, max_iter)


def vqsr_model_report(spark, params, names: Sequence[str]) -> DataFrame:
    """Weights, means and covariances as rows."""
    rows = []
    for c, (w, mean, cov) in enumerate(params):
        rows.append((c, "weight", None, None, w))
        rows += [(c, "mean", n, None, m) for n, m in zip(names, mean)]
        rows += [(c, "covariance", a, b, cov[i][j]) for i, a in enumerate(names) for j, b in enumerate(names)]
    return spark.createDataFrame(rows, "component int, part string, annotation string, other string, value double")


def _log_density(params):
    """Column function: log10 mixture density of ``features`` with null dimensions marginalised out."""

    @F.pandas_udf("double")
    def density(features: pd.Series, is_null: pd.Series) -> pd.Series:
        import numpy as np

        x = np.array(features.tolist(), dtype=float)
        if len(x) == 0:
            return pd.Series([], dtype=float)
        missing = np.array(is_null.tolist(), dtype=bool)
        out = np.empty(len(x))
        for pattern in np.unique(missing, axis=0):
            rows = (missing == pattern).all(axis=1)
            use = ~pattern
            parts = []
            for w, mean, cov in params:
                m, c = np.asarray(mean)[use], np.asarray(cov)[np.ix_(use, use)]
                d = x[rows][:, use] - m
                _, logdet = np.linalg.slogdet(c)
                quad = np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) if use.any() else np.zeros(rows.sum())
                parts.append(np.log(w) - 0.5 * (quad + logdet + use.sum() * np.log(2 * np.pi)))
            parts = np.array(parts)
            top = parts.max(axis=0)
            out[rows] = (top + np.log(np.exp(parts - top).sum(axis=0))) / np.log(10)
        return pd.Series(out)

    return density


def score_positive(variants: DataFrame, good) -> DataFrame:
    """``lod`` of the positive model alone; its worst rows train the negative model."""
    return variants.withColumn("lod", _log_density(good)("features", "is_null"))


def score_vqsr(variants: DataFrame, good, bad) -> DataFrame:
    """``lod`` = prior log odds + log10 density of the positive minus the negative model."""
    d = variants.withColumns({"_g": _log_density(good)("features", "is_null"), "_b": _log_density(bad)("features", "is_null")})
    lod = F.when(F.col("_g") == float("-inf"), F.lit(MIN_LOD)).otherwise(log_odds(F.col("prior")) + F.col("_g") - F.col("_b"))
    return d.withColumn("lod", lod).drop("_g", "_b")


def culprit(variants: DataFrame, good, bad, names: Sequence[str]) -> DataFrame:
    """Adds ``culprit``: the annotation whose one-dimensional density ratio is worst."""

    def one(params, i):
        x = F.get("features", F.lit(i))
        total = None
        for w, mean, cov in params:
            v = cov[i][i]
            p = w / math.sqrt(2 * math.pi * v) * F.exp(-F.pow(x - mean[i], 2) / (2 * v))
            total = p if total is None else total + p
        return F.log10(F.greatest(total, F.lit(1e-300)))

    ratios = [
        F.when(~F.get("is_null", F.lit(i)), F.struct((one(good, i) - one(bad, i)).alias("r"), F.lit(n).alias("n"))) for i, n in enumerate(names)
    ]
    return variants.withColumn("culprit", F.array_min(F.array_compact(F.array(*ratios)))["n"])


# ---- tranches -------------------------------------------------------------------------------

def _by_lod(scored: DataFrame) -> DataFrame:
    """Running counts from the best score down, one row per distinct score."""
    known, snp, ti = F.col("is_known"), F.col("is_snp"), F.col("is_transition")
    one = {
        "truth": F.col("at_truth"), "known": known, "novel": ~known,
        "known_ti": known & snp & ti, "known_tv": known & snp & ~ti, "novel_ti": ~known & snp & ti, "novel_tv": ~known & snp & ~ti,
    }
    per = scored.groupBy("lod").agg(*[F.count_if(c).alias(f"_{n}") for n, c in one.items()])
    return scan(per, [], "lod", {n: ("sum", F.col(f"_{n}"), True, True) for n in one}, tile=0.05).drop(*[f"_{n}" for n in one])


def find_tranches(scored: DataFrame, levels: Sequence[float], mode: str = "SNP") -> DataFrame:
    """Lowest score of each truth-sensitivity tranche with its statistics.

    A tranche of level t reaches down to the first score at which at most t percent of the truth
    sites are called. Counts run over distinct scores, so equal scores share a tranche.
    """
    cum = _by_lod(scored)
    total = scored.agg(F.count_if("at_truth").alias("_all"))
    c = with_row(cum, total)
    lowest = c.agg(
        *[F.min(F.when(F.col("truth") <= F.col("_all") * (t / 100.0) + 1e-9, F.struct("lod", *_STATS, "_all"))).alias(f"_t{i}") for i, t in enumerate(levels)]
    )
    return _tranche_rows(lowest, levels, mode)


_STATS = ["truth", "known", "novel", "known_ti", "known_tv", "novel_ti", "novel_tv"]


def _tranche_rows(lowest: DataFrame, levels: Sequence[float], mode: str) -> DataFrame:
    rows = F.array(
        *[
            F.struct(F.lit(float(t)).alias("level"), F.lit(float(p)).alias("previous"), F.col(f"_t{i}").alias("s"))
            for i, (t, p) in enumerate(zip(levels, [0.0, *levels[:-1]]))
        ]
    )
    d = lowest.select(F.explode(rows).alias("_r")).select("_r.level", "_r.previous", "_r.s.*").filter("lod IS NOT NULL")
    ratio = lambda a, b: F.col(a) / F.greatest(F.col(b).cast("double"), F.lit(1.0))
    return d.select(
        "level", F.col("lod").alias("min_lod"), F.col("known").alias("num_known"), F.col("novel").alias("num_novel"),
        ratio("known_ti", "known_tv").alias("known_titv"), ratio("novel_ti", "novel_tv").alias("novel_titv"),
        F.col("_all").alias("truth_sites"), F.col("truth").alias("called_truth"),
        F.format_string(f"VQSRTranche{mode}%.2fto%.2f", "previous", "level").alias("name"),
    )


def find_vqslod_tranches(scored: DataFrame, levels: Sequence[float], mode: str = "SNP") -> DataFrame:
    """The same statistics for the lowest score at or above each given score."""
    cum = _by_lod(scored)
    total = scored.agg(F.count_if("at_truth").alias("_all"))
    c = with_row(cum, total)
    lowest = c.agg(*[F.min(F.when(F.col("lod") >= t, F.struct("lod", *_STATS, "_all"))).alias(f"_t{i}") for i, t in enumerate(levels)])
    return _tranche_rows(lowest, levels, mode)


def fdr_to_titv(fdr: Column, target: float) -> Column:
    """Ti/Tv expected at a false-discovery percentage: random calls have a ratio of one half."""
    return (1.0 - fdr / 100.0) * (target - 0.5) + 0.5


def apply_vqsr(
    variants: DataFrame,
    recal: DataFrame,
    tranches: Sequence[tuple[float, float, str]] = (),
    level: float | None = None,
    lod_cutoff: float = 0.0,
    mode: str = "SNP",
    exclude_filtered: bool = False,
    ignore_filters: bool = False,
) -> DataFrame:
    """Score, culprit, training flags and filter of every variant of the chosen class.

    ``recal`` has chrom, pos, end, lod, culprit, at_training and at_anti; a variant without a row
    is an error. ``tranches`` holds (level, min_lod, name) in rising order: a handful of values.
    Variants of the other class or with filters pass through.
    """
    kind = site_type(F.col("ref"), F.col("alts"))
    own = kind.isin("SNP", "MNP") if mode == "SNP" else ~kind.isin("SNP", "MNP")
    own = F.lit(True) if mode == "BOTH" else own
    own = own if ignore_filters else own & ~F.col("is_filtered")
    r = recal.select("chrom", "pos", "end", F.col("lod").alias("_lod"), F.col("culprit").alias("_culprit"), F.col("at_training").alias("_pos"), F.col("at_anti").alias("_neg"))
    j = variants.withColumn("_own", own).join(r, ["chrom", "pos", "end"], "left")
    lost = F.raise_error(F.concat(F.lit("variant is not in the recalibration table: "), F.col("chrom"), F.lit(":"), F.col("pos").cast("string")))
    lod = F.when(F.col("_own"), F.when(F.col("_lod").isNull(), lost.cast("double")).otherwise(F.col("_lod")))
    label = filter_label(F.col("VQSLOD"), tranches, level, lod_cutoff)
    d = j.withColumns({"VQSLOD": lod}).withColumns(
        {
            "culprit": F.when(F.col("_own"), F.coalesce("_culprit", F.lit("NULL"))),
            "POSITIVE_TRAIN_SITE": F.col("_own") & F.coalesce("_pos", F.lit(False)),
            "NEGATIVE_TRAIN_SITE": F.col("_own") & F.coalesce("_neg", F.lit(False)),
            "filters": F.when(F.col("_own"), F.array(label)).otherwise(F.col("filters")),
        }
    ).drop("_own", "_lod", "_culprit", "_pos", "_neg")
    return d.filter(F.array_contains("filters", "PASS") | (F.size("filters") == 0)) if exclude_filtered else d


def filter_label(lod: Column, tranches, level: float | None, lod_cutoff: float) -> Column:
    if level is None:
        return F.when(lod < lod_cutoff, F.lit("LOW_VQSLOD")).otherwise(F.lit("PASS"))
    used = [t for t in sorted(tranches) if t[0] >= level]
    if not used:
        raise ValueError(f"no tranche at or above level {level}")
    out = F.when(lod >= used[0][1], F.lit("PASS"))
    for _, min_lod, name in used[1:]:
        out = out.when(lod >= min_lod, F.lit(name))
    return out.otherwise(F.lit(used[-1][2] + "+"))


def apply_vqsr_alleles(variants: DataFrame, recal: DataFrame, tranches=(), level: float | None = None, lod_cutoff: float = 0.0) -> DataFrame:
    """Allele-specific form: one score per alternate allele, joined on allele as well.

    Adds AS_VQSLOD, AS_FilterStatus and AS_culprit lists in allele order; the site takes the filter
    of its best allele.
    """
    key = ["chrom", "pos", "ref", "alts"]
    per = variants.select(*key, F.posexplode("alts").alias("_i", "alt")).join(recal.select("chrom", "pos", "alt", "lod", "culprit"), ["chrom", "pos", "alt"], "left")
    per = per.withColumn("_f", F.when(F.col("lod").isNotNull(), filter_label(F.col("lod"), tranches, level, lod_cutoff)).otherwise("NA"))
    g = per.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("_i", "lod", "culprit", "_f"))).alias("_r"), F.max_by("_f", F.coalesce("lod", F.lit(MIN_LOD))).alias("_best")
    )
    text = lambda f: F.array_join(F.transform("_r", f), ",")
    g = g.select(
        *key,
        text(lambda x: F.when(x["lod"].isNull(), F.lit("NaN")).otherwise(F.format_string("%.4f", x["lod"]))).alias("AS_VQSLOD"),
        text(lambda x: F.coalesce(x["culprit"], F.lit("NA"))).alias("AS_culprit"),
        text(lambda x: x["_f"]).alias("AS_FilterStatus"),
        F.array("_best").alias("filters"),
    )
    return variants.drop("filters").join(g, key)

"""Gaussian mixture by EM: one aggregation job per iteration.

The E step is a column expression per component (log weight + log density
with the model as literals, then log-sum-exp); the M step needs only the
sufficient statistics of each component around its previous mean, which one global
aggregate returns together with the log-likelihood.  Nothing row-sized
reaches the driver; the k·d·d model is updated there with numpy.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import GaussianTerms
from ..functions.vector import any_null, argmax, total
from ..session import shuffle_partitions
from .loop import numeric_base, persisted
from .relational import row_numbers


@dataclass
class GMMModel:
    features: list
    weights: list
    means: list
    covs: list
    iterations: int = 0
    converged: bool = False
    history: list = field(default_factory=list)

    def terms(self) -> list[GaussianTerms]:
        return [GaussianTerms(m, c) for m, c in zip(self.means, self.covs)]

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(j, float(w), [float(v) for v in m], [[float(v) for v in r] for r in c])
                for j, (w, m, c) in enumerate(zip(self.weights, self.means, self.covs))]
        return spark.createDataFrame(
            rows, "component int, weight double, mean array<double>, cov array<array<double>>")


FEW = 8  # features up to which a density is written out
SUMS = 200  # terms up to which each is an aggregate of its own


def _densities(xs: Sequence[Column], model: GMMModel) -> list[Column]:
    """log N(x; μ_j, Σ_j) of each component (null for an incomplete row); array lambdas only where many features would make too much code."""
    if len(xs) <= FEW:
        return [g.log_pdf(list(xs)) for g in model.terms()]
    return [g.log_pdf_array(F.array(*xs)) for g in model.terms()]


def responsibilities(df: DataFrame, xs: Sequence[Column], model: GMMModel) -> tuple[DataFrame, list[str], str]:
    """``df`` with γ_j columns and the log-likelihood, via log-sum-exp, and their names; a component of weight 0 has γ = 0.

    Each step is a column of its own, so no density is computed again wherever its value is used.
    """
    lp, gam = ([f"_gmm_{c}{j}" for j in range(len(model.weights))] for c in ("l", "g"))
    logs = [F.lit(float(np.log(w)) if w > 0 else float("-inf")) + d for w, d in zip(model.weights, _densities(xs, model))]
    df = df.withColumns(dict(zip(lp, logs)))
    df = df.withColumn("_gmm_m", F.greatest(*lp) if len(lp) > 1 else F.col(lp[0]))
    df = df.withColumn("_gmm_lse", F.col("_gmm_m") + F.log(total([F.exp(F.col(v) - F.col("_gmm_m")) for v in lp])))
    df = df.withColumns({g: F.exp(F.col(v) - F.col("_gmm_lse")) for g, v in zip(gam, lp)})
    return df.drop(*lp, "_gmm_m"), gam, "_gmm_lse"


def _times(factor: Column):
    return lambda v: v * factor


def _vector_sum(staged: DataFrame, xs: Sequence[Column], gam: Sequence[str], lse: str, model: GMMModel):
    """Row count and the sum of the vectors of all terms, None without rows."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    d = len(xs)
    upper = F.expr(f"flatten(transform(sequence(0, {d - 1}), a -> transform(sequence(a, {d - 1}), "
                   "b -> element_at(_z, a + 1) * element_at(_z, b + 1))))")
    staged = staged.select(F.array(*xs).alias("_x"), *gam, lse)
    parts = [F.array(lse)]
    for j, mean in enumerate(model.means):
        mu = F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in mean) + ")")
        z = F.zip_with("_x", mu, lambda a, b: a - b)
        staged = staged.withColumn("_z", z).withColumn("_u", upper).withColumn(
            f"_v{j}", F.transform(F.concat(F.array(F.lit(1.0)), "_z", "_u"), _times(F.col(gam[j]))))
        parts.append(F.col(f"_v{j}"))
    row = staged.agg(F.count(F.lit(1)).alias("n"), Summarizer.metrics("sum").summary(
        array_to_vector(F.concat(*parts))).alias("m")).first() if not staged.isEmpty() else None
    return row


def gmm_step_stats(base: DataFrame, features: Sequence[str], model: GMMModel) -> dict:
    """One job: row count, log-likelihood, and for each component Σγ, Σγz and Σγzzᵀ with z = x − μ_j.

    Up to ``SUMS`` terms are plain sums; beyond, each row becomes one vector of all of them and a single vector sum adds them up, whatever
    the number of features.  Centring on the previous means keeps the second moments
    exact for data far from the origin.
    """
    d, k = len(features), len(model.weights)
    size = 1 + d + d * (d + 1) // 2
    xs = [F.col(c) for c in features]
    staged, gam, lse = responsibilities(base.select(*features), xs, model)
    if 1 + k * size <= SUMS:
        zs = [[x - F.lit(float(v)) for x, v in zip(xs, mean)] for mean in model.means]
        terms = [F.col(lse)]
        for z, g in zip(zs, gam):
            terms += [F.col(g), *(v * F.col(g) for v in z), *(z[a] * z[b] * F.col(g) for a in range(d) for b in range(a, d))]
        row = staged.agg(F.count(F.lit(1)).alias("n"), F.count(lse).alias("whole"), *(F.sum(v).alias(f"t{i}") for i, v in enumerate(terms))).first()
        if not row["n"]:
            return {"n": 0, "ll": None}
        if row["whole"] < row["n"]:
            raise ValueError("gmm_step_stats needs complete rows")
        t = np.array([row[f"t{i}"] for i in range(len(terms))], float)
    else:
        row = _vector_sum(staged, xs, gam, lse, model)
        if row is None:
            return {"n": 0, "ll": None}
        t = np.asarray(row["m"]["sum"].toArray())
    stats = {"n": row["n"], "ll": float(t[0])}
    at = np.triu_indices(d)
    for j in range(k):
        own = t[1 + j * size:1 + (j + 1) * size]
        q = np.zeros((d, d))
        q[at] = own[1 + d:]
        stats[j] = (float(own[0]), own[1:1 + d], q + q.T - np.diag(np.diag(q)))
    return stats


def m_step(stats: dict, model: GMMModel, centering: str = "new", reg_covar: float = 0.0) -> GMMModel:
    """New weights, means and covariances; a component without any share gets weight 0 and keeps the rest."""
    if centering not in ("new", "old"):
        raise ValueError("centering is 'new' or 'old'")
    d = len(model.features)
    if not stats["n"]:
        return model
    weights, means, covs = [], [], []
    for j, (old_mean, old_cov) in enumerate(zip(model.means, model.covs)):
        g, s, q = stats[j]
        if g <= 0:
            weights.append(0.0), means.append(old_mean), covs.append(old_cov)
            continue
        shift = s / g
        cov = q / g - (np.outer(shift, shift) if centering == "new" else 0.0) + reg_covar * np.eye(d)
        weights.append(g / stats["n"]), means.append((np.asarray(old_mean) + shift).tolist()), covs.append(cov.tolist())
    return GMMModel(model.features, weights, means, covs)


def spread_rows(base: DataFrame, features: Sequence[str], key: str, k: int) -> list[list[float]]:
    """The rows at positions floor((i + 1/2) n / k) of the key order, i = 0 .. k-1 (fewer if there are fewer rows)."""
    n = base.count()
    wanted = sorted({int((i + 0.5) * n / k) for i in range(min(k, n))})
    numbered = row_numbers(base.select(key, *features), [], [key], out="_rn")
    rows = numbered.where((F.col("_rn") - 1).isin(wanted)).orderBy("_rn").collect()
    return [[float(r[c]) for c in features] for r in rows]


def initial_model(base: DataFrame, features: Sequence[str], k: int, key: str | None,
                  init_means=None, init_covs=None, init_weights=None) -> GMMModel:
    """Means: ``init_means`` or k rows spread evenly over the key order; covariances:
    the diagonal of the population variance of each feature; weights 1/k."""
    d = len(features)
    if init_means is None:
        if key is None:
            raise ValueError("give a key or init_means")
        init_means = spread_rows(base, features, key, k)
        if not init_means:
            raise ValueError("no complete rows to start the mixture from")
    if init_covs is None:
        v = base.agg(*[F.var_pop(c).alias(c) for c in features]).first()
        diag = np.diag([float(v[c] or 0.0) for c in features])
        init_covs = [diag.tolist() for _ in init_means]
    kk = len(init_means)
    weights = list(init_weights) if init_weights is not None else [1.0 / kk] * kk
    return GMMModel(list(features), weights, [list(map(float, m)) for m in init_means],
                    [np.asarray(c, dtype=float).reshape(d, d).tolist() for c in init_covs])


def gmm_fit(df: DataFrame, features: Sequence[str], k: int, key: str | None = None,
            max_iter: int = 40, tol: float = 1e-5, init_means=None, init_covs=None,
            centering: str = "new", reg_covar: float = 0.0) -> GMMModel:
    """EM from a deterministic start; stops when the mean log-likelihood per row (of the
    model before the step) changed by at most ``tol``, so the rule does not depend on
    the number of rows (``tol < 0``: run all)."""
    features = list(features)
    base = numeric_base(df, features, keep=[key] if key else [])
    spark = df.sparkSession
    base = base.repartition(min(shuffle_partitions(spark), 4 * spark.sparkContext.defaultParallelism))  # a narrow table is few files, so few tasks
    with persisted(base):
        model = initial_model(base, features, k, key, init_means, init_covs)
        hist = []
        prev = None
        it = 0
        converged = False
        while it < max_iter:
            stats = gmm_step_stats(base, features, model)
            ll = stats["ll"] / stats["n"] if stats["n"] else None
            hist.append({"iteration": it + 1, "log_likelihood": stats["ll"], "mean_log_likelihood": ll})
            if ll is None or prev is not None and abs(ll - prev) <= tol:
                converged = True
                break
            model = m_step(stats, model, centering, reg_covar)
            prev = ll
            it += 1
    model.iterations, model.converged, model.history = it, converged, hist
    return model


def gmm_predict(df: DataFrame, model: GMMModel, prediction: str = "prediction",
                probability: str = "probability") -> DataFrame:
    xs = [F.col(c).cast("double") for c in model.features]
    known = ~any_null(xs)
    staged, gam, lse = responsibilities(df, xs, model)
    cols = [F.col(g) for g in gam]
    return staged.withColumn(probability, F.when(known, F.array(*cols))).withColumn(prediction, argmax(cols)).drop(*gam, lse)


def gmm_densities(df: DataFrame, model: GMMModel, out: str = "density") -> DataFrame:
    """Per-component density N(x; μ_j, Σ_j), before weighting and normalisation."""
    xs = [F.col(c).cast("double") for c in model.features]
    return df.withColumn(out, F.array(*[F.exp(p) for p in _densities(xs, model)]))

"""Scalar math used by the learners: sigmoid, sign, entropy terms, Gaussian density."""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .vector import total

LOG_2PI = math.log(2.0 * math.pi)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def sign(z: Column) -> Column:
    """+1 when z >= 0 (zero counts as positive), else -1; null for a null score."""
    return F.when(z >= 0, F.lit(1)).when(z < 0, F.lit(-1))


def entropy_term(p: Column) -> Column:
    """-p·log2(p), 0 for p = 0."""
    return F.when(p > 0, -p * F.log2(p)).otherwise(F.lit(0.0))


def log_sum_exp(values: Sequence[Column]) -> Column:
    m = F.greatest(*values) if len(values) > 1 else values[0]
    return m + F.log(total([F.exp(v - m) for v in values]))


class GaussianTerms:
    """Model-sized constants of one multivariate normal, computed on the driver.

    Follows the pseudo-inverse convention of Spark's own multivariate Gaussian:
    eigenvalues at or below eps·max·d are treated as zero, the log
    pseudo-determinant sums the logs of the others, and the constant uses the
    full dimension d.
    """

    def __init__(self, mean: Sequence[float], cov: Sequence[Sequence[float]]):
        mu = np.asarray(mean, dtype=float)
        sigma = np.asarray(cov, dtype=float)
        d = mu.shape[0]
        vals, vecs = np.linalg.eigh((sigma + sigma.T) / 2.0)
        tol = np.finfo(float).eps * max(float(vals.max()), 0.0) * d
        keep = vals > tol
        if not keep.any():
            raise ValueError("covariance has no positive eigenvalue")
        inv = np.where(keep, 1.0 / np.where(keep, vals, 1.0), 0.0)
        self.mean = mu
        self.precision = (vecs * inv) @ vecs.T
        self.log_pdet = float(np.log(vals[keep]).sum())
        self.rank = int(keep.sum())
        self.const = -0.5 * (d * LOG_2PI + self.log_pdet)

    def log_pdf(self, xs: Sequence[Column]) -> Column:
        """log N(x; mean, cov) as one codegen-friendly expression."""
        d = len(xs)
        centred = [x - F.lit(float(m)) for x, m in zip(xs, self.mean)]
        terms = []
        for a in range(d):
            terms.append(centred[a] * centred[a] * F.lit(float(self.precision[a, a])))
            for b in range(a + 1, d):
                terms.append(centred[a] * centred[b] * F.lit(float(2.0 * self.precision[a, b])))
        return F.lit(self.const) - F.lit(0.5) * total(terms)

    def log_pdf_array(self, x: Column) -> Column:
        """Same density for an ``array<double>`` column, as array lambdas (wide features:
        d² terms would not fit in generated code).  The centred vector is bound once."""
        mu = F.array(*[F.lit(float(m)) for m in self.mean])
        prec = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in self.precision])

        def quad(c):
            pc = F.transform(prec, lambda row: F.aggregate(F.zip_with(row, c, lambda a, b: a * b),
                                                           F.lit(0.0), lambda acc, t: acc + t))
            return F.aggregate(F.zip_with(c, pc, lambda a, b: a * b), F.lit(0.0), lambda acc, t: acc + t)

        centred = F.array(F.zip_with(x, mu, lambda a, b: a - b))
        q = F.element_at(F.transform(centred, quad), 1)
        return F.lit(self.const) - F.lit(0.5) * q

"""Column-expression building blocks (all JVM-side, no Python UDFs)."""

from .distance import (METRICS, chebyshev, cosine, euclidean, feature_scales, hamming, jaccard,
                       manhattan, metric, minkowski, squared_euclidean, std_euclidean, tanimoto)
from .scalar import GaussianTerms, entropy_term, log_sum_exp, sigmoid, sign
from .vector import argmax, argmin, as_array, components, dot, linear, lit_vector, pick, total

__all__ = [
    "METRICS", "chebyshev", "cosine", "euclidean", "feature_scales", "hamming", "jaccard",
    "manhattan", "metric", "minkowski", "squared_euclidean", "std_euclidean", "tanimoto",
    "GaussianTerms", "entropy_term", "log_sum_exp", "sigmoid", "sign",
    "argmax", "argmin", "as_array", "components", "dot", "linear", "lit_vector", "pick", "total",
]

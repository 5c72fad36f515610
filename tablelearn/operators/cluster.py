"""k-means (Lloyd) as one aggregation job per iteration.

Centres are literals in the plan; assignment is one array expression over the
k squared distances, the same for every k and d.  The update is ``groupBy(cluster)`` with partial
aggregation, so each map task ships at most k small rows: a cluster holding a
third of all rows costs nothing extra.  The reference's cost (sum of
*unsquared* distances) is kept for the stop test; the squared cost is
reported beside it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vector import WIDE, mean_array
from .loop import history_df, numeric_base, persisted
from .relational import first_k


@dataclass
class KMeansModel:
    features: list
    centers: list
    sizes: list = field(default_factory=list)
    costs: list = field(default_factory=list)
    iterations: int = 0
    converged: bool = False
    history: list = field(default_factory=list)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, [float(v) for v in c], int(self.sizes[i]) if self.sizes else None,
                 float(self.costs[i]) if self.costs else None)
                for i, c in enumerate(self.centers)]
        return spark.createDataFrame(rows, "cluster int, center array<double>, n bigint, cost double")


def _assigned(df: DataFrame, features: Sequence[str], centers, cluster: str = "cluster",
              distance: str = "distance") -> DataFrame:
    """Nearest centre and its Euclidean distance; ties → smallest index, a null feature → nulls.

    The squared distances to all centres are one array expression, computed once per row.
    """
    rest = [c for c in df.columns if c not in (cluster, distance)]
    x = F.array(*[F.col(c).cast("double") for c in features])
    cen = F.expr("array(" + ", ".join("array(" + ", ".join(f"{float(v)!r}D" for v in c) + ")" for c in centers) + ")")
    d2 = F.transform(cen, lambda c: F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)),
                                                F.lit(0.0), lambda acc, t: acc + t))
    staged = df.select(*rest, d2.alias("_d2"))
    least = F.array_min("_d2")
    return staged.select(*rest, (F.array_position("_d2", least) - 1).cast("int").alias(cluster), F.sqrt(least).alias(distance))


def kmeans_assign(df: DataFrame, features: Sequence[str], centers: Sequence[Sequence[float]],
                  cluster: str = "cluster", distance: str = "distance") -> DataFrame:
    return _assigned(df, features, centers, cluster, distance)


def kmeans_update(assigned: DataFrame, features: Sequence[str], cluster: str = "cluster",
                  distance: str = "distance") -> DataFrame:
    """New centres (means m0, m1, …; of more than ``WIDE`` features one array, ``m``), sizes and cost (sum of distances) per cluster."""
    xs = [F.col(c).cast("double") for c in features]
    means = [mean_array(F.array(*xs), len(xs)).alias("m")] if len(xs) > WIDE else [F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)]
    return assigned.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(distance).alias("cost"),
        F.sum(F.col(distance) * F.col(distance)).alias("sq_cost"),
        *means,
    )


def kmeans_fit(df: DataFrame, features: Sequence[str], k: int, key: str | None = None,
               max_iter: int = 40, tol: float = 1e-8,
               init: Sequence[Sequence[float]] | None = None) -> KMeansModel:
    """Lloyd iterations from the k rows with the smallest ``key`` (or ``init``).

    Iteration i assigns rows to the centres of i-1, then moves each centre to
    its cluster mean; an empty cluster keeps its centre.  Stops when the cost
    changed by at most ``tol`` or after ``max_iter`` iterations (``tol < 0``
    runs all of them).
    """
    features = list(features)
    base = numeric_base(df, features, keep=[key] if key else [])
    with persisted(base):
        if init is None:
            if key is None:
                raise ValueError("give a key (seed rows = smallest keys) or init centres")
            seeds = first_k(base, key, k).collect()
            centers = [[float(r[c]) for c in features] for r in seeds]
        else:
            centers = [[float(v) for v in c] for c in init]
        if not centers:
            return KMeansModel(features, [], [], [], 0, True, [])
        xs = [F.col(c) for c in features]
        hist = []
        prev = None
        sizes, costs = [0] * len(centers), [0.0] * len(centers)
        it = 0
        converged = False
        while it < max_iter:
            rows = kmeans_update(_assigned(base, features, centers), features).collect()
            it += 1
            sizes, costs = [0] * len(centers), [0.0] * len(centers)
            new = [list(c) for c in centers]
            for r in rows:
                j = r["cluster"]
                sizes[j], costs[j] = int(r["n"]), float(r["cost"])
                new[j] = [float(v) for v in (r["m"] if len(features) > WIDE else [r[f"m{i}"] for i in range(len(features))])]
            cost = sum(costs)
            hist.append({"iteration": it, "cost": cost,
                         "sq_cost": sum(float(r["sq_cost"]) for r in rows)})
            centers = new
            if prev is not None and abs(cost - prev) <= tol:
                converged = True
                break
            prev = cost
    return KMeansModel(features, centers, sizes, costs, it, converged, hist)


def kmeans_predict(df: DataFrame, model: KMeansModel, cluster: str = "cluster",
                   distance: str | None = "distance") -> DataFrame:
    out = kmeans_assign(df, model.features, model.centers, cluster, distance or "_distance")
    return out if distance else out.drop("_distance")


def kmeans_history(spark: SparkSession, model: KMeansModel) -> DataFrame:
    return history_df(spark, model.history, "iteration int, cost double, sq_cost double")


__all__ = ["KMeansModel", "kmeans_assign", "kmeans_update", "kmeans_fit", "kmeans_predict",
           "kmeans_history"]

"""Perceptron, pocket perceptron and logistic regression.

Every step is one aggregation job: the current weights are literals in the
plan, and the job returns the error count / objective together with the
update direction (column sums for batch updates and gradients), so a step costs one scan of the
persisted projection and a partial+final aggregate of a few numbers.  Single updates
of the perceptron come many to a job: a bounded run of rows near the boundary reaches the driver, which
replays the updates as long as no other row can be the next one (``_Replay``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import sigmoid, sign
from ..functions.vector import WIDE, linear, mean_array
from .encode import LabelIndex, label_totals
from .loop import history_df, numeric_base, persisted

BIAS = "__bias__"


@dataclass
class LinearModel:
    features: list
    weights: list
    bias: float = 0.0
    kind: str = "sign"  # "sign" (perceptron) or "logistic"
    labels: LabelIndex | None = None
    iterations: int = 0
    converged: bool = False
    history: list = field(default_factory=list)
    best_errors: int | None = None

    def score(self) -> Column:
        return linear([F.col(c).cast("double") for c in self.features], self.weights, self.bias)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(f, float(w)) for f, w in zip(self.features, self.weights)] + [(BIAS, float(self.bias))]
        return spark.createDataFrame(rows, "feature string, weight double")


def _step_score(xs, weights, bias) -> Column:
    """w·x + b with the model as one array literal.

    Scalar literals would be part of the generated code, which would then be compiled
    anew for each step of a fit; an array literal is not.
    """
    model = F.array(*[F.lit(float(v)) for v in [*weights, bias]])
    return F.aggregate(F.zip_with(F.array(*xs, F.lit(1.0)), model, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def _sign_error(xs, weights, bias, y: Column) -> Column:
    return sign(_step_score(xs, weights, bias)) != y


RUN_VALUES = 1 << 18  # feature values of one run of rows
EVALUATED = 32  # candidates whose errors one job counts


class _Replay:
    """Single updates (the misclassified row of smallest key), many to a job, the same as one by one.

    A job returns the first rows, in key order, that are wrong or within ``reach`` of the boundary (|z| <= reach·|x|, with
    the bias as a feature of value 1).  While the weights have moved by no more than ``reach``, every other row up to the last
    returned key is still right (|Δ·x| <= |Δ|·|x|), so the next error of smallest key is among the
    returned rows, if one of them is wrong.  The reach adapts: it starts without a bound (the first rows of
    the table), falls where a run ends without an error, and grows where a run ends by its movement.
    """

    def __init__(self, base: DataFrame, xs: Sequence[Column], label: str, key: str, lr: float, rows: int | None):
        self.base, self.xs, self.label, self.key, self.lr = base, list(xs), label, key, lr
        self.rows = rows or max(64, RUN_VALUES // (len(self.xs) + 1))
        self.reach, self.jobs = float("inf"), 0

    def _scores(self, x: np.ndarray, w: list, b: float) -> np.ndarray:
        z = np.zeros(len(x))
        for i, v in enumerate(w):  # from the first feature to the last, then the bias, as the column form does
            z = z + x[:, i] * v
        return z + b

    def _run(self, w: list, b: float):
        z = _step_score(self.xs, w, b)
        wrong = sign(z) != F.col(self.label)
        if self.reach != float("inf"):
            size = F.sqrt(F.aggregate(F.array(*self.xs), F.lit(1.0), lambda acc, v: acc + v * v))
            wrong = wrong | (F.abs(z) <= F.lit(self.reach * (1 + 1e-9)) * size + F.lit(1e-300))
        else:
            wrong = wrong.isNotNull()
        rows = self.base.where(wrong).orderBy(self.key).limit(self.rows).select(*self.xs, F.col(self.label).cast("double").alias("_y")).collect()
        self.jobs += 1
        values = np.array([list(r) for r in rows], float).reshape(len(rows), len(self.xs) + 1)
        return values[:, :-1], values[:, -1], len(rows) < self.rows

    def updates(self, w: list, b: float, most: int) -> tuple[list, bool]:
        """The next weights, one for each update, ``most`` at most (one at least, if a row is wrong); and whether none is wrong after them."""
        out, start = [], np.array([*w, b])
        while True:
            x, y, whole = self._run(w, b)
            while len(out) < most:
                wrong = np.where(self._scores(x, w, b) >= 0, 1.0, -1.0) != y
                i = int(wrong.argmax()) if len(wrong) else 0
                if not len(wrong) or not wrong[i]:
                    if whole:
                        return out, True
                    self.reach = self.reach / 4 if self.reach != float("inf") else 64 * self.lr * float(np.sqrt((x * x).sum(1) + 1).mean())
                    break
                step = self.lr * y[i]
                w, b = [v + step * float(t) for v, t in zip(w, x[i])], b + step
                out.append((w, b))
                if np.linalg.norm(np.array([*w, b]) - start) > self.reach:
                    self.reach *= 2
                    break
            if out or not most:
                return out, False


def perceptron_fit(df: DataFrame, features: Sequence[str], label: str, key: str,
                   lr: float = 0.2, init: Sequence[float] | None = None, init_bias: float = 0.0,
                   update: str = "single", max_iter: int = 100_000, seed: int | None = None, rows: int | None = None) -> LinearModel:
    """Perceptron on a ±1 integer label.

    ``update="single"``: each step moves the weights by the misclassified row
    with the smallest ``key`` (unique) or, with a ``seed``, the smallest hash of (seed, step, key):
    a random pick that is the same in every run.  Without a seed, one job serves a whole run of updates
    (``rows`` rows at most reach the driver, see ``_Replay``); with one, each update is a job.
    ``update="batch"``: each step adds lr·Σ y·x over all misclassified rows.  Stops when no row is
    misclassified or after ``max_iter`` updates; ``converged`` and the last errors of ``history`` tell which.
    """
    if update not in ("single", "batch"):
        raise ValueError("update must be 'single' or 'batch'")
    features = list(features)
    w = [float(v) for v in (init if init is not None else [0.0] * len(features))]
    b = float(init_bias)
    base = numeric_base(df, features, keep=[key, label])
    xs = [F.col(c) for c in features]
    y = F.col(label).cast("double")
    hist = []
    converged = False
    it = 0
    with persisted(base):
        replay = _Replay(base, xs, label, key, lr, rows) if update == "single" and seed is None else None
        while True:
            err = _sign_error(xs, w, b, F.col(label))
            aggs = [F.count_if(err).alias("errors")]
            if update == "single" and replay is None:
                pick = F.struct(y.alias("y"), *[x.alias(f"x{i}") for i, x in enumerate(xs)])
                order = F.struct(F.xxhash64(F.lit(seed), F.lit(it), F.col(key)), F.col(key))
                aggs.append(F.min_by(pick, F.when(err, order)).alias("pick"))
            elif update == "batch":
                aggs.append(F.sum(F.when(err, y)).alias("sy"))
                aggs += [F.sum(F.when(err, y * x)).alias(f"s{i}") for i, x in enumerate(xs)]
            row = base.agg(*aggs).first()
            errors = int(row["errors"])
            hist.append({"iteration": it, "errors": errors, "bias": b, "weights": list(w)})
            if errors == 0:
                converged = True
                break
            if it >= max_iter:
                break
            if replay is not None:
                made, ended = replay.updates(w, b, max_iter - it)
                while not ended and it + len(made) < max_iter and len(made) < 10 * replay.rows:  # errors are counted now and then
                    more, ended = replay.updates(*made[-1], max_iter - it - len(made))
                    made += more
                w, b = made[-1]
                it += len(made)
            elif update == "single":
                p = row["pick"]
                step = lr * p["y"]
                w = [wi + step * p[f"x{i}"] for i, wi in enumerate(w)]
                b = b + step
                it += 1
            else:
                w = [wi + lr * row[f"s{i}"] for i, wi in enumerate(w)]
                b = b + lr * row["sy"]
                it += 1
    return LinearModel(features, w, b, "sign", iterations=it, converged=converged, history=hist)


def pocket_fit(df: DataFrame, features: Sequence[str], label: str, key: str, lr: float = 0.1,
               max_iter: int = 200, init: Sequence[float] | None = None,
               init_bias: float = 0.0, rows: int | None = None) -> LinearModel:
    """Pocket perceptron: single updates, keeps the weights with the fewest errors.

    The updates of a run are replayed as in ``perceptron_fit``, then one job counts the errors of up to ``EVALUATED`` of the
    weights on the way (w_0 to w_max_iter); the pocket keeps the first weights reaching the smallest count.
    """
    features = list(features)
    w = [float(v) for v in (init if init is not None else [0.0] * len(features))]
    b = float(init_bias)
    best_w, best_b, best_err = list(w), b, None
    base = numeric_base(df, features, keep=[key, label])
    xs = [F.col(c) for c in features]
    hist = []
    with persisted(base):
        replay = _Replay(base, xs, label, key, lr, rows)
        waiting, made, ended = [(w, b)], 0, False
        while waiting or not ended:
            while not ended and made < max_iter and len(waiting) < EVALUATED:
                more, ended = replay.updates(w, b, min(max_iter - made, EVALUATED - len(waiting)))
                waiting += more
                made += len(more)
                w, b = more[-1] if more else (w, b)
            ended = ended or made >= max_iter
            part, waiting = waiting[:EVALUATED], waiting[EVALUATED:]
            if not part:
                break
            counts = base.agg(*[F.count_if(_sign_error(xs, cw, cb, F.col(label))).alias(f"e{i}") for i, (cw, cb) in enumerate(part)]).first()
            for (cw, cb), errors in zip(part, counts):
                if best_err is None or errors < best_err:
                    best_w, best_b, best_err = list(cw), cb, int(errors)
                hist.append({"iteration": len(hist), "errors": int(errors), "best_errors": best_err})
    return LinearModel(features, best_w, best_b, "sign", iterations=made,
                       converged=best_err == 0, history=hist, best_errors=best_err)


def _softplus(t: Column) -> Column:
    # log(1 + exp(t)) without overflow
    return F.greatest(t, F.lit(0.0)) + F.log(F.lit(1.0) + F.exp(-F.abs(t)))


def logreg_step(base: DataFrame, features: Sequence[str], y: str, weights: Sequence[float], bias: float = 0.0) -> DataFrame:
    """One row: mean log-loss, mean probability of the true class, and the mean gradient (g_bias, g0, g1, ...;
    of more than ``WIDE`` features one array, ``g``).

    ``y`` holds 0.0 and 1.0; rows where it or a feature is null do not count.
    """
    xs = [F.col(c).cast("double") for c in features]
    yv = F.col(y)
    z = _step_score(xs, weights, bias)
    wide = len(xs) > WIDE
    held = [F.array(*xs).alias("_x")] if wide else [x.alias(f"_x{i}") for i, x in enumerate(xs)]
    staged = base.select(F.when(yv.isNotNull(), z).alias("_z"), yv.alias("_y"), *held)
    z, yv = F.col("_z"), F.col("_y")
    s = sigmoid(z)
    loss = F.when(yv == 1.0, _softplus(-z)).when(yv == 0.0, _softplus(z))
    if wide:
        staged = staged.withColumn("_r", s - yv)
        gradient = [mean_array(F.transform("_x", lambda x: x * F.col("_r")), len(xs)).alias("g")]
    else:
        gradient = [F.avg((s - yv) * F.col(f"_x{i}")).alias(f"g{i}") for i in range(len(xs))]
    return staged.where(z.isNotNull()).agg(
        F.avg(loss).alias("log_loss"), F.avg(yv * s + (F.lit(1.0) - yv) * (F.lit(1.0) - s)).alias("mean_true_prob"),
        F.avg(s - yv).alias("g_bias"), *gradient)


def logreg_fit(df: DataFrame, features: Sequence[str], label: str, lr: float = 0.05,
               max_iter: int = 40, tol: float = 1e-3, init: Sequence[float] | None = None,
               fit_intercept: bool = False, labels: LabelIndex | None = None) -> LinearModel:
    """Binary logistic regression by batch gradient descent.

    The label is indexed by falling frequency (index 1.0 is the positive
    class).  Iteration i computes, in one job, the mean log-loss, the mean
    probability of the true class, and the mean gradient at w_{i-1}; it stops
    without updating when the log-loss changed by at most ``tol``
    (``tol < 0`` runs exactly ``max_iter`` updates).
    """
    features = list(features)
    labels = labels or binary_labels(df, label)
    w = [float(v) for v in (init if init is not None else [0.0] * len(features))]
    b = 0.0
    base = numeric_base(df.withColumn("_y", labels.index(label)), features, keep=["_y"])
    hist = []
    prev = None
    it = 0
    converged = False
    with persisted(base):
        while it < max_iter:
            row = logreg_step(base, features, "_y", w, b).first()
            obj = row["log_loss"]
            if obj is None:
                break
            hist.append({"iteration": it + 1, "log_loss": obj, "mean_true_prob": row["mean_true_prob"]})
            if prev is not None and abs(obj - prev) <= tol:
                converged = True
                break
            gradient = row["g"] if len(features) > WIDE else [row[f"g{i}"] for i in range(len(features))]
            w = [wi - lr * g for wi, g in zip(w, gradient)]
            if fit_intercept:
                b = b - lr * row["g_bias"]
            prev = obj
            it += 1
    return LinearModel(features, w, b, "logistic", labels=labels, iterations=it,
                       converged=converged, history=hist)


def binary_labels(df: DataFrame, label: str) -> LabelIndex:
    """The two labels by falling frequency (an error if there are more)."""
    rows = label_totals(df, label).orderBy(F.desc("n"), F.col(label)).limit(3).collect()
    if len(rows) > 2:
        raise ValueError("logistic regression here is binary; got more than two labels")
    return LabelIndex(label, [r[label] for r in rows])


def linear_predict(df: DataFrame, model: LinearModel, prediction: str = "prediction",
                   score: str | None = None) -> DataFrame:
    """Score any DataFrame: sign (±1) or logistic (probability + original label); a null feature gives nulls."""
    z = model.score()
    out = df if score is None else df.withColumn(score, z)
    if model.kind == "sign":
        return out.withColumn(prediction, sign(z))
    idx = F.when(z >= 0, F.lit(1.0)).when(z < 0, F.lit(0.0))
    out = out.withColumn("probability", sigmoid(z))
    if model.labels is not None:
        return out.withColumn(prediction, model.labels.unindex(idx))
    return out.withColumn(prediction, idx)


def history_table(spark: SparkSession, model: LinearModel) -> DataFrame:
    if model.kind == "logistic":
        return history_df(spark, model.history, "iteration int, log_loss double, mean_true_prob double")
    return history_df(spark, model.history, "iteration int, errors bigint")


__all__ = ["LinearModel", "perceptron_fit", "pocket_fit", "logreg_step", "logreg_fit", "binary_labels", "linear_predict",
           "history_table", "BIAS"]

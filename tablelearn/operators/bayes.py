"""Categorical naive Bayes with additive smoothing.

Fit = two aggregations: class counts, and counts of (class, feature, value)
from the unpivoted table (partial aggregation before the shuffle, so a hot
class or value costs one row per task).  Only cells that occur are stored,
both tables are written once below ``spark.checkpoint.dir``, and what reaches
the driver is the number of rows, of classes, and of values per feature.

Scoring: a cell that a class has never had needs no row, because its
log-probability ln λ − ln(n_c + λ·V_f) depends on the class by its count
alone.  So the best class of a row is the better one of

* the best among the classes that have at least one of its values (rows are
  reduced to distinct value tuples, joined with the cells of each value), and
* the best by such defaults alone, found once per set of present features
  over the distinct class counts (at most sqrt(2N) of them).

A class of the second kind that also has a value of the row scores higher in
the first, so the maximum of both is exact; ties go to the smaller class.
Repeated rows stay.  A null feature adds nothing; a value that the fit has not
seen has count 0.  With smoothing 0 a count of 0 gives -inf; if all classes
have it, the smallest class wins the tie.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vector import argmax, pick, total
from ..session import shuffle_partitions
from .encode import unpivot_features
from .relational import written

CLASS_BLOCK = 1000  # classes that meet a value in one group of the dense table


@dataclass
class NBModel:
    label: str
    features: list
    smoothing: float
    n_rows: int
    n_classes: int
    n_values: dict           # feature -> V_f (distinct values seen)
    classes_df: DataFrame    # _c, _nc
    seen_df: DataFrame       # _c, feature, value, n: cells that occur

    @property
    def class_counts(self) -> dict:
        """Class -> count, on the driver: for a few classes (inspection, scoring of streams)."""
        return {r["_c"]: int(r["_nc"]) for r in self.classes_df.collect()}

    @property
    def classes(self) -> list:
        return sorted(self.class_counts)

    @property
    def cells_df(self) -> DataFrame:
        """label, feature, value, n, prob for every class and seen value, zero counts too."""
        return _dense(self.classes_df, self.seen_df, self.label, self.smoothing)


def _smoothing(smoothing: float | str) -> float:
    lam = 0.0 if smoothing == "none" else float(smoothing)
    if lam < 0:
        raise ValueError("smoothing must not be negative")
    return lam


def _base(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull()).select(
        F.col(label), *[F.col(c).cast("string").alias(c) for c in features])


def nb_fit(df: DataFrame, features: Sequence[str], label: str, smoothing: float | str = 1.0) -> NBModel:
    """Counts of the training rows (``smoothing="none"`` is 0)."""
    features, lam = list(features), _smoothing(smoothing)
    base = _base(df, features, label)
    classes = written(_class_counts(base, label), "nb-classes")
    cells = written(_cells(base, features, label), "nb-cells")
    sums = classes.agg(F.sum("_nc").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    nv = {r["feature"]: int(r["nv"]) for r in
          cells.groupBy("feature").agg(F.countDistinct("value").alias("nv")).collect()}
    return NBModel(label, features, lam, int(sums["rows"] or 0), int(sums["classes"]),
                   {f: nv.get(f, 0) for f in features}, classes, cells)


def _class_counts(base: DataFrame, label: str) -> DataFrame:
    return base.groupBy(F.col(label).alias("_c")).agg(F.count(F.lit(1)).alias("_nc"))


def _cells(base: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    long = unpivot_features(base.withColumn("_c", F.col(label)), ["_c"], features).where(F.col("value").isNotNull())
    return long.groupBy("_c", "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def nb_priors(df: DataFrame, label: str, smoothing: float | str = 1.0) -> DataFrame:
    """label, n, prior = (n_c + λ) / (N + λ·C): one aggregation."""
    lam = F.lit(_smoothing(smoothing))
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # one row per class: totals by a window over this model-sized table (no join)
    everything = Window.partitionBy()
    return counts.select(label, "n", ((F.col("n") + lam) / (F.sum("n").over(everything)
                                                           + lam * F.count(F.lit(1)).over(everything))).alias("prior"))


def nb_tables(base: DataFrame, features: Sequence[str], label: str,
              smoothing: float | str = 1.0) -> tuple[DataFrame, DataFrame]:
    """(priors, conditionals) as DataFrames.

    priors: see ``nb_priors``
    conditionals: label, feature, value, n, prob = (n + λ) / (n_c + λ·V_f), a row for every
    class and every value seen in any class (n = 0 where a class never has it)
    """
    classes, cells = _class_counts(base, label), _cells(base, features, label)
    return nb_priors(base, label, smoothing), _dense(classes, cells, label, _smoothing(smoothing))


def _dense(classes: DataFrame, cells: DataFrame, label: str, lam: float) -> DataFrame:
    """Every class with every seen value.

    The table is the output itself, one row per pair.  Values and classes meet on (class block, value
    salt): values are repeated per block of about CLASS_BLOCK classes, classes per salt, so
    that no key holds more than its share of either.
    """
    salts = shuffle_partitions(cells.sparkSession)
    blocks = max(1, math.ceil(classes.count() / CLASS_BLOCK))
    nv = cells.groupBy("feature").agg(F.countDistinct("value").alias("_V"))
    values = (cells.select("feature", "value").distinct().join(nv, "feature")
              .withColumn("_salt", F.pmod(F.xxhash64("feature", "value"), F.lit(salts)))
              .withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    dealt = (classes.withColumn("_block", F.pmod(F.xxhash64("_c"), F.lit(blocks)).cast("int"))
             .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))))
    grid = values.join(dealt, ["_block", "_salt"]).join(cells, ["_c", "feature", "value"], "left")
    n = F.coalesce(F.col("n"), F.lit(0).cast("long"))
    return grid.select(F.col("_c").alias(label), "feature", "value", n.alias("n"),
                       ((n + F.lit(lam)) / (F.col("_nc") + F.lit(lam) * F.col("_V"))).alias("prob"))


def _class_part(model: NBModel, absent) -> Column:
    """ln prior of a class of ``_nc`` rows less the logarithms of the divisors of the features that are present."""
    lam = model.smoothing
    n = F.col("_nc") + F.lit(lam)
    prior = F.log(n / F.lit(model.n_rows + lam * model.n_classes))
    return total([prior] + [F.when(absent(i), F.lit(0.0)).otherwise(-F.log(F.col("_nc") + F.lit(lam * model.n_values[f])))
                            for i, f in enumerate(model.features)])


def _unseen(model: NBModel, k: Column) -> Column:
    """The numerators of ``k`` present values that a class has never had."""
    log_lam = math.log(model.smoothing) if model.smoothing else float("-inf")
    return F.when(k > 0, k * F.lit(log_lam)).otherwise(F.lit(0.0))


def nb_predict(df: DataFrame, model: NBModel, prediction: str = "prediction") -> DataFrame:
    """Most probable class: argmax of ln prior + Σ ln p(value | class); ties → smaller class."""
    kind = model.classes_df.schema["_c"].dataType
    if not model.n_classes:
        return df.withColumn(prediction, F.lit(None).cast(kind))
    if df.isStreaming:
        return _predict_rows(df, model, prediction)
    lam = model.smoothing
    values = F.array(*[F.col(f).cast("string") for f in model.features])
    tuples = df.select(values.alias("_p")).distinct()
    present = F.size(F.array_compact("_p"))
    best = F.min(F.struct((-F.col("_score")).alias("s"), F.col("_c").alias("c")))  # highest score, then smallest class

    # classes that have a value of the row: the terms are added in sorted order, so equal classes tie exactly
    at = F.element_at(F.array(*[F.lit(f) for f in model.features]), F.col("_i") + 1)
    long = (tuples.select("_p", F.posexplode("_p").alias("_i", "value")).where(F.col("value").isNotNull())
            .select("_p", at.alias("feature"), "value"))
    hits = (long.join(model.seen_df, ["feature", "value"]).groupBy("_p", "_c")
            .agg(F.array_sort(F.collect_list(F.log(F.col("n") + F.lit(lam)))).alias("_t")))
    seen = F.aggregate("_t", F.lit(0.0), lambda a, x: a + x)
    scored = hits.join(model.classes_df, "_c").select("_p", "_c", (
        _class_part(model, lambda i: F.col("_p")[i].isNull()) + seen + _unseen(model, present - F.size("_t"))).alias("_score"))
    by_cells = scored.groupBy("_p").agg(best.alias("_cells"))

    # defaults alone: per set of present features over the distinct class counts
    salts = shuffle_partitions(df.sparkSession)
    absent = F.transform("_p", lambda v: v.isNull())
    sizes = (model.classes_df.groupBy("_nc").agg(F.min("_c").alias("_c"))
             .withColumn("_salt", F.pmod(F.xxhash64("_nc"), F.lit(salts))))
    masks = (tuples.select(absent.alias("_mask")).distinct()
             .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))))
    kept = F.size(F.filter("_mask", lambda m: ~m))
    by_default = (masks.join(sizes, "_salt").select("_mask", "_c", (
        _class_part(model, lambda i: F.col("_mask")[i]) + _unseen(model, kept)).alias("_score"))
        .groupBy("_mask").agg(best.alias("_default")))

    chosen = (tuples.withColumn("_mask", absent).join(by_default, "_mask")
              .join(by_cells.withColumnRenamed("_p", "_q"), F.col("_p") == F.col("_q"), "left")
              .select(F.col("_p").alias("_q"), F.least("_cells", "_default")["c"].alias("_best")))
    rows = df.select(F.struct("*").alias("_row"), values.alias("_p"))
    return rows.join(chosen, F.col("_p") == F.col("_q"), "left").select(
        *[F.col("_row")[c].alias(c) for c in df.columns if c != prediction], F.col("_best").alias(prediction))


def _predict_rows(df: DataFrame, model: NBModel, prediction: str) -> DataFrame:
    """The same by one join per feature and one column per class: for streams, which have no distinct tuples."""
    lam, counts = model.smoothing, model.class_counts
    classes = sorted(counts)
    out = df.select(F.struct("*").alias("_row"), *[F.col(f).cast("string").alias(f"_v{i}") for i, f in enumerate(model.features)])
    for i, f in enumerate(model.features):
        table = (model.seen_df.where(F.col("feature") == f).groupBy(F.col("value").alias(f"_k{i}"))
                 .agg(*[F.sum(F.when(F.col("_c") == F.lit(c), F.col("n"))).alias(f"_n{i}_{j}") for j, c in enumerate(classes)]))
        out = out.join(table, F.col(f"_v{i}") == F.col(f"_k{i}"), "left")

    def term(i, j, f, c):
        top = F.coalesce(F.col(f"_n{i}_{j}"), F.lit(0)) + F.lit(lam)
        value = F.when(top > 0, F.log(top / F.lit(counts[c] + lam * model.n_values[f]))).otherwise(F.lit(float("-inf")))
        return F.when(F.col(f"_v{i}").isNull(), F.lit(0.0)).otherwise(value)

    scores = [total([F.lit(math.log((counts[c] + lam) / (model.n_rows + lam * model.n_classes)))]
                    + [term(i, j, f, c) for i, f in enumerate(model.features)]) for j, c in enumerate(classes)]
    staged = out.select("_row", *[s.alias(f"_s{j}") for j, s in enumerate(scores)])
    best = argmax([F.col(f"_s{j}") for j in range(len(scores))])
    return staged.select(*[F.col("_row")[c].alias(c) for c in df.columns if c != prediction],
                         pick([F.lit(c) for c in classes], best).alias(prediction))


__all__ = ["NBModel", "nb_fit", "nb_priors", "nb_tables", "nb_predict"]

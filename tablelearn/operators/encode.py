"""Preparation: feature assembly, label indexing, unpivot, contingency counts.

A label mapping is a DataFrame with one row per distinct label.  It is applied by a join,
which Spark broadcasts or shuffles by its size, so it has no limit; a
``LabelIndex`` holds the few classes of a model (two, for logistic regression) as literals.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vector import as_array
from .relational import row_numbers


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric feature columns → one ``array<double>`` column."""
    return df.withColumn(out, as_array([F.col(c) for c in features]))


def to_ml_vector(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric columns → an ML dense/sparse vector column (for ML-library interop)."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def vector_to_array(df: DataFrame, vec: str, out: str | None = None) -> DataFrame:
    """ML vector column → ``array<double>`` (dense and sparse vectors)."""
    from pyspark.ml.functions import vector_to_array as v2a

    return df.withColumn(out or vec, v2a(F.col(vec), "float64"))


def literal_map(pairs: Sequence[tuple]) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in pairs))


def label_totals(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """Distinct labels with counts and their index by falling count, ties by label.

    Numbered by range partitions: no task sorts all labels.
    """
    counts = label_totals(df, label).withColumn("_down", -F.col("n"))
    numbered = row_numbers(counts, [], ["_down", label], out="_rn")
    return numbered.select(label, "n", (F.col("_rn") - 1).cast("double").alias("label_index"))


@dataclass
class LabelIndex:
    label: str
    labels: list  # labels[i] has index i; a few classes only

    def index(self, c: str | Column | None = None) -> Column:
        src = F.col(c) if isinstance(c, str) else (c if c is not None else F.col(self.label))
        return F.element_at(literal_map([(v, float(i)) for i, v in enumerate(self.labels)]), src)

    def unindex(self, c: str | Column) -> Column:
        src = F.col(c) if isinstance(c, str) else c
        return F.element_at(literal_map([(float(i), v) for i, v in enumerate(self.labels)]), src)


def apply_label_index(df: DataFrame, mapping: DataFrame, label: str,
                      out: str = "label_index") -> DataFrame:
    """``out``: the index of each row's label in ``mapping`` (from ``label_counts``); null for an unknown one."""
    m = mapping.select(F.col(label).alias("_label"), F.col("label_index").alias("_index"))
    return df.join(m, F.col(label) == F.col("_label"), "left").drop("_label").withColumnRenamed("_index", out)


def apply_label_unindex(df: DataFrame, mapping: DataFrame, label: str, index: str = "label_index",
                        out: str = "label_back") -> DataFrame:
    """``out``: the label of each row's index; null for an unknown one."""
    m = mapping.select(F.col("label_index").alias("_index"), F.col(label).alias("_label"))
    return df.join(m, F.col(index) == F.col("_index"), "left").drop("_index").withColumnRenamed("_label", out)


def unpivot_features(df: DataFrame, ids: Sequence[str], features: Sequence[str],
                     name: str = "feature", value: str = "value") -> DataFrame:
    """Wide → long: one row per (row, feature), values as strings."""
    cast = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in features])
    return cast.unpivot(list(ids), list(features), name, value)


def contingency(long_df: DataFrame, label: str, by: Sequence[str] = ("feature", "value"),
                out: str = "n") -> DataFrame:
    """Count of (label, feature, value); rows with a null label are not counted."""
    return long_df.groupBy(label, *by).agg(F.count(F.col(label)).alias(out))


def value_totals(table: DataFrame, by: Sequence[str] = ("feature", "value"),
                 n: str = "n", out: str = "n_value") -> DataFrame:
    """Roll a contingency table up to (feature, value) totals."""
    return table.groupBy(*by).agg(F.sum(n).alias(out))


def joint_with_totals(table: DataFrame, by: Sequence[str] = ("feature", "value"),
                      n: str = "n", out: str = "n_value") -> DataFrame:
    """Contingency rows with their (feature, value) total attached.

    Written as a join on the two keys; both inputs are already aggregated, and
    Catalyst reuses the shuffle of the left side for the rollup.
    """
    return table.join(value_totals(table, by, n, out), on=list(by), how="inner")

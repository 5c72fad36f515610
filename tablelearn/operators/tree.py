"""ID3 decision tree, grown breadth-first with a DataFrame of nodes.

All nodes of a level are scored together: rows carry a ``node_id``, the
categorical features are unpivoted, and one ``groupBy(node, feature, value,
label)`` gives every entropy and gain of the level.  Entropies need no window:
with counts c of a group of n rows, H = log2(n) - sum(c·log2(c)) / n, which
is two partial aggregations.  Best splits come from ``max_by``, children are
numbered by range partitions, and rows move to their child by a join.  The
driver sees the number of nodes of a level only, so neither the tree nor a
feature's values have a limit.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .encode import literal_map, unpivot_features
from .relational import row_numbers, written


def _xlogx(c: Column) -> Column:
    return F.when(c > 0, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def _entropy(n: Column, s: Column) -> Column:
    """Entropy in bits of n rows whose label counts c have sum(c·log2(c)) = s."""
    return F.when(n > 0, (_xlogx(n) - s) / n).otherwise(F.lit(0.0))


def label_entropy(df: DataFrame, label: str, group: Sequence[str] = ()) -> DataFrame:
    """Row count and label entropy (bits), overall or per group."""
    counts = df.where(F.col(label).isNotNull()).groupBy(*group, label).agg(F.count(F.lit(1)).alias("_c"))
    sums = counts.groupBy(*group).agg(F.sum("_c").alias("n"), F.sum(_xlogx(F.col("_c"))).alias("_s"),
                                      F.count(F.lit(1)).alias("n_labels"))
    return sums.select(*group, "n", _entropy(F.col("n"), F.col("_s")).alias("entropy"), "n_labels")


def _cells(df: DataFrame, label: str, features: Sequence[str], group: Sequence[str]) -> DataFrame:
    long = unpivot_features(df.where(F.col(label).isNotNull()), [*group, label], features)
    return long.groupBy(*group, "feature", "value", label).agg(F.count(F.lit(1)).alias("_c"))


def _cond_entropy(cells: DataFrame, group: Sequence[str]) -> DataFrame:
    by_value = cells.groupBy(*group, "feature", "value").agg(
        F.sum("_c").alias("_nv"), F.sum(_xlogx(F.col("_c"))).alias("_sv"))
    sums = by_value.groupBy(*group, "feature").agg(
        F.sum("_nv").alias("_n"), F.sum(_xlogx(F.col("_nv")) - F.col("_sv")).alias("_h"),
        F.count("value").alias("n_values"))
    return sums.select(*group, "feature", (F.col("_h") / F.col("_n")).alias("cond_entropy"), "n_values")


def conditional_entropy(df: DataFrame, label: str, features: Sequence[str],
                        group: Sequence[str] = ()) -> DataFrame:
    """H(label | feature) per (group, feature): Σ_v p(v) · H(label | v); null is a value of its own."""
    return _cond_entropy(_cells(df, label, features, group), group)


def _gains(cells: DataFrame, label: str, features: Sequence[str], group: Sequence[str]) -> DataFrame:
    per_label = cells.groupBy(*group, "feature", label).agg(F.sum("_c").alias("_nc"))
    h = per_label.groupBy(*group, "feature").agg(F.sum("_nc").alias("n"), F.sum(_xlogx(F.col("_nc"))).alias("_s"),
                                                 F.count(F.lit(1)).alias("n_labels"))
    g = _cond_entropy(cells, group).join(h, on=[*group, "feature"], how="inner")
    pos = F.element_at(literal_map([(f, i) for i, f in enumerate(features)]), F.col("feature"))
    entropy = _entropy(F.col("n"), F.col("_s"))
    return (g.withColumn("entropy", entropy).withColumn("gain", F.col("entropy") - F.col("cond_entropy"))
            .withColumn("_pos", pos).drop("_s"))


def info_gain(df: DataFrame, label: str, features: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Gain of each feature (per group); ``rank`` 1 is the best, ties by list order.

    Both entropies come from the same contingency cells: every row appears
    once under each feature, so the label counts of a feature's cells are the
    label counts of the group.  The two are joined on (group, feature).
    """
    g = _gains(_cells(df, label, features, group), label, features, group)
    # one row per feature and group
    w = Window.partitionBy(*group).orderBy(F.col("gain").desc(), F.col("_pos"))
    return g.withColumn("rank", F.row_number().over(w)).drop("_pos")


def route_children(df: DataFrame, feature: str, node: str = "node_id",
                   edge: str = "edge_value") -> DataFrame:
    """Send rows to one child per distinct value of ``feature`` (ids 1..V by value); nulls stay out."""
    v = F.col(feature).cast("string")
    values = df.select(v.alias("_v")).where("_v is not null").distinct()
    ids = row_numbers(values, [], ["_v"], out="_id").select("_v", F.col("_id").cast("int").alias("_id"))
    return (df.join(ids, v == F.col("_v"), "inner").withColumn(node, F.col("_id"))
            .withColumn(edge, F.col("_v")).drop("_v", "_id"))


@dataclass
class ID3Model:
    """``nodes``: node_id, parent_id, depth, split_feature, edge_value, label, n, gain; written once."""

    label: str
    features: list
    nodes: DataFrame
    depth: int

    def to_df(self, spark: SparkSession | None = None) -> DataFrame:
        return self.nodes.withColumn("label", F.col("label").cast("string"))

    def route(self, df: DataFrame, out: str = "node_id") -> DataFrame:
        """Attach the deepest node a row reaches; an unseen or null value stops at the parent.

        Two joins per level (split feature by node, child by node and value);
        Spark broadcasts or shuffles the node tables by their size.
        """
        rest = [c for c in df.columns if c != out]
        values = F.array(*[F.col(f).cast("string") for f in self.features])
        cur = df.select(F.struct(*rest).alias("_row"), values.alias("_fv"), F.lit(0).alias("_at"))
        pos = F.element_at(literal_map([(f, i + 1) for i, f in enumerate(self.features)]), F.col("split_feature"))
        # the root's split is known here; a join on its constant number would not be an equi-join
        root = self.nodes.where("depth = 0").select("split_feature").first()["split_feature"] if self.depth else None
        for d in range(self.depth):
            if d == 0:
                kids = self.nodes.where("depth = 1").select(F.col("edge_value").alias("_v"), F.col("node_id").alias("_child"))
                cur = cur.withColumn("_value", F.element_at("_fv", self.features.index(root) + 1)).join(
                    kids, F.col("_value") == F.col("_v"), "left").select("_row", "_fv", F.coalesce("_child", "_at").alias("_at"))
                continue
            splits = self.nodes.where((F.col("depth") == d) & F.col("split_feature").isNotNull()).select(
                F.col("node_id").alias("_sn"), pos.alias("_fpos"))
            kids = self.nodes.where(F.col("depth") == d + 1).select(
                F.col("parent_id").alias("_p"), F.col("edge_value").alias("_v"), F.col("node_id").alias("_child"))
            cur = cur.join(splits, F.col("_at") == F.col("_sn"), "left").select(
                "_row", "_fv", "_at", F.element_at("_fv", F.col("_fpos")).alias("_value"))
            cur = cur.join(kids, (F.col("_at") == F.col("_p")) & (F.col("_value") == F.col("_v")), "left").select(
                "_row", "_fv", F.coalesce("_child", "_at").alias("_at"))
        return cur.select(*[F.col("_row")[c].alias(c) for c in rest], F.col("_at").alias(out))


def id3_fit(df: DataFrame, features: Sequence[str], label: str, threshold: float = 1e-2,
            max_depth: int | None = None) -> ID3Model:
    """Grow an ID3 tree on categorical features (values compared as strings).

    A node is a leaf when it is pure, has no unused feature, reached
    ``max_depth``, or its best gain is below ``threshold``.  Gain ties go to the
    feature listed first; every node stores its majority label (ties → the
    smallest label), which is the prediction for rows stopping there.  A row whose value of
    the split feature is null stays with the node.
    """
    features = list(features)
    deepest = len(features) if max_depth is None else min(max_depth, len(features))
    kind = df.schema[label].dataType
    rows = written(df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("_label"), F.array(*[F.col(c).cast("string") for c in features]).alias("_fv"),
        F.lit(0).alias("_node")), "id3-rows")
    # the level's nodes, and the features its paths have used
    level = df.sparkSession.range(1).select(
        F.lit(0).alias("node_id"), F.lit(None).cast("int").alias("parent_id"), F.lit(None).cast("string").alias("edge_value"),
        F.array().cast("array<string>").alias("used"))
    done, depth, next_id = [], 0, 1
    while True:
        counts = rows.groupBy("_node", "_label").agg(F.count(F.lit(1)).alias("_c"))
        labels = counts.groupBy("_node").agg(
            F.sum("_c").alias("n"), F.count(F.lit(1)).alias("_kinds"),
            F.min_by("_label", F.struct((-F.col("_c")).alias("c"), F.col("_label").alias("l"))).alias("label"))
        named = level.join(labels, F.col("node_id") == F.col("_node"), "left").drop("_node")
        if depth < deepest:
            long = rows.select("_node", "_label", F.posexplode("_fv").alias("_pos", "value"))
            feature = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("_pos") + 1)
            cells = long.groupBy("_node", "_pos", "value", "_label").agg(F.count(F.lit(1)).alias("_c"))
            gains = _gains(cells.select("_node", feature.alias("feature"), "value", "_label", "_c"), "_label", features, ["_node"])
            open_ = gains.where("n_labels > 1").join(level.select(F.col("node_id").alias("_id"), "used"), F.col("_node") == F.col("_id"))
            best = open_.where(~F.array_contains("used", F.col("feature"))).groupBy("_node").agg(
                F.max_by(F.struct("feature", "gain"), F.struct(F.col("gain"), (-F.col("_pos")).alias("p"))).alias("_best"))
            named = named.join(best, F.col("node_id") == F.col("_node"), "left").drop("_node")
        else:
            named = named.withColumn("_best", F.lit(None).cast("struct<feature:string,gain:double>"))
        split = F.when(F.col("_best.gain") >= threshold, F.col("_best.feature"))
        named = written(named.select(
            "node_id", "parent_id", F.lit(depth).alias("depth"), split.alias("split_feature"), "edge_value",
            F.col("label").cast(kind).alias("label"), F.coalesce("n", F.lit(0)).cast("long").alias("n"),
            F.col("_best.gain").alias("gain"), "used"), "id3-nodes")
        done.append(named.drop("used"))
        splits = named.where("split_feature is not null").select(
            F.col("node_id").alias("_sn"), "split_feature", F.array_append("used", F.col("split_feature")).alias("used"),
            F.element_at(literal_map([(f, i + 1) for i, f in enumerate(features)]), F.col("split_feature")).alias("_fpos"))
        moving = rows.join(splits, F.col("_node") == F.col("_sn")).select(
            "_label", "_fv", "_node", F.element_at("_fv", F.col("_fpos")).alias("_value")).where("_value is not null")
        kids = moving.select(F.col("_node").alias("parent_id"), F.col("_value").alias("edge_value")).distinct()
        numbered = row_numbers(kids, [], ["parent_id", "edge_value"], out="_rn")
        kids = written(numbered.join(splits, F.col("parent_id") == F.col("_sn")).select(
            (F.col("_rn") + (next_id - 1)).cast("int").alias("node_id"), "parent_id", "edge_value", "used"), "id3-level")
        n = kids.count()
        if not n:
            break
        child = kids.select(F.col("parent_id").alias("_p"), F.col("edge_value").alias("_v"), F.col("node_id").alias("_child"))
        rows = written(moving.join(child, (F.col("_node") == F.col("_p")) & (F.col("_value") == F.col("_v"))).select(
            "_label", "_fv", F.col("_child").alias("_node")), "id3-rows")
        level, depth, next_id = kids, depth + 1, next_id + n
    return ID3Model(label, features, reduce(DataFrame.unionByName, done), depth)


def id3_predict(df: DataFrame, model: ID3Model, prediction: str = "prediction",
                node: str | None = "node_id") -> DataFrame:
    """Route rows to the deepest reachable node; predict that node's majority label."""
    at = node or "_id3_node"
    routed = model.route(df, at)
    labels = model.nodes.select(F.col("node_id").alias("_ln"), F.col("label").alias("_lb"))
    rest = [c for c in routed.columns if c != prediction and (node or c != at)]
    return routed.join(labels, F.col(at) == F.col("_ln"), "left").select(*rest, F.col("_lb").alias(prediction))

"""Small relational building blocks shared by the learners."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_partitions, shuffles_dropped


def misclassified(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """Rows whose prediction differs from the label (null labels excluded)."""
    return df.where(F.col(label).isNotNull() & (F.col(prediction) != F.col(label)))


def first_k(df: DataFrame, key: str | Sequence[str], k: int) -> DataFrame:
    """The k rows with the smallest key (TakeOrderedAndProject: a partial top-k per task)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank: str = "rank", ties: bool = False) -> DataFrame:
    """Rows ranked 1..k inside each group (``ties=True``: ``rank()``, keeping
    every row tied with the k-th).

    ``row_number() <= k`` / ``rank() <= k`` are planned with a partial
    WindowGroupLimit before the shuffle, so a hot group sends at most k rows
    (plus ties) per map task.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    fn = F.rank() if ties else F.row_number()
    return df.withColumn(rank, fn.over(w)).where(F.col(rank) <= k)


def majority(df: DataFrame, group: Sequence[str], label: str, out: str = "majority") -> DataFrame:
    """Most frequent label per group; ties go to the smallest label."""
    counts = df.where(F.col(label).isNotNull()).groupBy(*group, label).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*group).agg(
        F.min_by(F.col(label), F.struct((-F.col("_n")).alias("n"), F.col(label).alias("l"))).alias(out),
        F.max("_n").alias("n_majority"),
        F.sum("_n").alias("n"),
    )


def arg_best(df: DataFrame, group: Sequence[str], value: str | Column, order: Sequence[Column],
             out: str, largest: bool = False) -> DataFrame:
    """argmin/argmax of ``value`` per group under a total order (ties broken by ``order``)."""
    v = F.col(value) if isinstance(value, str) else value
    agg = F.max_by if largest else F.min_by
    return df.groupBy(*group).agg(agg(v, F.struct(*order)).alias(out))


def written(df: DataFrame, name: str) -> DataFrame:
    """Written once below the shared scratch folder, and read back (cuts lineage); the shuffle files of the write go with it."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unwritten(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing will read any more."""
    for path in {file.rsplit("/", 1)[0] for df in tables for file in df.inputFiles()}:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def row_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join of two sides that both grow with the input, through the shuffle.

    The planner would broadcast a side by the size of its files, and a file of few distinct values is
    small however many rows it holds: the driver would build a table of all of them.
    """
    return left.join(right.hint("merge"), on, how)


def row_numbers(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "rn",
                partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by group order by order)`` without a per-group window.

    A window would sort a whole group in one task; here rows are range-
    partitioned on (group, order), numbered inside each partition with
    ``monotonically_increasing_id``, and each partition's offset inside a group
    comes from per-(group, partition) counts (at most one row per group and
    partition).  A group holding a third of all rows is spread over many
    partitions.  ``order`` must be unique within a group for a deterministic
    numbering.  The numbered rows are written once as Parquet below
    ``spark.checkpoint.dir`` because two branches read the ids.
    """
    group, order = list(group), list(order)
    n_parts = partitions or shuffle_partitions(df.sparkSession)
    ordered = (df.repartitionByRange(n_parts, *group, *order)
               .sortWithinPartitions(*group, *order)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = written(ordered, "row-numbers")
    spans = ordered.groupBy(*group, "_pid").agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_off", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    keys = group + ["_pid"]
    right = spans.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)], "_m0", "_off")
    cond = [ordered[k].eqNullSafe(right[f"_r{i}"]) for i, k in enumerate(keys)]  # null groups too
    out_df = ordered.join(right, cond, "inner")
    rn = F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1
    return out_df.withColumn(out, rn).drop("_pid", "_mid", "_m0", "_off",
                                           *[f"_r{i}" for i in range(len(keys))])

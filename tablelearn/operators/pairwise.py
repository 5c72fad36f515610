"""Distances between row pairs, exact k nearest neighbours, kNN voting.

Pairs always come from an equi-join, never from a cross join:

* ``keyed_distance`` compares rows that share a key (e.g. a row and the
  centroid of its class).
* ``nearest`` finds the exact k nearest train rows of every query row through a
  directory of balls over distinct vectors (``directory``), for eight measures.
  Rankings are ``row_number() <= k`` under (distance, smallest id), planned with a
  partial group limit before the shuffle, so ties never add candidates.
* ``nearest_sets`` does so for sets under the Jaccard distance, through inverted lists.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import distance as D
from ..functions.vector import WIDE, mean_array
from .directory import BLOCK, FAN, SIMILARITIES, Space, build, search, strings_within_one
from .relational import row_join, top_k_per_group, unwritten, written

SLICES = 4  # of the queries of ``nearest_sets`` at most
SLICE_ROWS = 250_000  # distinct queries of a slice at least
BROADCAST_ROWS = 10_000  # a keyed side is broadcast up to this many rows (counted first)


def group_means(df: DataFrame, group: str | Sequence[str], vec: str, dim: int,
                out: str = "mean_vec") -> DataFrame:
    """Element-wise mean vector per group, in one partial/final aggregate.

    ``dim`` is the declared length; a group with a vector of another length has a null mean, and so has one of more than
    ``WIDE`` entries with a null entry in a vector (up to ``WIDE``, null entries are left out of their mean).
    """
    keys = [group] if isinstance(group, str) else list(group)
    ends = [F.count(F.lit(1)).alias("n"), F.min(F.size(vec)).alias("_least"), F.max(F.size(vec)).alias("_most")]
    right = (F.col("_least") == dim) & (F.col("_most") == dim)
    if dim > WIDE:
        broken = F.exists(vec, lambda x: x.isNull())
        whole = F.when((F.size(vec) == dim) & ~broken, F.col(vec).cast("array<double>"))
        agg = df.groupBy(*keys).agg(*ends, F.count_if(broken).alias("_broken"), mean_array(whole, dim).alias("_mean"))
        return agg.select(*keys, "n", F.when(right & (F.col("_broken") == 0), F.col("_mean")).alias(out))
    avgs = [F.expr(f"avg(CAST(get(`{vec}`, {i}) AS DOUBLE)) AS _m{i}") for i in range(dim)]
    mean = F.expr("array(" + ", ".join(f"_m{i}" for i in range(dim)) + ")")
    return df.groupBy(*keys).agg(*ends, *avgs).select(*keys, "n", F.when(right, mean).alias(out))


def keyed_distance(left: DataFrame, right: DataFrame, on: Sequence[str], left_vec: str,
                   right_vec: str, metric: str, dim: int | None = None, out: str = "distance",
                   **kw) -> DataFrame:
    """Distance between each left row and the right row(s) sharing its key.

    The right side is counted (up to the bound): a small one is broadcast, so a key
    that a third of the left rows share is not shuffled; a large one is joined
    through the shuffle, where adaptive execution splits a hot key.
    """
    r = right.withColumnRenamed(right_vec, "_rv")
    if right.select(*on).limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        r = F.broadcast(r)
    j = left.join(r, on=list(on), how="inner")
    return j.withColumn(out, D.metric(metric, left_vec, "_rv", dim=dim, **kw)).drop("_rv")


def nearest(queries: DataFrame, train: DataFrame, qid: str, tid: str, qvec: str, tvec: str,
            dim: int | None, k: int, exclude_self: bool = False, extra: Sequence[str] = (), metric: str = "euclidean",
            p: float | None = None, scales: Sequence[float] | None = None, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Exact k nearest train rows for every query row.

    Output: ``qid, tid, rank, distance`` (``similarity`` for cosine and tanimoto, the largest first; + ``extra`` train
    columns; the train id is renamed ``<tid>_neighbor`` when both ids share a name); ties go to the
    smaller ``tid``.  ``exclude_self`` drops pairs with ``qid == tid``.  Fewer than k rows are returned
    when train is smaller.  ``metric`` is one of ``directory.METRICS``; ``p`` is the order of minkowski, ``scales`` the
    deviations of std_euclidean (default: those of the train vectors).  ``dim`` is the declared length: a vector of
    another length ends the job with an error; rows with a null vector, or a null in it, take no part, nor do zero vectors under
    cosine and tanimoto.  Under hamming the columns are strings, and only strings of equal length are neighbours.

    The search runs over *distinct* vectors, so a group of identical rows (however
    large) is one point: copies are collapsed by a partial aggregation, searched
    once, and expanded back through the kk smallest ids of each vector (kk = k, or
    k + 1 when the query itself may be among them).  Keeping kk vectors per query
    under (distance, smallest id) is enough: each vector ahead of another one
    contributes at least one row ahead of all rows of the other.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    kk = k + 1 if exclude_self else k

    def checked(c: str) -> Column:
        if metric == "hamming":
            return F.col(c).cast("string")
        v = F.col(c).cast("array<double>")
        return F.when(v.isNull() | (F.size(v) == dim), v).otherwise(
            F.raise_error(F.lit(f"nearest: a vector whose length is not {dim}")).cast("array<double>"))

    def whole(c: str) -> Column:
        known = F.col(c).isNotNull()
        return known if metric == "hamming" else known & ~F.exists(c, lambda x: x.isNull())

    t = train.select(F.col(tid).alias("_tid"), checked(tvec).alias("_tv"), *extra).where(whole("_tv"))
    q = queries.select(F.col(qid).alias("_qid"), checked(qvec).alias("_qv")).where(whole("_qv"))
    # distinct vectors, each named by its smallest row id, written once: one scan per input
    tvecs = written(t.groupBy("_tv").agg(F.min("_tid").alias("_tr")), "knn-train")
    qvecs = written(q.groupBy("_qv").agg(F.min("_qid").alias("_qr")), "knn-query")
    if metric == "std_euclidean" and scales is None:
        scales = D.feature_scales(t, array_col="_tv", dim=dim)
    space = Space(metric, dim, p, tuple(scales) if scales is not None else None)
    early, left = None, qvecs
    if metric == "hamming":
        early = written(strings_within_one(qvecs, tvecs, kk), "knn-early")
        left = written(row_join(qvecs, early.select("_qr"), "_qr", "left_anti"), "knn-left")
    if early is not None and left.isEmpty():
        vec_nn = early
    else:
        directory = build(space.with_place(tvecs, "t"), space, block, fan)
        vec_nn, _ = search(space.with_place(left, "q"), directory, kk)
        vec_nn = vec_nn if early is None else vec_nn.unionByName(early)
    return _expanded(vec_nn, t, tvecs, "_tv", q, qvecs, "_qv", k, kk, exclude_self, qid, tid, extra,
                     "similarity" if metric in SIMILARITIES else "distance")


def _expanded(vec_nn: DataFrame, t: DataFrame, tvecs: DataFrame, tkey: str, q: DataFrame, qvecs: DataFrame, qkey: str, k: int, kk: int,
              exclude_self: bool, qid: str, tid: str, extra: Sequence[str], value: str) -> DataFrame:
    """Neighbour vectors → their kk smallest ids; query vectors → query rows; the k best rows of each.

    The neighbours of a query vector are cut before its rows are joined: to k, or with ``exclude_self`` to k more than one id
    has rows there, which are all that a row can lose.  What this joins is written step by step, so that the shuffles of one step are on disk at once.
    """
    t_rows = row_join(t, tvecs.select(tkey, "_tr"), tkey).drop(tkey)
    ids = written(top_k_per_group(t_rows, ["_tr"], [F.col("_tid")], kk, rank="_ri").drop("_ri"), "knn-ids")
    q_rows = written(row_join(q, qvecs.select(qkey, "_qr"), qkey).select("_qid", "_qr"), "knn-rows")
    best = row_join(vec_nn, ids, "_tr").drop("_tr").repartition("_qr")  # one move for all three windows
    by_vector = Window.partitionBy("_qr")
    if exclude_self:
        best = best.withColumn("_same", F.count("*").over(Window.partitionBy("_qr", "_tid"))).withColumn("_lost", F.max("_same").over(by_vector))
    best = best.withColumn("_rb", F.row_number().over(by_vector.orderBy("_score", "_tid")))
    best = best.where(F.col("_rb") <= (F.lit(k) + F.col("_lost") if exclude_self else F.lit(k))).drop("_rb", "_same", "_lost")
    rows = row_join(q_rows, written(best, "knn-best"), "_qr")
    if exclude_self:
        rows = rows.where(F.col("_qid") != F.col("_tid"))
    final = top_k_per_group(rows.select("_qid", "_tid", "_score", *extra), ["_qid"], [F.col("_score"), F.col("_tid")], k)
    shown = F.col("_score") if value == "distance" else -F.col("_score")
    out_tid = tid if tid != qid else f"{tid}_neighbor"
    return final.select(F.col("_qid").alias(qid), F.col("_tid").alias(out_tid), "rank", shown.alias(value), *extra)


def nearest_sets(queries: DataFrame, train: DataFrame, qid: str, tid: str, qset: str, tset: str, k: int,
                 exclude_self: bool = False, extra: Sequence[str] = ()) -> DataFrame:
    """Exact k nearest train rows under the Jaccard distance of two array columns' distinct elements.

    Output and ties as for ``nearest``; null sets take no part, two empty sets have distance 0, and sets without a common element
    distance 1 (the smallest ids fill what is missing).  Distinct sets are searched: an inverted list per element, elements
    in order of rising frequency.  A query meets the list of its rarest element first, whose k-th similarity s bounds
    the rest; a set with that similarity shares at least s·|A| elements, so one of the first |A| - ceil(s·|A|) + 1 is common, and its
    size lies between s·|A| and |A|/s.  A pair counts at its first common element only, so no pair comes twice, and
    pairs behind the k-th of the first list are left out before they are moved.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    kk, spark = k + 1 if exclude_self else k, train.sparkSession

    def elements(c: str) -> Column:
        marked = F.transform(F.array_distinct(F.col(c).cast("array<string>")), lambda x: F.coalesce(F.concat(F.lit("="), x), F.lit("?")))
        return F.when(F.size(c) == 0, F.array(F.lit(""))).otherwise(F.array_sort(marked))  # the empty set has one element of its own

    t = train.select(F.col(tid).alias("_tid"), F.when(F.col(tset).isNotNull(), elements(tset)).alias("_tv"), *extra).where("_tv IS NOT NULL")
    q = queries.select(F.col(qid).alias("_qid"), F.when(F.col(qset).isNotNull(), elements(qset)).alias("_qv")).where("_qv IS NOT NULL")
    tvecs = written(t.groupBy("_tv").agg(F.min("_tid").alias("_tr")), "set-train")
    qvecs = written(q.groupBy("_qv").agg(F.min("_qid").alias("_qr")), "set-query")
    often = tvecs.select(F.explode("_tv").alias("_e")).groupBy("_e").agg(F.count("*").alias("_f")).orderBy("_f", "_e")
    often = written(often.select("_e", F.monotonically_increasing_id().alias("_i")), "set-elements")

    def numbered(vecs: DataFrame, vec: str, row: str, out: str) -> DataFrame:
        """Each set as the numbers of its elements, rarest first; those of no train set are in its size only."""
        each = vecs.select(row, F.size(vec).alias("_n"), F.explode(vec).alias("_e"))
        return row_join(each, often, "_e").groupBy(row, "_n").agg(F.sort_array(F.collect_list("_i")).alias(out))

    asked = written(numbered(qvecs, "_qv", "_qr", "_es"), "set-asked")
    sets = written(numbered(tvecs, "_tv", "_tr", "_tv").drop("_n"), "set-numbers")
    lists = sets.select("_tr", "_tv", F.explode("_tv").alias("_e"))
    unwritten(spark, often)

    def met(side: DataFrame) -> DataFrame:
        """The kk best sets among the lists of ``_probe``, with sizes that can lead to a place before ``_last``."""
        pairs = row_join(side.select("_qr", "_n", "_es", "_last", F.explode("_probe").alias("_e")), lists, "_e")
        size = F.size("_tv")
        pairs = pairs.where(F.col("_last").isNull() | ((size >= F.ceil(s * F.col("_n"))) & (size * s <= F.col("_n") + 1)))
        pairs = pairs.withColumn("_common", F.array_intersect("_es", "_tv")).where(F.element_at("_common", 1) == F.col("_e"))
        shared = F.size("_common")
        score = F.lit(1.0) - shared.cast("double") / (F.col("_n") + size - shared).cast("double")
        pairs = pairs.withColumn("_score", score).where(F.col("_last").isNull() | (F.struct("_score", "_tr") <= F.col("_last")))
        return top_k_per_group(pairs.select("_qr", "_tr", "_score"), ["_qr"], [F.col("_score"), F.col("_tr")], kk, rank="_rk").drop("_rk")

    last = F.struct(F.col("_score"), F.col("_tr"))
    unknown = F.lit(None).cast(T.StructType([T.StructField("_score", T.DoubleType()), T.StructField("_tr", tvecs.schema["_tr"].dataType)]))
    s = F.coalesce(F.lit(1.0) - F.col("_last._score"), F.lit(0.0)) * F.lit(1 - 1e-9)
    slices, parts = max(1, min(SLICES, asked.count() // SLICE_ROWS)), []
    for i in range(slices):  # one after the other: the shuffles of one are on disk at once
        mine = asked.where(F.pmod(F.xxhash64("_qr"), F.lit(slices)) == i) if slices > 1 else asked
        first = met(mine.withColumn("_probe", F.slice("_es", 1, 1)).withColumn("_last", unknown))
        bound = first.groupBy("_qr").agg(F.max(last).alias("_last"), F.count("*").alias("_got")).where(F.col("_got") >= kk).drop("_got")
        limits = written(row_join(mine, bound, "_qr", "left"), "set-limits")
        prefix = F.col("_n") - F.ceil(s * F.col("_n")) + 1  # numbered elements may be fewer: the others match nothing and come first
        parts.append(written(met(limits.withColumn("_probe", F.slice("_es", F.lit(1), F.greatest(F.lit(1), prefix).cast("int")))), "set-found"))
        unwritten(spark, limits)
    found = reduce(DataFrame.unionByName, parts)
    unwritten(spark, sets, asked)
    # queries with too few: of the 2·kk sets of smallest ids at least kk share nothing with them
    fill = [(r["_tr"], r["_tv"]) for r in tvecs.orderBy("_tr").limit(2 * kk).collect()]
    enough = found.groupBy("_qr").agg(F.count("*").alias("_got")).where(F.col("_got") >= kk)
    short = qvecs.join(enough, "_qr", "left_anti")
    if fill:
        rows = F.array(*[F.struct(F.lit(r).cast(tvecs.schema["_tr"].dataType).alias("_tr"), F.array(*[F.lit(e) for e in v]).alias("_tv")) for r, v in fill])
        more = short.select("_qr", "_qv", F.explode(rows).alias("x"))
        apart = more.where(F.size(F.array_intersect("_qv", "x._tv")) == 0).select("_qr", F.col("x._tr").alias("_tr"), F.lit(1.0).alias("_score"))
        found = found.unionByName(apart)
    vec_nn = top_k_per_group(found, ["_qr"], [F.col("_score"), F.col("_tr")], kk, rank="_rk").drop("_rk")
    return _expanded(vec_nn, t, tvecs, "_tv", q, qvecs, "_qv", k, kk, exclude_self, qid, tid, extra, "distance")


def knn_vote(neighbors: DataFrame, qid: str, label: str, prediction: str = "prediction") -> DataFrame:
    """Majority label of each query's neighbours.

    Ties: more votes, then the nearer closest neighbour, then the smaller label.
    """
    votes = neighbors.groupBy(qid, label).agg(F.count(F.lit(1)).alias("votes"),
                                              F.min("distance").alias("nearest"))
    order = F.struct((-F.col("votes")).alias("v"), F.col("nearest").alias("d"), F.col(label).alias("l"))
    return votes.groupBy(qid).agg(F.min_by(F.col(label), order).alias(prediction),
                                  F.max("votes").alias("votes"))


def knn_predict(queries: DataFrame, train: DataFrame, qid: str, tid: str, qvec: str, tvec: str,
                label: str, dim: int, k: int, exclude_self: bool = False,
                prediction: str = "prediction") -> DataFrame:
    nb = nearest(queries, train, qid, tid, qvec, tvec, dim, k, exclude_self, extra=[label])
    return knn_vote(nb, qid, label, prediction)

"""Registered queries: preparation (§2.2) and relational steps (§2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import sign
from ..functions.vector import linear
from ..operators import encode, relational
from ..operators.cluster import kmeans_assign, kmeans_update
from ..sources.tables import read_table
from .inputs import (CUSTOMER_CATS_SQL, DOCS_LABELED_SQL, PART_POINTS_SQL, cte, customer_cats,
                     docs_labeled, part_points)
from .registry import dbl, query, rnd, r4

# fixed model constants used by the relational queries (not fitted)
SIGN_W, SIGN_B = (1.0, -0.5), -0.3
CENTERS3 = ((0.2, 0.2), (0.5, 0.8), (0.8, 0.4))


# ---------------------------------------------------------------- preparation
@query("prep_assemble", f"""
SELECT p_partkey, [x1, x2] AS features FROM ({PART_POINTS_SQL})""")
def prep_assemble(spark, d):
    return encode.assemble(part_points(spark, d), ["x1", "x2"]).select("p_partkey", "features")


@query("prep_vec2array", f"""
SELECT p_partkey, [x1, x2] AS features FROM ({PART_POINTS_SQL})""")
def prep_vec2array(spark, d):
    vec = encode.to_ml_vector(part_points(spark, d), ["x1", "x2"], "vec")
    return encode.vector_to_array(vec, "vec", "features").select("p_partkey", "features")


_LABEL_INDEX_SQL = """
SELECT c_mktsegment, count(*) AS n,
       CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS DOUBLE) AS label_index
FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment"""


@query("prep_label_index", _LABEL_INDEX_SQL)
def prep_label_index(spark, d):
    return encode.label_counts(read_table(spark, d, "customer"), "c_mktsegment")


@query("prep_label_unindex", f"""
{cte(m=_LABEL_INDEX_SQL)}
SELECT c.c_custkey, m.label_index, m.c_mktsegment AS segment_back
FROM customer c LEFT JOIN m ON c.c_mktsegment = m.c_mktsegment""")
def prep_label_unindex(spark, d):
    c = read_table(spark, d, "customer")
    mapping = encode.label_counts(c, "c_mktsegment")
    out = encode.apply_label_index(c.select("c_custkey", "c_mktsegment"), mapping, "c_mktsegment")
    out = encode.apply_label_unindex(out, mapping, "c_mktsegment", out="segment_back")
    return out.select("c_custkey", "label_index", "segment_back")


@query("prep_cast", """
SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS custkey_d,
       CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS priority_level,
       CAST(floor(o_totalprice) AS BIGINT) AS price_whole
FROM orders""")
def prep_cast(spark, d):
    o = read_table(spark, d, "orders")
    return o.select("o_orderkey", F.col("o_custkey").cast("double").alias("custkey_d"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_level"),
                    F.floor("o_totalprice").cast("bigint").alias("price_whole"))


@query("prep_select_drop", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
FROM lineitem""")
def prep_select_drop(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.drop("l_returnflag", "l_linestatus", "l_shipdate")


_UNPIVOT_SQL = f"""
SELECT c_custkey, c_mktsegment, 'nation' AS feature, nation AS value FROM ({CUSTOMER_CATS_SQL})
UNION ALL
SELECT c_custkey, c_mktsegment, 'balance' AS feature, balance AS value FROM ({CUSTOMER_CATS_SQL})"""


@query("prep_unpivot", _UNPIVOT_SQL)
def prep_unpivot(spark, d):
    return encode.unpivot_features(customer_cats(spark, d), ["c_custkey", "c_mktsegment"],
                                   ["nation", "balance"])


@query("prep_split_by_value", f"""
{cte(dl=DOCS_LABELED_SQL)},
kids AS (SELECT lang AS edge_value, CAST(row_number() OVER (ORDER BY lang) AS INTEGER) AS node_id
         FROM (SELECT DISTINCT lang FROM dl WHERE lang IS NOT NULL))
SELECT dl.doc_id, kids.node_id, kids.edge_value FROM dl JOIN kids ON dl.lang = kids.edge_value""")
def prep_split_by_value(spark, d):
    from ..operators.tree import route_children

    dl = docs_labeled(spark, d)
    return route_children(dl, "lang").select("doc_id", "node_id", "edge_value")


@query("prep_rename", "SELECT o_orderkey, o_totalprice AS amount FROM orders")
def prep_rename(spark, d):
    return read_table(spark, d, "orders").select("o_orderkey", "o_totalprice").withColumnRenamed(
        "o_totalprice", "amount")


# ------------------------------------------------------------------ relational
def _sign_sql(w=SIGN_W, b=SIGN_B):
    return f"CASE WHEN (x1 * {dbl(w[0])} + x2 * {dbl(w[1])}) + {dbl(b)} >= 0 THEN 1 ELSE -1 END"


def _signed(spark, d):
    pts = part_points(spark, d)
    return pts.withColumn("prediction", sign(linear([F.col("x1"), F.col("x2")], SIGN_W, SIGN_B)))


@query("rel_filter_misclassified", f"""
SELECT p_partkey, y_sep, prediction FROM (
  SELECT p_partkey, y_sep, {_sign_sql()} AS prediction FROM ({PART_POINTS_SQL}))
WHERE prediction <> y_sep""")
def rel_filter_misclassified(spark, d):
    return relational.misclassified(_signed(spark, d), "prediction", "y_sep").select(
        "p_partkey", "y_sep", "prediction")


@query("rel_filter_eq", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def rel_filter_eq(spark, d):
    return read_table(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", "c_name")


_CONTINGENCY_SQL = f"""
SELECT c_mktsegment, feature, value, count(c_mktsegment) AS n FROM ({_UNPIVOT_SQL})
GROUP BY c_mktsegment, feature, value"""


def _contingency(spark, d):
    long = encode.unpivot_features(customer_cats(spark, d), ["c_custkey", "c_mktsegment"],
                                   ["nation", "balance"])
    return encode.contingency(long, "c_mktsegment")


@query("agg_contingency", _CONTINGENCY_SQL)
def agg_contingency(spark, d):
    return _contingency(spark, d)


@query("agg_value_total", f"""
SELECT feature, value, CAST(sum(n) AS BIGINT) AS n_value FROM ({_CONTINGENCY_SQL}) GROUP BY feature, value""")
def agg_value_total(spark, d):
    return encode.value_totals(_contingency(spark, d))


@query("rel_join_using", f"""
{cte(t=_CONTINGENCY_SQL)},
v AS (SELECT feature, value, CAST(sum(n) AS BIGINT) AS n_value FROM t GROUP BY feature, value)
SELECT t.feature, t.value, t.c_mktsegment, t.n, v.n_value FROM t JOIN v USING (feature, value)""")
def rel_join_using(spark, d):
    return encode.joint_with_totals(_contingency(spark, d))


@query("agg_keyed_histogram", f"""
{cte(dl=DOCS_LABELED_SQL)}
SELECT quality, feature, value, count(*) AS n FROM (
  SELECT quality, 'lang' AS feature, lang AS value FROM dl
  UNION ALL SELECT quality, 'source', source FROM dl
  UNION ALL SELECT quality, 'len_bucket', len_bucket FROM dl)
WHERE quality IS NOT NULL GROUP BY quality, feature, value""")
def agg_keyed_histogram(spark, d):
    long = encode.unpivot_features(docs_labeled(spark, d), ["quality"], ["lang", "source", "len_bucket"])
    return encode.contingency(long, "quality")


@query("agg_majority", """
SELECT c_nationkey, c_mktsegment AS majority, n AS n_majority, CAST(total AS BIGINT) AS n FROM (
  SELECT c_nationkey, c_mktsegment, n, sum(n) OVER (PARTITION BY c_nationkey) AS total,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) AS r
  FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer
        WHERE c_mktsegment IS NOT NULL GROUP BY c_nationkey, c_mktsegment))
WHERE r = 1""")
def agg_majority(spark, d):
    return relational.majority(read_table(spark, d, "customer"), ["c_nationkey"], "c_mktsegment")


@query("agg_global_sum", f"""
{cte(dl=DOCS_LABELED_SQL)}
SELECT CAST(sum(n) AS BIGINT) AS n,
       {rnd("sum(CASE WHEN n > 0 THEN -(n / t) * log2(n / t) ELSE 0 END)")} AS entropy
FROM (SELECT quality, CAST(count(*) AS DOUBLE) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) AS t
      FROM dl WHERE quality IS NOT NULL GROUP BY quality)""")
def agg_global_sum(spark, d):
    from ..operators.tree import label_entropy

    return label_entropy(docs_labeled(spark, d), "quality").select(
        "n", r4("entropy", 4).alias("entropy"))


@query("agg_mean", f"""
SELECT {rnd("avg(l_quantity)")} AS mean_quantity, {rnd("avg(l_discount)")} AS mean_discount,
       count(*) AS n FROM lineitem""")
def agg_mean(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.agg(r4(F.avg("l_quantity"), 4).alias("mean_quantity"),
                  r4(F.avg("l_discount"), 4).alias("mean_discount"),
                  F.count(F.lit(1)).alias("n"))


def _vector_mean_sql():
    parts = ", ".join(rnd(f"avg(embedding[{i + 1}])") for i in range(64))
    return f"SELECT label, count(*) AS n, [{parts}] AS mean_vec FROM embeddings GROUP BY label"


@query("agg_vector_mean", _vector_mean_sql)
def agg_vector_mean(spark, d):
    from .inputs import embeddings
    from ..operators.pairwise import group_means

    m = group_means(embeddings(spark, d), "label", "v", 64)
    return m.select("label", "n", F.transform("mean_vec", lambda x: r4(x, 4)).alias("mean_vec"))


def _assign_sql(centers=CENTERS3):
    d2 = [f"((x1 - {dbl(c[0])}) * (x1 - {dbl(c[0])}) + (x2 - {dbl(c[1])}) * (x2 - {dbl(c[1])}))"
          for c in centers]
    m = "least(" + ", ".join(d2) + ")"
    case = "CASE " + " ".join(f"WHEN {x} = {m} THEN {i}" for i, x in enumerate(d2[:-1])) + \
           f" ELSE {len(d2) - 1} END"
    return f"SELECT p_partkey, x1, x2, {case} AS cluster, sqrt({m}) AS distance FROM ({PART_POINTS_SQL})"


@query("agg_sum_by_group", lambda: f"""
SELECT cluster, count(*) AS n, {rnd("sum(distance)")} AS cost, {rnd("sum(distance * distance)")} AS sq_cost,
       {rnd("avg(x1)")} AS m0, {rnd("avg(x2)")} AS m1
FROM ({_assign_sql()}) GROUP BY cluster""")
def agg_sum_by_group(spark, d):
    a = kmeans_assign(part_points(spark, d), ["x1", "x2"], CENTERS3)
    u = kmeans_update(a, ["x1", "x2"])
    return u.select("cluster", "n", *[r4(c, 4).alias(c) for c in ("cost", "sq_cost", "m0", "m1")])


@query("agg_distinct_count", """
SELECT c_nationkey, count(DISTINCT c_mktsegment) AS n_segments FROM customer GROUP BY c_nationkey""")
def agg_distinct_count(spark, d):
    return read_table(spark, d, "customer").groupBy("c_nationkey").agg(
        F.countDistinct("c_mktsegment").alias("n_segments"))


@query("agg_argmin", """
SELECT o_custkey, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS cheapest_order FROM orders
GROUP BY o_custkey""")
def agg_argmin(spark, d):
    o = read_table(spark, d, "orders")
    return relational.arg_best(o, ["o_custkey"], "o_orderkey",
                               [F.col("o_totalprice"), F.col("o_orderkey")], "cheapest_order")


@query("agg_argmax", """
SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS largest_order FROM orders
GROUP BY o_custkey""")
def agg_argmax(spark, d):
    o = read_table(spark, d, "orders")
    return relational.arg_best(o, ["o_custkey"], "o_orderkey",
                               [F.col("o_totalprice"), -F.col("o_orderkey")], "largest_order",
                               largest=True)


@query("win_row_number", f"""
SELECT p_partkey, y_sep, CAST(row_number() OVER (PARTITION BY y_sep ORDER BY p_partkey) AS INTEGER) AS rn
FROM (SELECT p_partkey, y_sep, {_sign_sql()} AS prediction FROM ({PART_POINTS_SQL}))
WHERE prediction <> y_sep""")
def win_row_number(spark, d):
    err = relational.misclassified(_signed(spark, d), "prediction", "y_sep").select("p_partkey", "y_sep")
    # row_number() over (partition by label order by key), without sorting a label in one task
    return relational.row_numbers(err, ["y_sep"], ["p_partkey"], out="rn").select(
        "p_partkey", "y_sep", F.col("rn").cast("int").alias("rn"))


@query("sort_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_rows(spark, d):
    return read_table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc(), "o_orderkey")


@query("limit_first_k", f"SELECT p_partkey, x1, x2 FROM ({PART_POINTS_SQL}) ORDER BY p_partkey LIMIT 5")
def limit_first_k(spark, d):
    return relational.first_k(part_points(spark, d), "p_partkey", 5).select("p_partkey", "x1", "x2")


@query("topk_per_query", """
SELECT o_custkey, o_orderkey, o_totalprice, CAST(rank AS INTEGER) AS rank FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
  FROM orders) WHERE rank <= 3""")
def topk_per_query(spark, d):
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return relational.top_k_per_group(o, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)

"""Registered queries: the nine distance / similarity measures (§2.4) and scalar math.

Vector measures compare every embedding with the centroid of its label (pairs
from an equi-join on the label; the centroid table is one row per label).
Hamming compares the ship date of every line item with the date of its order;
Jaccard compares the word sets of every conversation turn with the previous
turn of the same conversation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import distance as D
from ..functions.scalar import GaussianTerms, entropy_term, sigmoid, sign
from ..functions.vector import linear
from ..operators.pairwise import group_means, keyed_distance
from ..sources.tables import read_table
from .inputs import (DOCS_LABELED_SQL, EMB_DIM, EMBEDDINGS_SQL, PART_POINTS_SQL, cte, docs_labeled,
                     embeddings, part_points)
from .registry import dbl, query, rnd, r4

MINKOWSKI_P = 3.0


def _centroids_sql():
    avgs = ", ".join(f"avg(v[{i + 1}])" for i in range(EMB_DIM))
    return f"SELECT label, [{avgs}] AS c FROM e GROUP BY label"


def _terms(f):
    return [f(f"e.v[{i + 1}]", f"c.c[{i + 1}]") for i in range(EMB_DIM)]


def _sum(terms):
    return " + ".join(terms)


def _vector_metric_sql(name: str) -> str:
    sq = lambda a, b: f"({a} - {b}) * ({a} - {b})"
    dot_ab = _sum(_terms(lambda a, b: f"{a} * {b}"))
    dot_aa = _sum(_terms(lambda a, b: f"{a} * {a}"))
    dot_bb = _sum(_terms(lambda a, b: f"{b} * {b}"))
    extra = ""
    if name == "euclidean":
        expr = f"sqrt({_sum(_terms(sq))})"
    elif name == "manhattan":
        expr = _sum(_terms(lambda a, b: f"abs({a} - {b})"))
    elif name == "chebyshev":
        expr = "greatest(" + ", ".join(_terms(lambda a, b: f"abs({a} - {b})")) + ")"
    elif name == "minkowski":
        p = dbl(MINKOWSKI_P)
        expr = f"pow({_sum(_terms(lambda a, b: f'pow(abs({a} - {b}), {p})'))}, {dbl(1.0 / MINKOWSKI_P)})"
    elif name == "std_euclidean":
        extra = ", s AS MATERIALIZED (SELECT " + ", ".join(
            f"stddev_pop(v[{i + 1}]) AS s{i}" for i in range(EMB_DIM)) + " FROM e)"
        terms = [f"CASE WHEN s.s{i} > 0 THEN ((e.v[{i + 1}] - c.c[{i + 1}]) / s.s{i}) * "
                 f"((e.v[{i + 1}] - c.c[{i + 1}]) / s.s{i}) ELSE 0 END" for i in range(EMB_DIM)]
        expr = f"sqrt({_sum(terms)})"
    elif name == "tanimoto":
        expr = (f"CASE WHEN ({dot_aa}) + ({dot_bb}) - ({dot_ab}) <> 0 THEN ({dot_ab}) / "
                f"(({dot_aa}) + ({dot_bb}) - ({dot_ab})) END")
    elif name == "cosine":
        expr = (f"CASE WHEN sqrt({dot_aa}) * sqrt({dot_bb}) <> 0 THEN ({dot_ab}) / "
                f"(sqrt({dot_aa}) * sqrt({dot_bb})) END")
    else:
        raise ValueError(name)
    col = "similarity" if name in ("tanimoto", "cosine") else "distance"
    frm = "e JOIN c ON e.label = c.label" + (", s" if extra else "")
    return (f"{cte(e=EMBEDDINGS_SQL)}, c AS MATERIALIZED ({_centroids_sql()}){extra}\n"
            f"SELECT e.vec_id, e.label, {rnd(expr)} AS {col} FROM {frm}")


def _vector_metric(name: str):
    col = "similarity" if name in ("tanimoto", "cosine") else "distance"

    def run(spark, d):
        e = embeddings(spark, d)
        cent = group_means(e, "label", "v", EMB_DIM, out="c").select("label", "c")
        kw = {}
        if name == "minkowski":
            kw["p"] = MINKOWSKI_P
        if name == "std_euclidean":
            kw["scales"] = D.feature_scales(e, array_col="v", dim=EMB_DIM)
        out = keyed_distance(e, cent, ["label"], "v", "c", name, dim=EMB_DIM, out=col, **kw)
        return out.select("vec_id", "label", r4(col, 4).alias(col))

    return run


for _m in ("euclidean", "manhattan", "chebyshev", "minkowski", "std_euclidean"):
    query(f"dist_{_m}", (lambda m: lambda: _vector_metric_sql(m))(_m))(_vector_metric(_m))
for _m in ("tanimoto", "cosine"):
    query(f"sim_{_m}", (lambda m: lambda: _vector_metric_sql(m))(_m))(_vector_metric(_m))


@query("dist_hamming", """
SELECT l.l_orderkey, l.l_linenumber,
       CAST(hamming(strftime(l.l_shipdate, '%Y-%m-%d'), strftime(o.o_orderdate, '%Y-%m-%d')) AS INTEGER) AS hamming
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def dist_hamming(spark, d):
    li = read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship"))
    o = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("ordered"))
    return li.join(o, "l_orderkey").select("l_orderkey", "l_linenumber",
                                           D.hamming("ship", "ordered").alias("hamming"))


@query("dist_jaccard", f"""
WITH t AS MATERIALIZED (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations)
SELECT a.conv_id, a.turn,
       {rnd("CASE WHEN len(list_distinct(list_concat(a.w, b.w))) = 0 THEN 0.0 ELSE "
            "1.0 - CAST(len(list_intersect(a.w, b.w)) AS DOUBLE) / "
            "CAST(len(list_distinct(list_concat(a.w, b.w))) AS DOUBLE) END")} AS jaccard
FROM t a JOIN t b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1""")
def dist_jaccard(spark, d):
    c = read_table(spark, d, "conversations").select("conv_id", "turn", F.split("text", " ", -1).alias("w"))
    prev = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("w").alias("w_prev"))
    return c.join(prev, ["conv_id", "turn"]).select(
        "conv_id", "turn", r4(D.jaccard("w", "w_prev"), 4).alias("jaccard"))


# ------------------------------------------------------------------ scalar math
LOGIT_W = (2.0, -1.5)
SIGN_W, SIGN_B = (1.0, -0.5), -0.3
GAUSS_MEAN = (0.5, 0.5)
GAUSS_COV = ((0.08, 0.01), (0.01, 0.09))


@query("fn_sigmoid", f"""
SELECT doc_id, {rnd(f"{dbl(1.0)} / ({dbl(1.0)} + exp(-((x_len * {dbl(LOGIT_W[0])} + x_en * {dbl(LOGIT_W[1])}) + {dbl(0.0)})))")}
       AS probability FROM ({DOCS_LABELED_SQL})""")
def fn_sigmoid(spark, d):
    dl = docs_labeled(spark, d)
    z = linear([F.col("x_len"), F.col("x_en")], LOGIT_W, 0.0)
    return dl.select("doc_id", r4(sigmoid(z), 4).alias("probability"))


@query("fn_dot_sign", f"""
SELECT p_partkey, CASE WHEN (x1 * {dbl(SIGN_W[0])} + x2 * {dbl(SIGN_W[1])}) + {dbl(SIGN_B)} >= 0
       THEN 1 ELSE -1 END AS sign FROM ({PART_POINTS_SQL})""")
def fn_dot_sign(spark, d):
    pts = part_points(spark, d)
    return pts.select("p_partkey", sign(linear([F.col("x1"), F.col("x2")], SIGN_W, SIGN_B)).alias("sign"))


@query("fn_entropy_term", f"""
{cte(dl=DOCS_LABELED_SQL)}
SELECT lang, {rnd("p")} AS p, {rnd("CASE WHEN p > 0 THEN -p * log2(p) ELSE 0 END")} AS term FROM (
  SELECT lang, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS p FROM dl GROUP BY lang)""")
def fn_entropy_term(spark, d):
    from pyspark.sql import Window

    dl = docs_labeled(spark, d)
    counts = dl.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # one row per language: a global window over a model-sized table
    p = F.col("n") / F.sum("n").over(Window.partitionBy())
    return counts.select("lang", p.alias("p")).select(
        "lang", r4("p", 4).alias("p"), r4(entropy_term(F.col("p")), 4).alias("term"))


def _gauss_sql():
    (a, b), (_, c) = GAUSS_COV
    det = a * c - b * b
    c1, c2 = f"(x1 - {dbl(GAUSS_MEAN[0])})", f"(x2 - {dbl(GAUSS_MEAN[1])})"
    # the closed form for two features: inverse and determinant written out
    quad = f"({dbl(c)} * {c1} * {c1} - {dbl(2.0 * b)} * {c1} * {c2} + {dbl(a)} * {c2} * {c2}) / {dbl(det)}"
    density = f"exp({dbl(-0.5)} * ({quad})) / (2 * pi() * sqrt({dbl(det)}))"
    return f"SELECT p_partkey, {rnd(density)} AS density FROM ({PART_POINTS_SQL})"


@query("fn_gauss_pdf", _gauss_sql)
def fn_gauss_pdf(spark, d):
    g = GaussianTerms(GAUSS_MEAN, GAUSS_COV)
    pts = part_points(spark, d)
    return pts.select("p_partkey", r4(F.exp(g.log_pdf([F.col("x1"), F.col("x2")])), 4).alias("density"))

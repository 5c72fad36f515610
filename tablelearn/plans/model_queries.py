"""Registered queries: the learners (§2.5).

Iterative fits run to their own stop rule at the default limits.  The SQL oracle
unrolls one CTE per step up to the limit and picks the step at which the same
rule stops.  Model values are rounded to 4 places at output.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import bayes, cluster, linear, mixture, pairwise, tree
from ..sources.tables import read_table
from .inputs import (DOCS_LABELED_SQL, EMB_DIM, EMBEDDINGS_SQL, PART_POINTS_SQL, cte, docs_labeled,
                     embeddings, part_points)
from .registry import dbl, query, rnd, r4

XS = ["x1", "x2"]
DOC_XS = ["x_len", "x_en"]
NB_FEATURES = ["lang", "source", "len_bucket"]
ID3_FEATURES, ID3_THRESHOLD = ["lang", "len_bucket", "source"], 1e-2
PERCEPTRON_LR = 0.2  # single updates run until no row is wrong
BATCH_STEPS = 1000  # the labels are separated long before
POCKET_STEPS, POCKET_LR = 200, 0.1
LR_STEPS, LR_RATE, LR_TOL = 40, 0.05, 1e-3
LOGIT_W = (2.0, -1.5)
KM_K, KM_STEPS, KM_TOL = 3, 40, 1e-8
KM_CENTERS = ((0.2, 0.2), (0.5, 0.8), (0.8, 0.4))
KNN_K = 5
GMM_K, GMM_STEPS, GMM_TOL = 2, 40, 1e-5
GMM_FIXED = dict(weights=(0.4, 0.6), means=((0.3, 0.3), (0.7, 0.6)),
                 covs=(((0.05, 0.01), (0.01, 0.04)), ((0.06, -0.01), (-0.01, 0.05))))


def _round_model(df, col="weight"):
    return df.withColumn(col, r4(col, 4))


def _weights_sql(last: str, names=("x1", "x2")) -> str:
    rows = [f"SELECT '{n}' AS feature, {rnd(f'w{i + 1}')} AS weight FROM {last}" for i, n in enumerate(names)]
    rows.append(f"SELECT '__bias__' AS feature, {rnd('b')} AS weight FROM {last}")
    return "\nUNION ALL ".join(rows)


# ------------------------------------------------------------------ perceptron
def _pocket_ctes(steps: int, lr: float, label: str) -> dict:
    """CTEs w0..wN of the weights after each single update, e1.. of their errors, and ``best``."""
    parts = {"pts": PART_POINTS_SQL,
             "w0": f"SELECT {dbl(0.0)} AS w1, {dbl(0.0)} AS w2, {dbl(0.0)} AS b"}
    lrs, y = dbl(lr), f"CAST({label} AS DOUBLE)"
    for i in range(1, steps + 2):
        p = f"w{i - 1}"
        pred = f"CASE WHEN (x1 * {p}.w1 + x2 * {p}.w2) + {p}.b >= 0 THEN 1 ELSE -1 END"
        parts[f"e{i}"] = (f"SELECT {i - 1} AS it, count(*) AS errors, arg_min({y}, p_partkey) AS y, "
                          f"arg_min(x1, p_partkey) AS x1, arg_min(x2, p_partkey) AS x2 "
                          f"FROM pts, {p} WHERE {pred} <> {label}")
        if i <= steps:
            parts[f"w{i}"] = (
                f"SELECT CASE WHEN e.errors > 0 THEN p.w1 + ({lrs} * e.y) * e.x1 ELSE p.w1 END AS w1, "
                f"CASE WHEN e.errors > 0 THEN p.w2 + ({lrs} * e.y) * e.x2 ELSE p.w2 END AS w2, "
                f"CASE WHEN e.errors > 0 THEN p.b + {lrs} * e.y ELSE p.b END AS b FROM {p} p, e{i} e")
    evals = " UNION ALL ".join(
        f"SELECT e{i}.it, e{i}.errors, w{i - 1}.w1, w{i - 1}.w2, w{i - 1}.b FROM e{i}, w{i - 1}"
        for i in range(1, steps + 2))
    parts["best"] = (f"SELECT arg_min(w1, (errors, it)) AS w1, arg_min(w2, (errors, it)) AS w2, "
                     f"arg_min(b, (errors, it)) AS b FROM ({evals})")
    return parts


def _predict_sign_sql(parts, last):
    return (f"{cte(**parts)}\nSELECT p_partkey, CASE WHEN (x1 * {last}.w1 + x2 * {last}.w2) + {last}.b >= 0 "
            f"THEN 1 ELSE -1 END AS prediction FROM pts, {last}")


def _perceptron_model(spark, d, update="single"):
    limit = {} if update == "single" else {"max_iter": BATCH_STEPS}
    return linear.perceptron_fit(part_points(spark, d), XS, "y_sep", "p_partkey", lr=PERCEPTRON_LR, update=update, **limit)


def _perceptron_sql() -> str:
    """Weights after each single update, until no row is wrong, as a recursive table."""
    pred = "CASE WHEN (x1 * w1 + x2 * w2) + b >= 0 THEN 1 ELSE -1 END"
    return f"""WITH RECURSIVE pts AS MATERIALIZED ({PART_POINTS_SQL}),
w AS (SELECT 0 AS it, {dbl(0.0)} AS w1, {dbl(0.0)} AS w2, {dbl(0.0)} AS b
  UNION ALL
  SELECT it + 1, w1 + ({dbl(PERCEPTRON_LR)} * y) * e1, w2 + ({dbl(PERCEPTRON_LR)} * y) * e2, b + {dbl(PERCEPTRON_LR)} * y
  FROM (SELECT it, w1, w2, b, arg_min(CAST(y_sep AS DOUBLE), p_partkey) AS y, arg_min(x1, p_partkey) AS e1, arg_min(x2, p_partkey) AS e2
    FROM w, pts WHERE {pred} <> y_sep GROUP BY it, w1, w2, b)),
last AS MATERIALIZED (SELECT w1, w2, b FROM w ORDER BY it DESC LIMIT 1)
"""


@query("perceptron_fit", lambda: _perceptron_sql() + _weights_sql("last"))
def perceptron_fit_query(spark, d):
    return _round_model(_perceptron_model(spark, d).to_df(spark))


def _perceptron_batch_sql() -> str:
    """Weights after each batch update, until no row is wrong, as a recursive table."""
    pred, lr = "CASE WHEN (x1 * w1 + x2 * w2) + b >= 0 THEN 1 ELSE -1 END", dbl(PERCEPTRON_LR)
    return f"""WITH RECURSIVE pts AS MATERIALIZED ({PART_POINTS_SQL}),
w AS (SELECT 0 AS it, {dbl(0.0)} AS w1, {dbl(0.0)} AS w2, {dbl(0.0)} AS b
  UNION ALL
  SELECT it + 1, w1 + {lr} * s1, w2 + {lr} * s2, b + {lr} * sy
  FROM (SELECT it, w1, w2, b, sum(CAST(y_sep AS DOUBLE)) AS sy, sum(y_sep * x1) AS s1, sum(y_sep * x2) AS s2
    FROM w, pts WHERE it < {BATCH_STEPS} AND {pred} <> y_sep GROUP BY it, w1, w2, b)),
last AS MATERIALIZED (SELECT w1, w2, b FROM w ORDER BY it DESC LIMIT 1)
"""


@query("perceptron_fit_batch", lambda: _perceptron_batch_sql() + _weights_sql("last"))
def perceptron_fit_batch_query(spark, d):
    return _round_model(_perceptron_model(spark, d, "batch").to_df(spark))


@query("perceptron_predict", lambda: _perceptron_sql() + "SELECT p_partkey, CASE WHEN (x1 * w1 + x2 * w2) + b >= 0 THEN 1 ELSE -1 END AS prediction FROM pts, last")
def perceptron_predict_query(spark, d):
    m = _perceptron_model(spark, d)
    return linear.linear_predict(part_points(spark, d), m).select("p_partkey", "prediction")


def _pocket_model(spark, d):
    return linear.pocket_fit(part_points(spark, d), XS, "y_mix", "p_partkey", lr=POCKET_LR,
                             max_iter=POCKET_STEPS)


@query("pocket_fit", lambda: "{}\n{}".format(
    cte(**_pocket_ctes(POCKET_STEPS, POCKET_LR, "y_mix")), _weights_sql("best")))
def pocket_fit_query(spark, d):
    return _round_model(_pocket_model(spark, d).to_df(spark))


@query("pocket_predict", lambda: _predict_sign_sql(
    _pocket_ctes(POCKET_STEPS, POCKET_LR, "y_mix"), "best"))
def pocket_predict_query(spark, d):
    m = _pocket_model(spark, d)
    return linear.linear_predict(part_points(spark, d), m).select("p_partkey", "prediction")


# ---------------------------------------------------------- logistic regression
_LR_BASE = {
    "dl": DOCS_LABELED_SQL,
    "m": "SELECT toxic AS lab, row_number() OVER (ORDER BY count(*) DESC, toxic) - 1 AS idx "
         "FROM dl WHERE toxic IS NOT NULL GROUP BY toxic",
    "pts": "SELECT dl.doc_id, dl.x_len, dl.x_en, CAST(m.idx AS DOUBLE) AS y FROM dl JOIN m ON dl.toxic = m.lab",
}


def _softplus_sql(t):
    return f"(greatest({t}, {dbl(0.0)}) + ln({dbl(1.0)} + exp(-abs({t}))))"


def _lr_stats_sql(w: str) -> str:
    z = f"((x_len * {w}.w1 + x_en * {w}.w2) + {dbl(0.0)})"
    s = f"({dbl(1.0)} / ({dbl(1.0)} + exp(-{z})))"
    loss = f"CASE WHEN y = {dbl(1.0)} THEN {_softplus_sql('-' + z)} ELSE {_softplus_sql(z)} END"
    return (f"SELECT avg({loss}) AS log_loss, "
            f"avg(y * {s} + ({dbl(1.0)} - y) * ({dbl(1.0)} - {s})) AS mean_true_prob, "
            f"avg(({s} - y) * x_len) AS g1, avg(({s} - y) * x_en) AS g2, avg({s} - y) AS g_bias "
            f"FROM pts, {w}")


def _lr_ctes():
    parts = dict(_LR_BASE)
    parts["w0"] = f"SELECT {dbl(0.0)} AS w1, {dbl(0.0)} AS w2, {dbl(0.0)} AS b"
    for i in range(1, LR_STEPS + 1):
        parts[f"s{i}"] = _lr_stats_sql(f"w{i - 1}")
        # the step that finds the loss within the tolerance of the one before does not move, nor do later ones
        still = f"abs(g.log_loss - p.log_loss) <= {dbl(LR_TOL)}" if i > 1 else "false"
        parts[f"w{i}"] = (f"SELECT CASE WHEN {still} THEN w.w1 ELSE w.w1 - {dbl(LR_RATE)} * g.g1 END AS w1, "
                          f"CASE WHEN {still} THEN w.w2 ELSE w.w2 - {dbl(LR_RATE)} * g.g2 END AS w2, "
                          f"w.b AS b FROM w{i - 1} w, s{i} g" + (f", s{i - 1} p" if i > 1 else ""))
    return parts


def _lr_model(spark, d):
    return linear.logreg_fit(docs_labeled(spark, d), DOC_XS, "toxic", lr=LR_RATE, max_iter=LR_STEPS, tol=LR_TOL)


@query("logreg_fit", lambda: f"{cte(**_lr_ctes())}\n{_weights_sql(f'w{LR_STEPS}', DOC_XS)}")
def logreg_fit_query(spark, d):
    return _round_model(_lr_model(spark, d).to_df(spark))


@query("logreg_predict", lambda: f"""{cte(**_lr_ctes())}
SELECT pts.doc_id,
  {rnd(f"{dbl(1.0)} / ({dbl(1.0)} + exp(-((x_len * w.w1 + x_en * w.w2) + {dbl(0.0)})))")} AS probability,
  m.lab AS prediction
FROM pts, w{LR_STEPS} w, m
WHERE m.idx = CASE WHEN (x_len * w.w1 + x_en * w.w2) + {dbl(0.0)} >= 0 THEN 1 ELSE 0 END""")
def logreg_predict_query(spark, d):
    m = _lr_model(spark, d)
    out = linear.linear_predict(docs_labeled(spark, d), m)
    return out.select("doc_id", r4("probability", 4).alias("probability"), "prediction")


def _fixed_lr_sql():
    parts = dict(_LR_BASE)
    parts["wf"] = f"SELECT {dbl(LOGIT_W[0])} AS w1, {dbl(LOGIT_W[1])} AS w2, {dbl(0.0)} AS b"
    parts["sf"] = _lr_stats_sql("wf")
    return cte(**parts)


def _fixed_lr_step(spark, d):
    dl = docs_labeled(spark, d)
    return linear.logreg_step(dl.withColumn("_y", linear.binary_labels(dl, "toxic").index("toxic")), DOC_XS, "_y", LOGIT_W)


@query("logreg_objective", lambda: f"""{_fixed_lr_sql()}
SELECT {rnd('log_loss')} AS log_loss, {rnd('mean_true_prob')} AS mean_true_prob FROM sf""")
def logreg_objective_query(spark, d):
    return _fixed_lr_step(spark, d).select(r4("log_loss", 4).alias("log_loss"), r4("mean_true_prob", 4).alias("mean_true_prob"))


@query("logreg_gradient", lambda: f"""{_fixed_lr_sql()}
SELECT {rnd('g1', 6)} AS g_x_len, {rnd('g2', 6)} AS g_x_en, {rnd('g_bias', 6)} AS g_bias FROM sf""")
def logreg_gradient_query(spark, d):
    return _fixed_lr_step(spark, d).select(r4("g0", 6).alias("g_x_len"), r4("g1", 6).alias("g_x_en"), r4("g_bias", 6).alias("g_bias"))


# --------------------------------------------------------------------- k-means
def _km_assign_sql(src: str, cen: str, k: int) -> str:
    d2 = [f"((x1 - {cen}.c{j}_1) * (x1 - {cen}.c{j}_1) + (x2 - {cen}.c{j}_2) * (x2 - {cen}.c{j}_2))"
          for j in range(k)]
    m = "least(" + ", ".join(d2) + ")"
    case = "CASE " + " ".join(f"WHEN {x} = {m} THEN {i}" for i, x in enumerate(d2[:-1])) + f" ELSE {k - 1} END"
    return f"SELECT p_partkey, x1, x2, {case} AS cluster, sqrt({m}) AS distance FROM {src}, {cen}"


def _wide(c: str, k: int) -> str:
    cols = ", ".join(f"max(CASE WHEN cluster = {j} THEN c1 END) AS c{j}_1, "
                     f"max(CASE WHEN cluster = {j} THEN c2 END) AS c{j}_2" for j in range(k))
    return f"SELECT {cols} FROM {c}"


def _km_ctes(steps: int, k: int, centers=None) -> dict:
    parts = {"pts": PART_POINTS_SQL}
    if centers is None:
        parts["c0"] = (f"SELECT CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INTEGER) AS cluster, "
                       f"x1 AS c1, x2 AS c2 FROM pts ORDER BY p_partkey LIMIT {k}")
    else:
        parts["c0"] = " UNION ALL ".join(f"SELECT {j} AS cluster, {dbl(c[0])} AS c1, {dbl(c[1])} AS c2"
                                         for j, c in enumerate(centers))
    for i in range(1, steps + 1):
        parts[f"cw{i - 1}"] = _wide(f"c{i - 1}", k)
        parts[f"a{i}"] = _km_assign_sql("pts", f"cw{i - 1}", k)
        parts[f"u{i}"] = (f"SELECT cluster, count(*) AS n, sum(distance) AS cost, avg(x1) AS m1, avg(x2) AS m2 "
                          f"FROM a{i} GROUP BY cluster")
        parts[f"c{i}"] = (f"SELECT c.cluster, coalesce(u.m1, c.c1) AS c1, coalesce(u.m2, c.c2) AS c2, "
                          f"coalesce(u.n, 0) AS n, coalesce(u.cost, {dbl(0.0)}) AS cost "
                          f"FROM c{i - 1} c LEFT JOIN u{i} u ON c.cluster = u.cluster")
    if steps > 1:  # the first step whose cost is within the tolerance of the one before, else the last
        costs = " UNION ALL ".join(f"SELECT {i} AS i, sum(cost) AS cost FROM c{i}" for i in range(1, steps + 1))
        every = " UNION ALL ".join(f"SELECT {i} AS i, cluster, c1, c2, n, cost FROM c{i}" for i in range(1, steps + 1))
        parts["stop"] = (f"SELECT coalesce(min(i), {steps}) AS i FROM (SELECT i, cost, lag(cost) OVER (ORDER BY i) AS before "
                         f"FROM ({costs})) WHERE abs(cost - before) <= {dbl(KM_TOL)}")
        parts["fit"] = f"SELECT e.* FROM ({every}) e JOIN stop USING (i)"
    return parts


def _km_model_sql(steps, k, centers=None):
    return (f"{cte(**_km_ctes(steps, k, centers))}\nSELECT cluster, [{rnd('c1')}, {rnd('c2')}] AS center, "
            f"n, {rnd('cost')} AS cost FROM {'fit' if steps > 1 else f'c{steps}'}")


def _km_model_df(spark, model):
    df = model.to_df(spark)
    return df.select("cluster", F.transform("center", lambda v: r4(v, 4)).alias("center"), "n",
                     r4("cost", 4).alias("cost"))


def _km_model(spark, d):
    return cluster.kmeans_fit(part_points(spark, d), XS, KM_K, key="p_partkey", max_iter=KM_STEPS, tol=KM_TOL)


@query("kmeans_fit", lambda: _km_model_sql(KM_STEPS, KM_K))
def kmeans_fit_query(spark, d):
    return _km_model_df(spark, _km_model(spark, d))


@query("kmeans_update", lambda: _km_model_sql(1, KM_K, KM_CENTERS))
def kmeans_update_query(spark, d):
    m = cluster.kmeans_fit(part_points(spark, d), XS, KM_K, init=KM_CENTERS, max_iter=1, tol=-1.0)
    return _km_model_df(spark, m)


@query("kmeans_assign", lambda: f"""{cte(**_km_ctes(0, KM_K, KM_CENTERS))}, cw0 AS ({_wide('c0', KM_K)})
SELECT p_partkey, cluster, {rnd('distance')} AS distance FROM ({_km_assign_sql('pts', 'cw0', KM_K)})""")
def kmeans_assign_query(spark, d):
    out = cluster.kmeans_assign(part_points(spark, d), XS, KM_CENTERS)
    return out.select("p_partkey", "cluster", r4("distance", 4).alias("distance"))


def kmeans_predict_query(spark, d):
    m = _km_model(spark, d)
    out = cluster.kmeans_predict(part_points(spark, d), m)
    return out.select("p_partkey", "cluster", r4("distance", 4).alias("distance"))


query("kmeans_predict", lambda: f"""{cte(**_km_ctes(KM_STEPS, KM_K))}, cwf AS ({_wide('fit', KM_K)})
SELECT p_partkey, cluster, {rnd('distance')} AS distance FROM ({_km_assign_sql('pts', 'cwf', KM_K)})""")(
    kmeans_predict_query)


# ----------------------------------------------------------------- naive Bayes
def _nb_ctes():
    unp = " UNION ALL ".join(f"SELECT quality, '{f}' AS feature, {f} AS value FROM dl" for f in NB_FEATURES)
    return {
        "dl": DOCS_LABELED_SQL,
        "pri": "SELECT quality, count(*) AS n FROM dl WHERE quality IS NOT NULL GROUP BY quality",
        "tot": "SELECT sum(n) AS big_n, count(*) AS n_cls FROM pri",
        "cells": f"SELECT quality, feature, value, count(*) AS n FROM ({unp}) "
                 f"WHERE quality IS NOT NULL AND value IS NOT NULL GROUP BY quality, feature, value",
        "nv": "SELECT feature, count(DISTINCT value) AS nv FROM cells GROUP BY feature",
    }


def _nb_model(spark, d):
    return bayes.nb_fit(docs_labeled(spark, d), NB_FEATURES, "quality", smoothing=1.0)


@query("nb_priors", lambda: f"""{cte(**_nb_ctes())}
SELECT quality, n, {rnd(f"(n + {dbl(1.0)}) / (big_n + {dbl(1.0)} * n_cls)")} AS prior FROM pri, tot""")
def nb_priors_query(spark, d):
    return bayes.nb_priors(docs_labeled(spark, d), "quality").withColumn("prior", r4("prior", 4))


@query("nb_conditionals", lambda: f"""{cte(**_nb_ctes())},
seen AS (SELECT DISTINCT feature, value FROM cells)
SELECT p.quality, s.feature, s.value, coalesce(c.n, 0) AS n,
  {rnd(f"(coalesce(c.n, 0) + {dbl(1.0)}) / (p.n + {dbl(1.0)} * v.nv)")} AS prob
FROM seen s CROSS JOIN pri p JOIN nv v ON s.feature = v.feature
LEFT JOIN cells c ON c.quality = p.quality AND c.feature = s.feature AND c.value = s.value""")
def nb_conditionals_query(spark, d):
    dl = docs_labeled(spark, d)
    return bayes.nb_tables(bayes._base(dl, NB_FEATURES, "quality"), NB_FEATURES, "quality")[1].withColumn("prob", r4("prob", 4))


def _nb_predict_sql():
    joins, terms = [], []
    for i, f in enumerate(NB_FEATURES):
        joins.append(f"LEFT JOIN cells c{i} ON c{i}.quality = p.quality AND c{i}.feature = '{f}' "
                     f"AND c{i}.value = d.{f} JOIN nv v{i} ON v{i}.feature = '{f}'")
        terms.append(f"CASE WHEN d.{f} IS NULL THEN {dbl(0.0)} ELSE ln((coalesce(c{i}.n, 0) + {dbl(1.0)}) / "
                     f"(p.n + {dbl(1.0)} * v{i}.nv)) END")
    score = f"ln((p.n + {dbl(1.0)}) / (tot.big_n + {dbl(1.0)} * tot.n_cls)) + " + " + ".join(terms)
    return f"""{cte(**_nb_ctes())},
sc AS (SELECT d.doc_id, p.quality AS cls, {score} AS score FROM dl d, pri p, tot {' '.join(joins)})
SELECT doc_id, cls AS prediction FROM (
  SELECT doc_id, cls, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cls) AS r FROM sc) WHERE r = 1"""


@query("nb_predict", _nb_predict_sql)
def nb_predict_query(spark, d):
    m = _nb_model(spark, d)
    return bayes.nb_predict(docs_labeled(spark, d), m).select("doc_id", "prediction")


# ------------------------------------------------------------------------ ID3
def _id3_cells_sql():
    unp = " UNION ALL ".join(f"SELECT quality, '{f}' AS feature, {f} AS value FROM dl" for f in ID3_FEATURES)
    return {"dl": DOCS_LABELED_SQL,
            "cells": f"SELECT feature, value, quality, count(*) AS c FROM ({unp}) WHERE quality IS NOT NULL "
                     f"GROUP BY feature, value, quality",
            "ce": "SELECT feature, sum(-(CAST(c AS DOUBLE) / nf) * log2(CAST(c AS DOUBLE) / nv)) AS cond_entropy "
                  "FROM (SELECT *, sum(c) OVER (PARTITION BY feature, value) AS nv, "
                  "sum(c) OVER (PARTITION BY feature) AS nf FROM cells) GROUP BY feature",
            "h": "SELECT sum(CASE WHEN c > 0 THEN -(c / t) * log2(c / t) ELSE 0 END) AS entropy FROM ("
                 "SELECT CAST(count(*) AS DOUBLE) AS c, CAST(sum(count(*)) OVER () AS DOUBLE) AS t "
                 "FROM dl WHERE quality IS NOT NULL GROUP BY quality)"}


@query("id3_entropy", f"""{cte(dl=DOCS_LABELED_SQL)}
SELECT lang, CAST(sum(c) AS BIGINT) AS n, {rnd("sum(CASE WHEN c > 0 THEN -(c / t) * log2(c / t) ELSE 0 END)")} AS entropy
FROM (SELECT lang, CAST(count(*) AS DOUBLE) AS c, CAST(sum(count(*)) OVER (PARTITION BY lang) AS DOUBLE) AS t
      FROM dl WHERE quality IS NOT NULL GROUP BY lang, quality) GROUP BY lang""")
def id3_entropy_query(spark, d):
    h = tree.label_entropy(docs_labeled(spark, d), "quality", ["lang"])
    return h.select("lang", "n", r4("entropy", 4).alias("entropy"))


@query("id3_cond_entropy", lambda: f"""{cte(**_id3_cells_sql())}
SELECT feature, {rnd('cond_entropy')} AS cond_entropy FROM ce""")
def id3_cond_entropy_query(spark, d):
    c = tree.conditional_entropy(docs_labeled(spark, d), "quality", ID3_FEATURES)
    return c.select("feature", r4("cond_entropy", 4).alias("cond_entropy"))


@query("id3_info_gain", lambda: f"""{cte(**_id3_cells_sql())}
SELECT feature, {rnd('gain')} AS gain, CAST(row_number() OVER (ORDER BY gain DESC, pos) AS INTEGER) AS rank FROM (
  SELECT ce.feature, h.entropy - ce.cond_entropy AS gain,
         CASE ce.feature {' '.join(f"WHEN '{f}' THEN {i}" for i, f in enumerate(ID3_FEATURES))} END AS pos
  FROM ce, h)""")
def id3_info_gain_query(spark, d):
    g = tree.info_gain(docs_labeled(spark, d), "quality", ID3_FEATURES)
    return g.select("feature", r4("gain", 4).alias("gain"), "rank")


def _id3_model(spark, d):
    return tree.id3_fit(docs_labeled(spark, d), ID3_FEATURES, "quality", threshold=ID3_THRESHOLD)


def _id3_ctes() -> dict:
    """The whole tree level by level: nK nodes of depth K, rK node of every row, sK best splits of depth K."""
    unp = " UNION ALL ".join(f"SELECT doc_id, quality, '{f}' AS feature, {f} AS value, {i} AS pos FROM dl"
                             for i, f in enumerate(ID3_FEATURES))
    parts = {"dl": DOCS_LABELED_SQL, "la": unp,
             "n0": "SELECT 0 AS node_id, CAST(NULL AS INTEGER) AS parent_id, CAST(NULL AS VARCHAR) AS edge_value, '|' AS used",
             "r0": "SELECT doc_id, 0 AS node FROM dl"}
    trees, before = [], "0"
    for k in range(len(ID3_FEATURES) + 1):
        parts[f"h{k}"] = (
            "SELECT node, sum(CASE WHEN c > 0 THEN -(c / t) * log2(c / t) ELSE 0 END) AS h, CAST(sum(c) AS BIGINT) AS n, "
            "count(*) AS n_labels, arg_min(quality, (-c, quality)) AS label FROM (SELECT r.node, dl.quality, "
            "CAST(count(*) AS DOUBLE) AS c, CAST(sum(count(*)) OVER (PARTITION BY r.node) AS DOUBLE) AS t "
            f"FROM r{k} r JOIN dl USING (doc_id) WHERE dl.quality IS NOT NULL GROUP BY r.node, dl.quality) GROUP BY node")
        parts[f"g{k}"] = (
            "SELECT node, feature, pos, h - ce AS gain FROM (SELECT node, feature, pos, sum(-(c / nf) * log2(c / nv)) AS ce "
            "FROM (SELECT *, sum(c) OVER (PARTITION BY node, feature, value) AS nv, sum(c) OVER (PARTITION BY node, feature) AS nf "
            "FROM (SELECT r.node, la.feature, la.pos, la.value, la.quality, CAST(count(*) AS DOUBLE) AS c "
            f"FROM r{k} r JOIN la USING (doc_id) WHERE la.quality IS NOT NULL GROUP BY ALL)) GROUP BY node, feature, pos) "
            f"JOIN h{k} USING (node) JOIN n{k} ON n{k}.node_id = node WHERE n_labels > 1 AND NOT contains(used, '|' || feature || '|')")
        parts[f"s{k}"] = (f"SELECT node, arg_min(feature, (-gain, pos)) AS feature, max(gain) AS gain, "
                          f"max(gain) >= {dbl(ID3_THRESHOLD)} AS split FROM g{k} GROUP BY node")
        trees.append(f"SELECT n.node_id, n.parent_id, {k} AS depth, CASE WHEN s.split THEN s.feature END AS split_feature, "
                     f"n.edge_value, h.label, coalesce(h.n, 0) AS n, s.gain FROM n{k} n LEFT JOIN h{k} h ON h.node = n.node_id "
                     f"LEFT JOIN s{k} s ON s.node = n.node_id")
        before = f"{before} + (SELECT count(*) FROM n{k})"
        parts[f"m{k}"] = (f"SELECT r.doc_id, r.node, la.value, la.quality, s.feature FROM r{k} r JOIN s{k} s ON r.node = s.node AND s.split "
                          "JOIN la ON la.doc_id = r.doc_id AND la.feature = s.feature WHERE la.value IS NOT NULL")
        parts[f"n{k + 1}"] = (
            f"SELECT CAST({before} - 1 + row_number() OVER (ORDER BY node, value) AS INTEGER) AS node_id, node AS parent_id, "
            f"value AS edge_value, n{k}.used || feature || '|' AS used FROM (SELECT DISTINCT node, value, feature FROM m{k} "
            f"WHERE quality IS NOT NULL) JOIN n{k} ON n{k}.node_id = node")
        parts[f"r{k + 1}"] = f"SELECT m.doc_id, n.node_id AS node FROM m{k} m JOIN n{k + 1} n ON n.parent_id = m.node AND n.edge_value = m.value"
    parts["tree"] = " UNION ALL ".join(trees)
    return parts


@query("id3_fit", lambda: f"""{cte(**_id3_ctes())}
SELECT CAST(node_id AS INTEGER) AS node_id, CAST(parent_id AS INTEGER) AS parent_id,
       CAST(depth AS INTEGER) AS depth, split_feature, edge_value, CAST(label AS VARCHAR) AS label,
       n, {rnd('gain')} AS gain FROM tree""")
def id3_fit_query(spark, d):
    return _id3_model(spark, d).to_df(spark).withColumn("gain", r4("gain", 4))


def _id3_deepest() -> str:
    return "coalesce(" + ", ".join(f"r{k}.node" for k in range(len(ID3_FEATURES), 0, -1)) + ", 0)"


@query("id3_predict", lambda: f"""{cte(**_id3_ctes())}
SELECT dl.doc_id, CAST({_id3_deepest()} AS INTEGER) AS node_id, t.label AS prediction
FROM dl {' '.join(f'LEFT JOIN r{k} ON dl.doc_id = r{k}.doc_id' for k in range(1, len(ID3_FEATURES) + 1))}
JOIN tree t ON t.node_id = {_id3_deepest()}""")
def id3_predict_query(spark, d):
    m = _id3_model(spark, d)
    return tree.id3_predict(docs_labeled(spark, d), m).select("doc_id", "node_id", "prediction")


# ------------------------------------------------------------------------ kNN
KNN_P = 3.0  # order of the Minkowski neighbours


def _knn_pairs_sql():
    terms = " + ".join(f"(q.v[{i + 1}] - t.v[{i + 1}]) * (q.v[{i + 1}] - t.v[{i + 1}])" for i in range(EMB_DIM))
    return (f"SELECT q.vec_id AS query_id, t.vec_id AS neighbor_id, t.label, sqrt({terms}) AS distance "
            f"FROM e q JOIN e t ON q.vec_id <> t.vec_id")


def _knn_top_sql():
    return (f"{cte(e=EMBEDDINGS_SQL)}, top AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM ({_knn_pairs_sql()})) "
            f"WHERE rank <= {KNN_K})")


def _knn_neighbors(spark, d, extra=()):
    e = embeddings(spark, d)
    q = e.select(F.col("vec_id").alias("query_id"), "v")
    t = e.select(F.col("vec_id").alias("neighbor_id"), "v", "label")
    return pairwise.nearest(q, t, "query_id", "neighbor_id", "v", "v", EMB_DIM, KNN_K,
                            exclude_self=True, extra=list(extra))


@query("knn_neighbors", lambda: f"""{_knn_top_sql()}
SELECT query_id, neighbor_id, CAST(rank AS INTEGER) AS rank, {rnd('distance')} AS distance FROM top""")
def knn_neighbors_query(spark, d):
    nb = _knn_neighbors(spark, d)
    return nb.select("query_id", "neighbor_id", "rank", r4("distance", 4).alias("distance"))


def _knn_measure_sql(metric: str):
    """All pairs of embeddings under one measure; similarities order the other way round."""
    q, t = [f"q.v[{i + 1}]" for i in range(EMB_DIM)], [f"t.v[{i + 1}]" for i in range(EMB_DIM)]
    dot = lambda a, b: "(" + " + ".join(f"{x} * {y}" for x, y in zip(a, b)) + ")"
    extra, value, where = "", "distance", "q.vec_id <> t.vec_id"
    if metric == "minkowski":
        p = dbl(KNN_P)
        expr = f"pow({' + '.join(f'pow(abs({a} - {b}), {p})' for a, b in zip(q, t))}, {dbl(1.0 / KNN_P)})"
    elif metric == "std_euclidean":
        extra = ", s AS MATERIALIZED (SELECT " + ", ".join(f"stddev_pop(v[{i + 1}]) AS s{i}" for i in range(EMB_DIM)) + " FROM e)"
        expr = "sqrt(" + " + ".join(f"CASE WHEN s{i} > 0 THEN (({a} - {b}) / s{i}) * (({a} - {b}) / s{i}) ELSE 0 END"
                                    for i, (a, b) in enumerate(zip(q, t))) + ")"
    else:
        value, where = "similarity", where + f" AND {dot(q, q)} > 0 AND {dot(t, t)} > 0"
        expr = f"{dot(q, t)} / (sqrt({dot(q, q)}) * sqrt({dot(t, t)}))" if metric == "cosine" else f"{dot(q, t)} / ({dot(q, q)} + {dot(t, t)} - {dot(q, t)})"
    order = f"{value} DESC" if value == "similarity" else value
    pairs = f"SELECT q.vec_id AS query_id, t.vec_id AS neighbor_id, {expr} AS {value} FROM e q JOIN e t ON {where}" + (", s" if extra else "")
    pairs = pairs if not extra else pairs.replace(f" ON {where}, s", f" ON {where} CROSS JOIN s")
    return (f"{cte(e=EMBEDDINGS_SQL)}{extra}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}, neighbor_id) AS rank "
            f"FROM ({pairs}))\nSELECT query_id, neighbor_id, CAST(rank AS INTEGER) AS rank, {rnd(value)} AS {value} FROM r WHERE rank <= {KNN_K}")


def _knn_measure(metric: str):
    def run(spark, d):
        e = embeddings(spark, d)
        q, t = e.select(F.col("vec_id").alias("query_id"), "v"), e.select(F.col("vec_id").alias("neighbor_id"), "v")
        nb = pairwise.nearest(q, t, "query_id", "neighbor_id", "v", "v", EMB_DIM, KNN_K, exclude_self=True, metric=metric,
                              p=KNN_P if metric == "minkowski" else None)
        value = "similarity" if metric in ("cosine", "tanimoto") else "distance"
        return nb.select("query_id", "neighbor_id", "rank", r4(value).alias(value))

    return run


for _m in ("minkowski", "std_euclidean", "cosine", "tanimoto"):
    query(f"knn_{_m}", (lambda m: lambda: _knn_measure_sql(m))(_m))(_knn_measure(_m))


@query("knn_hamming", f"""
WITH r AS (SELECT c_custkey AS query_id, s_suppkey AS neighbor_id, hamming(c_name, s_name) AS distance,
    row_number() OVER (PARTITION BY c_custkey ORDER BY hamming(c_name, s_name), s_suppkey) AS rank
  FROM customer JOIN supplier ON length(c_name) = length(s_name))
SELECT query_id, neighbor_id, CAST(rank AS INTEGER) AS rank, CAST(distance AS DOUBLE) AS distance FROM r WHERE rank <= {KNN_K}""")
def knn_hamming_query(spark, d):
    """The suppliers whose names differ from a customer's name at the fewest positions."""
    c, s = read_table(spark, d, "customer"), read_table(spark, d, "supplier")
    nb = pairwise.nearest(c, s, "c_custkey", "s_suppkey", "c_name", "s_name", None, KNN_K, metric="hamming")
    return nb.select(F.col("c_custkey").alias("query_id"), F.col("s_suppkey").alias("neighbor_id"), "rank", "distance")


@query("knn_jaccard", f"""
WITH b AS MATERIALIZED (SELECT l_orderkey AS id, list_sort(list_distinct(list(l_partkey))) AS parts FROM lineitem GROUP BY l_orderkey),
e AS MATERIALIZED (SELECT id, len(parts) AS n, unnest(parts) AS part FROM b),
shared AS (SELECT x.id AS query_id, y.id AS neighbor_id, 1.0 - CAST(count(*) AS DOUBLE) / CAST(any_value(x.n) + any_value(y.n) - count(*) AS DOUBLE) AS distance
  FROM e x JOIN e y ON x.part = y.part AND x.id <> y.id GROUP BY x.id, y.id),
few AS (SELECT id FROM b LEFT JOIN shared ON id = query_id GROUP BY id HAVING count(neighbor_id) < {KNN_K}),
low AS (SELECT id FROM b ORDER BY id LIMIT {3 * KNN_K + 3}),
spare AS (SELECT few.id AS query_id, low.id AS neighbor_id, CAST(1.0 AS DOUBLE) AS distance FROM few JOIN low ON few.id <> low.id
  WHERE NOT EXISTS (SELECT 1 FROM shared WHERE shared.query_id = few.id AND shared.neighbor_id = low.id)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM (SELECT * FROM shared UNION ALL SELECT * FROM spare))
SELECT query_id, neighbor_id, CAST(rank AS INTEGER) AS rank, {rnd('distance')} AS distance FROM r WHERE rank <= {KNN_K}""")
def knn_jaccard_query(spark, d):
    """Orders whose sets of parts are most alike."""
    b = read_table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("parts"))
    q, t = b.select(F.col("l_orderkey").alias("query_id"), "parts"), b.select(F.col("l_orderkey").alias("neighbor_id"), "parts")
    nb = pairwise.nearest_sets(q, t, "query_id", "neighbor_id", "parts", "parts", KNN_K, exclude_self=True)
    return nb.select("query_id", "neighbor_id", "rank", r4("distance").alias("distance"))


@query("knn_predict", lambda: f"""{_knn_top_sql()}
SELECT query_id, label AS prediction, votes FROM (
  SELECT query_id, label, votes, row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, nearest, label) AS r
  FROM (SELECT query_id, label, count(*) AS votes, min(distance) AS nearest FROM top GROUP BY query_id, label))
WHERE r = 1""")
def knn_predict_query(spark, d):
    nb = _knn_neighbors(spark, d, extra=["label"])
    return pairwise.knn_vote(nb, "query_id", "label")


# ------------------------------------------------------------------------ GMM
def _gmm_fixed_model():
    return mixture.GMMModel(XS, list(GMM_FIXED["weights"]), [list(m) for m in GMM_FIXED["means"]],
                            [[list(r) for r in c] for c in GMM_FIXED["covs"]])


def _gmm_params_sql(model) -> str:
    rows = []
    for j, (w, m, c) in enumerate(zip(model.weights, model.means, model.covs)):
        rows.append(f"SELECT {j} AS j, {dbl(w)} AS w, {dbl(m[0])} AS m1, {dbl(m[1])} AS m2, "
                    f"{dbl(c[0][0])} AS a, {dbl(c[0][1])} AS b, {dbl(c[1][1])} AS c")
    return " UNION ALL ".join(rows)


def _gmm_lp_sql(p: str) -> str:
    det = f"({p}.a * {p}.c - {p}.b * {p}.b)"
    c1, c2 = f"(x1 - {p}.m1)", f"(x2 - {p}.m2)"
    quad = (f"{c1} * {c1} * ({p}.c / {det}) + {c1} * {c2} * ({dbl(2.0)} * (-{p}.b / {det})) + "
            f"{c2} * {c2} * ({p}.a / {det})")
    const = f"({dbl(-0.5)} * ({dbl(2 * math.log(2 * math.pi))} + ln({det})))"
    return (f"SELECT pts.p_partkey, pts.x1, pts.x2, {p}.j, "
            f"ln({p}.w) + ({const} - {dbl(0.5)} * ({quad})) AS lp FROM pts, {p}")


def _gmm_gamma_sql(lp: str) -> str:
    return (f"SELECT p_partkey, x1, x2, j, exp(lp - lse) AS g, lse FROM (SELECT *, mx + ln(sum(exp(lp - mx)) "
            f"OVER (PARTITION BY p_partkey)) AS lse FROM (SELECT *, max(lp) OVER (PARTITION BY p_partkey) AS mx "
            f"FROM {lp}))")


def _gmm_mstep_sql(gam: str, prev: str) -> str:
    """New parameters in two passes (means, then moments around them); an empty component gets weight 0."""
    stats = f"SELECT j, sum(g) AS g, count(*) AS n, sum(g * x1) / sum(g) AS s1, sum(g * x2) / sum(g) AS s2 FROM {gam} GROUP BY j"
    moments = (f"SELECT t.j, any_value(s.g) AS g, any_value(s.n) AS n, any_value(s.s1) AS s1, any_value(s.s2) AS s2, "
               f"sum(t.g * (t.x1 - s.s1) * (t.x1 - s.s1)) AS q11, sum(t.g * (t.x1 - s.s1) * (t.x2 - s.s2)) AS q12, "
               f"sum(t.g * (t.x2 - s.s2) * (t.x2 - s.s2)) AS q22 FROM {gam} t JOIN ({stats}) s ON t.j = s.j GROUP BY t.j")
    return (f"SELECT p.j, s.g / s.n AS w, CASE WHEN s.g > 0 THEN s.s1 ELSE p.m1 END AS m1, "
            f"CASE WHEN s.g > 0 THEN s.s2 ELSE p.m2 END AS m2, CASE WHEN s.g > 0 THEN s.q11 / s.g ELSE p.a END AS a, "
            f"CASE WHEN s.g > 0 THEN s.q12 / s.g ELSE p.b END AS b, CASE WHEN s.g > 0 THEN s.q22 / s.g ELSE p.c END AS c "
            f"FROM {prev} p JOIN ({moments}) s ON p.j = s.j")


def _gmm_ctes(steps: int, fixed=None) -> dict:
    parts = {"pts": PART_POINTS_SQL}
    if fixed is not None:
        parts["p0"] = _gmm_params_sql(fixed)
    else:
        parts["v"] = "SELECT var_pop(x1) AS v1, var_pop(x2) AS v2 FROM pts"
        at = ", ".join(f"CAST(floor({(i + 0.5) / GMM_K} * n) AS BIGINT)" for i in range(GMM_K))
        parts["p0"] = (f"SELECT CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INTEGER) AS j, "
                       f"{dbl(1.0 / GMM_K)} AS w, x1 AS m1, x2 AS m2, v.v1 AS a, {dbl(0.0)} AS b, v.v2 AS c "
                       f"FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS r, count(*) OVER () AS n FROM pts), v "
                       f"WHERE r IN ({at})")
    for i in range(1, steps + 1):
        parts[f"lp{i}"] = _gmm_lp_sql(f"p{i - 1}")
        parts[f"ga{i}"] = _gmm_gamma_sql(f"lp{i}")
        parts[f"p{i}"] = _gmm_mstep_sql(f"ga{i}", f"p{i - 1}")
    if steps > 1:  # step i stops, without moving, when its mean log-likelihood is within the tolerance of step i - 1
        means = " UNION ALL ".join(f"SELECT {i} AS i, avg(lse) AS ll FROM ga{i}" for i in range(1, steps + 1))
        every = " UNION ALL ".join(f"SELECT {i} AS i, * FROM p{i}" for i in range(1, steps + 1))
        parts["stop"] = (f"SELECT coalesce(min(i) - 1, {steps}) AS i FROM (SELECT i, ll, lag(ll) OVER (ORDER BY i) AS before "
                         f"FROM ({means})) WHERE abs(ll - before) <= {dbl(GMM_TOL)}")
        parts["fit"] = f"SELECT j, w, m1, m2, a, b, c FROM ({every}) e JOIN stop USING (i)"
    return parts


def _gmm_model_out_sql(p: str, what: str) -> str:
    cols = {"weight": f"{rnd('w')} AS weight",
            "mean": f"[{rnd('m1')}, {rnd('m2')}] AS mean",
            "cov": f"[[{rnd('a')}, {rnd('b')}], [{rnd('b')}, {rnd('c')}]] AS cov"}
    sel = ", ".join(cols[w] for w in what.split(","))
    return f"SELECT j AS component, {sel} FROM {p}"


def _gmm_model_df(spark, model, what="weight,mean,cov"):
    df = model.to_df(spark)
    cols = {"weight": r4("weight", 4).alias("weight"),
            "mean": F.transform("mean", lambda v: r4(v, 4)).alias("mean"),
            "cov": F.transform("cov", lambda r: F.transform(r, lambda v: r4(v, 4))).alias("cov")}
    return df.select("component", *[cols[w] for w in what.split(",")])


def _gmm_step_from_fixed(spark, d):
    base = part_points(spark, d).select(*XS)
    fixed = _gmm_fixed_model()
    stats = mixture.gmm_step_stats(base, XS, fixed)
    return mixture.m_step(stats, fixed)


for _what in ("weight", "mean", "cov"):
    _name = {"weight": "gmm_weights", "mean": "gmm_means", "cov": "gmm_covariances"}[_what]
    query(_name, (lambda w: lambda: f"{cte(**_gmm_ctes(1, _gmm_fixed_model()))}\n{_gmm_model_out_sql('p1', w)}")(
        _what))((lambda w: lambda spark, d: _gmm_model_df(spark, _gmm_step_from_fixed(spark, d), w))(_what))


def _gmm_model(spark, d):
    return mixture.gmm_fit(part_points(spark, d), XS, GMM_K, key="p_partkey", max_iter=GMM_STEPS, tol=GMM_TOL)


@query("gmm_fit", lambda: f"{cte(**_gmm_ctes(GMM_STEPS))}\n{_gmm_model_out_sql('fit', 'weight,mean,cov')}")
def gmm_fit_query(spark, d):
    return _gmm_model_df(spark, _gmm_model(spark, d))


def _gmm_score_sql(steps, fixed=None, what="probability"):
    parts = _gmm_ctes(steps, fixed)
    p = "fit" if steps > 1 else f"p{steps}"
    parts["lpf"] = _gmm_lp_sql(p)
    parts["gaf"] = _gmm_gamma_sql("lpf")
    if what == "density":
        return (f"{cte(**parts)}\nSELECT p_partkey, list({rnd(f'exp(lp - ln(w))')} ORDER BY j) AS density "
                f"FROM lpf JOIN {p} USING (j) GROUP BY p_partkey")
    pred = "arg_min(j, (-g, j))"
    return (f"{cte(**parts)}\nSELECT p_partkey, list({rnd('g')} ORDER BY j) AS probability"
            + (f", {pred} AS prediction" if what == "predict" else "") + " FROM gaf GROUP BY p_partkey")


@query("gmm_responsibilities", lambda: _gmm_score_sql(0, _gmm_fixed_model()))
def gmm_responsibilities_query(spark, d):
    out = mixture.gmm_predict(part_points(spark, d), _gmm_fixed_model())
    return out.select("p_partkey", F.transform("probability", lambda v: r4(v, 4)).alias("probability"))


@query("gmm_densities", lambda: _gmm_score_sql(0, _gmm_fixed_model(), "density"))
def gmm_densities_query(spark, d):
    out = mixture.gmm_densities(part_points(spark, d), _gmm_fixed_model())
    return out.select("p_partkey", F.transform("density", lambda v: r4(v, 4)).alias("density"))


@query("gmm_predict", lambda: _gmm_score_sql(GMM_STEPS, None, "predict"))
def gmm_predict_query(spark, d):
    out = mixture.gmm_predict(part_points(spark, d), _gmm_model(spark, d))
    return out.select("p_partkey", F.transform("probability", lambda v: r4(v, 4)).alias("probability"),
                      "prediction")

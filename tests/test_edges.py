"""Edge cases: empty input, one class, nulls, unseen values, k > rows, zero vectors."""

import math

import pytest
from pyspark.sql import functions as F

from tablelearn.functions import distance as D
from tablelearn.operators import bayes, cluster, linear, pairwise, tree
from tablelearn.operators.encode import label_counts


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k long, x1 double, x2 double, y int, c string")
    m = cluster.kmeans_fit(empty, ["x1", "x2"], 2, key="k")
    assert m.centers == []
    p = linear.perceptron_fit(empty, ["x1", "x2"], "y", "k")
    assert p.converged and p.weights == [0.0, 0.0]
    t = tree.id3_fit(empty, ["c"], "y")
    assert [r["n"] for r in t.nodes.collect()] == [0]
    nb = bayes.nb_fit(empty, ["c"], "y")
    assert nb.classes == [] and bayes.nb_predict(empty, nb).count() == 0


def test_one_class_and_constant_feature(spark):
    df = spark.createDataFrame([(i, "a", "z", 1.0) for i in range(5)], "k long, c string, y string, x double")
    t = tree.id3_fit(df, ["c"], "y")
    assert [r["label"] for r in t.nodes.collect()] == ["z"]
    g = tree.info_gain(df, "y", ["c"]).first()
    assert g["gain"] == pytest.approx(0.0)
    nb = bayes.nb_fit(df, ["c"], "y")
    assert [r["prediction"] for r in bayes.nb_predict(df, nb).collect()] == ["z"] * 5


def test_null_feature_and_label(spark):
    df = spark.createDataFrame([(1, "a", "p"), (2, None, "p"), (3, "b", None), (4, "b", "q")],
                               "k long, c string, y string")
    nb = bayes.nb_fit(df, ["c"], "y")
    assert nb.class_counts == {"p": 2, "q": 1}
    preds = {r["k"]: r["prediction"] for r in bayes.nb_predict(df, nb).collect()}
    assert preds[2] == "p"  # null feature: prior decides
    assert {r["y"]: r["label_index"] for r in label_counts(df, "y").collect()} == {"p": 0.0, "q": 1.0}


def test_unseen_value(spark):
    train = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "c string, y string")
    t = tree.id3_fit(train, ["c"], "y", threshold=0.0)
    test = spark.createDataFrame([("zzz",)], "c string")
    r = tree.id3_predict(test, t).first()
    assert r["node_id"] == 0 and r["prediction"] == "x"  # stops at the root, root majority
    nb = bayes.nb_fit(train, ["c"], "y")
    assert bayes.nb_predict(test, nb).first()["prediction"] == "x"


def test_k_larger_than_rows(spark):
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(3)], "id long, v array<double>")
    nb = pairwise.nearest(df, df, "id", "id", "v", "v", 2, k=10, exclude_self=True)
    counts = {r["id"]: r["n"] for r in nb.groupBy("id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {0: 2, 1: 2, 2: 2}


def test_equal_rows_different_labels(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0], "b"), (2, [0.0, 0.0], "a"), (3, [5.0, 5.0], "c")],
                               "id long, v array<double>, label string")
    q = spark.createDataFrame([(9, [0.1, 0.0])], "id long, v array<double>")
    pred = pairwise.knn_predict(q, df, "id", "id", "v", "v", "label", 2, k=2).first()
    assert pred["prediction"] == "a"  # 1-1 vote, same distance: smaller label


def test_zero_vectors_and_empty_sets(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0], [], [], "abc", "abd", "ab", "abc")],
                               "z array<double>, v array<double>, s1 array<string>, s2 array<string>, "
                               "h1 string, h2 string, h3 string, h4 string")
    r = df.select(D.cosine(F.col("z"), F.col("v"), 2).alias("cos"),
                  D.tanimoto(F.col("z"), F.col("z"), 2).alias("tan"),
                  D.jaccard("s1", "s2").alias("jac"),
                  D.hamming("h1", "h2").alias("ham"),
                  D.hamming("h3", "h4").alias("ham_unequal")).first()
    assert r["cos"] is None and r["tan"] is None
    assert r["jac"] == 0.0 and r["ham"] == 1 and r["ham_unequal"] is None


def test_empty_cluster_keeps_centre(spark):
    df = spark.createDataFrame([(i, float(i % 2), 0.0) for i in range(6)], "k long, x1 double, x2 double")
    m = cluster.kmeans_fit(df, ["x1", "x2"], 3, init=[[0.0, 0.0], [1.0, 0.0], [50.0, 50.0]], max_iter=3)
    assert m.centers[2] == [50.0, 50.0] and m.sizes[2] == 0


def test_minkowski_real_exponent(spark):
    df = spark.createDataFrame([([0.0, 0.0], [3.0, 4.0])], "a array<double>, b array<double>")
    r = df.select(D.minkowski(F.col("a"), F.col("b"), 2, 2).alias("m2"),
                  D.minkowski(F.col("a"), F.col("b"), 1, 2).alias("m1")).first()
    assert r["m2"] == pytest.approx(5.0) and r["m1"] == pytest.approx(7.0)


def test_one_event_sequence(spark):
    from tablelearn.operators import sequence

    pi, A = (0.1, 0.6, 0.3), ((0.8, 0.1, 0.1), (0.2, 0.6, 0.2), (0.4, 0.4, 0.2))
    B = ((0.3, 0.7), (0.5, 0.5), (0.9, 0.1))
    df = spark.createDataFrame([(7, 1, 1)], "k int, t int, o int")
    for method in ("forward", "backward"):
        r = sequence.hmm_score(df, "k", ["t"], "o", pi, A, B, symbols=[0, 1], method=method).first()
        assert r["n_obs"] == 1
        assert r["log_likelihood"] == pytest.approx(math.log(0.1 * 0.7 + 0.6 * 0.5 + 0.3 * 0.1))


def test_more_empty_inputs(spark):
    from tablelearn.operators import mixture, sequence

    empty = spark.createDataFrame([], "k long, x1 double, x2 double, y string, v array<double>")
    lr = linear.logreg_fit(empty, ["x1", "x2"], "y", max_iter=3)
    assert lr.weights == [0.0, 0.0] and lr.iterations == 0
    with pytest.raises(ValueError):
        mixture.gmm_fit(empty, ["x1", "x2"], 2, key="k", max_iter=2)  # no rows to start from
    assert pairwise.nearest(empty, empty, "k", "k", "v", "v", 2, 3).count() == 0
    ev = spark.createDataFrame([], "k long, t long, o string")
    assert sequence.hmm_score(ev, "k", ["t"], "o", (1.0,), ((1.0,),), ((1.0,),), symbols=["a"]).count() == 0

"""The mixture on many rows: each density is computed once a row, and sums agree with those of vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.operators import mixture

MODEL = mixture.GMMModel(["a", "b"], [0.3, 0.7, 0.0], [[0.0, 0.0], [1.0, 2.0], [5.0, 5.0]],
                         [[[1.0, 0.2], [0.2, 2.0]], [[2.0, -0.1], [-0.1, 0.5]], [[1.0, 0.0], [0.0, 1.0]]])


def _points(spark):
    rng = np.random.default_rng(2)
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(200, 2)))], "id int, a double, b double")


def test_densities_are_computed_once(spark):
    df = _points(spark).withColumn("a", F.col("a") * 1.25)
    plan = mixture.gmm_predict(df, MODEL)._jdf.queryExecution().optimizedPlan().toString()
    consts = [repr(g.const) for g in MODEL.terms()]
    assert [plan.count(c) for c in consts] == [1, 1, 1] and "lambdafunction" not in plan


def test_plain_sums_equal_the_sum_of_vectors(spark, monkeypatch):
    df = _points(spark)
    plain = mixture.gmm_step_stats(df, ["a", "b"], MODEL)
    monkeypatch.setattr(mixture, "SUMS", 0)
    vectors = mixture.gmm_step_stats(df, ["a", "b"], MODEL)
    assert plain["n"] == vectors["n"] == 200 and np.isclose(plain["ll"], vectors["ll"], rtol=1e-12)
    for j in range(3):
        for x, y in zip(plain[j], vectors[j]):
            assert np.allclose(x, y, rtol=1e-10, atol=1e-12)
    assert mixture.gmm_step_stats(df.where("false"), ["a", "b"], MODEL)["n"] == 0


def test_fit_deals_one_file_to_several_tasks(spark, tmp_path):
    _points(spark).coalesce(1).write.parquet(str(tmp_path / "points"))
    df = spark.read.parquet(str(tmp_path / "points"))
    seen, stats = [], mixture.gmm_step_stats

    def watched(base, *rest):
        seen.append(base.rdd.getNumPartitions())
        return stats(base, *rest)

    mixture.gmm_step_stats = watched
    try:
        mixture.gmm_fit(df, ["a", "b"], 2, key="id", max_iter=2)
    finally:
        mixture.gmm_step_stats = stats
    assert seen and min(seen) > 1


def test_incomplete_rows_still_end_the_step(spark):
    df = _points(spark).withColumn("a", F.when(F.col("id") != 3, F.col("a")))
    with pytest.raises(ValueError):
        mixture.gmm_step_stats(df, ["a", "b"], MODEL)

"""Joint logistic regressions against Spark ML's own, one after the other."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskweave.operators import ridges as R
from riskweave.operators import training as TR


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 4)) * [1.0, 30.0, 0.2, 0.0] + [0.0, 5.0, 1.0, 0.0]  # the last column has no spread
    y = (rng.random(900) < 1 / (1 + np.exp(-(x[:, 0] - 0.05 * x[:, 1] - 1)))).astype(float)
    data = [(i, i % 3, r.tolist(), float(t), float(w)) for i, (r, t, w) in enumerate(zip(x, y, rng.uniform(0.5, 3, 900)))]
    df = spark.createDataFrame(data, "id int, fold int, v array<double>, label double, weight double")
    return df.withColumn("features", array_to_vector("v")).drop("v").repartition(5).cache()


def settings(**how):
    base = LogisticRegression(maxIter=200, tol=1e-12, featuresCol="features", labelCol="label", weightCol="weight", **how)
    plain = base.copy()
    plain.clear(plain.weightCol)
    return [e.copy({e.regParam: reg}) for e in (base, plain) for reg in (1e-5, 0.01, 1.0)]


def test_equals_spark_ml(rows):
    found = R.ridges(rows, settings(), "fold")
    for fold in range(3):
        part = rows.where(F.col("fold") == fold)
        for estimator, got in zip(settings(), found[fold], strict=True):
            model = estimator.fit(part)
            assert got == pytest.approx([*model.coefficients.toArray(), model.intercept], abs=2e-5)
            assert got[3] == 0.0


def test_scores_equal_spark_ml(rows):
    one = settings()[1]
    model = one.fit(rows)
    coefficients = [np.append(model.coefficients.toArray(), model.intercept)] * 2
    got = {r["id"]: r["scores"] for r in R.ridge_scores(rows.select("id", "features"), coefficients).collect()}
    for r in TR.scored(model, rows, "id", "label").collect():
        assert got[r["id"]] == pytest.approx([r["score"]] * 2)


def test_a_search_fits_no_model_by_itself(spark, monkeypatch):
    """Six settings on three folds take no fit of their own, and get the areas of fits one after the other."""
    rng = np.random.default_rng(2)
    rows = [(i, i % 3, float(a), "xy"[i % 2], int(a + b > 0.4)) for i, (a, b) in enumerate(rng.normal(size=(600, 2)))]
    df = spark.createDataFrame(rows, "id int, fold int, a double, c string, y int")
    spec = TR.FeatureSpec("churn", "y", ("a",), ("c",))
    trials = {str(i): TR.with_setting(TR.candidates("churn")["logistic_regression"], {"C": c, "weighted": w}, 400) for i, (c, w) in enumerate([(0.1, True), (10.0, False)])}
    alone = {n: TR.cross_validate(df, spec, "id", 3, {n: e})[n][0] for n, e in trials.items()}
    monkeypatch.setattr(LogisticRegression, "_fit", lambda *a: pytest.fail("a fit of its own"))
    together = TR.cross_validate(df, spec, "id", 3, trials)
    assert {n: found[0] for n, found in together.items()} == pytest.approx(alone, abs=1e-4)


def test_other_penalties_are_left_to_spark_ml():
    assert R.is_ridge(settings()[0]) and not R.is_ridge(LogisticRegression(regParam=0.0)) and not R.is_ridge(settings(elasticNetParam=0.5)[0])

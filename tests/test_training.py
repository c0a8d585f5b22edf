import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import anomaly as AN
from riskweave.operators import neighbors as NB
from riskweave.operators import preparation as P
from riskweave.operators import training as TR

SMALL = P.FeatureSpec("churn", "churn_flag", ("tenure", "monthly_charges", "total_charges"), ("contract_type",))


@pytest.fixture(scope="module")
def churn(spark):
    rng = random.Random(11)
    rows = []
    for i in range(1500):
        tenure, monthly = rng.randint(0, 71), rng.uniform(20, 120)
        contract = rng.choices(["Month-to-month", "One year", "Two year"], [0.6, 0.2, 0.2])[0]
        z = -0.05 * tenure + 0.02 * monthly + 1.2 * (contract == "Month-to-month") - 0.8
        rows.append((i, tenure, monthly, tenure * monthly, contract, int(rng.random() < 1 / (1 + math.exp(-z)))))
    df = spark.createDataFrame(rows, "id int, tenure int, monthly_charges double, total_charges double, contract_type string, churn_flag int")
    return df.cache()


def test_chronological_split(spark):
    df = spark.createDataFrame([(i, i % 10 + 1, i, int(i % 5 == 0)) for i in range(400)], "id int, feature_a int, transaction_dt int, target int")
    parts = P.split_for_training(df, "target", "id", "transaction_dt")
    got = {r["part"]: r for r in parts.groupBy("part").agg(F.count("*").alias("n"), F.min("transaction_dt").alias("lo"), F.max("transaction_dt").alias("hi")).collect()}
    assert (got["fit"]["n"], got["val"]["n"], got["test"]["n"]) == (256, 64, 80)
    assert got["fit"]["hi"] < got["val"]["lo"] and got["val"]["hi"] < got["test"]["lo"]


def test_split_falls_back_when_the_latest_part_has_one_class(spark):
    df = spark.createDataFrame([(i, i, int(i < 200)) for i in range(400)], "id int, transaction_dt int, target int")
    parts = P.split_for_training(df, "target", "id", "transaction_dt")
    assert parts.where("part = 'test'").select("target").distinct().count() == 2


def test_stratified_shares(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    got = {(r["part"], r["y"]): r["count"] for r in P.split_stratified(df, "y", "id").groupBy("part", "y").count().collect()}
    assert got["test", 1] == 20 and got["test", 0] == 180 and got["fit", 1] == 64 and got["val", 0] == 144


def test_fold_count(spark):
    df = spark.range(100).withColumn("y", (F.col("id") < 3).cast("int"))
    assert P.fold_count(df, "y") == 3


def points(spark, n=60, majority=600):
    rng = np.random.default_rng(5)
    rows = [(i, 1, [float(v) for v in rng.normal(size=3)]) for i in range(n)]
    rows += [(n + i, 0, [9.0, 9.0, 9.0]) for i in range(majority)]
    return spark.createDataFrame(rows, "id int, y int, v array<double>"), np.array([r[2] for r in rows[:n]])


def test_neighbors_do_not_depend_on_partitions(spark):
    df = points(spark)[0].where("y = 1").select("id", "v")
    one, many = (P.nearest_minority(df.repartition(n), "id", "v") for n in (1, 7))
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def recall_of(spark, n, dims, **search):
    """Share of true five nearest neighbours that are found, ties of distance counting; at most 400 points are looked up."""
    x = np.random.default_rng(n + dims).normal(size=(n, dims))
    df = spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())], "id int, v array<double>").repartition(8)
    got = {r["id"]: [e["neighbor"] for e in r["near"]] for r in NB.nearest(df, "id", "v", 5, **search).collect()}
    asked = np.random.default_rng(1).choice(n, min(n, 400), replace=False)
    hits = 0
    for i in asked:
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        assert i not in got[i] and len(got[i]) == len(set(got[i])) == 5
        hits += (d[got[i]] <= np.sort(d)[4]).sum()
    assert len(got) == n
    return hits / (5 * len(asked))


@pytest.mark.parametrize("dims", [3, 20, 57])
def test_neighbors_of_one_leaf_are_exact(spark, dims):
    assert recall_of(spark, 400, dims) == recall_of(spark, 4000, dims) == 1.0


@pytest.mark.parametrize("dims", [3, 20, 57])
def test_recall_of_many_points(spark, dims):
    assert recall_of(spark, 40_000, dims) >= 0.9


def test_rounds_over_the_graph_mend_a_poor_forest(spark):
    """Leaves far too small: one tree finds little, the rounds reach the target."""
    assert recall_of(spark, 4000, 12, trees=2, leaf=256, recall=0.0) < 0.6
    assert recall_of(spark, 4000, 12, trees=2, leaf=256) >= 0.9


def test_equal_points_are_parted(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3000)] + [(5000 + i, [float(i), 0.0]) for i in range(50)], "id int, v array<double>").repartition(4)
    got = NB.nearest(df, "id", "v", 5, trees=3, leaf=128).collect()
    assert len(got) == 3050 and all(len(r["near"]) == 5 for r in got)
    assert all(e["distance"] == 0 for r in got if r["id"] < 3000 for e in r["near"])


def test_few_points(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [3.0])], "id int, v array<double>")
    assert {(r["id"], r["near"][0]["neighbor"], r["near"][0]["distance"]) for r in NB.nearest(df, "id", "v", 5).collect()} == {(1, 2, 9.0), (2, 1, 9.0)}
    assert NB.nearest(df.limit(1), "id", "v", 5).count() == 0


def test_smote(spark):
    df, m = points(spark)
    out = P.resample_smote(df, "y", "id", "v").collect()
    made = [r for r in out if r["synthetic"]]
    assert sum(r["y"] == 1 for r in out) == 150 and len(made) == 90 and sum(r["y"] == 0 for r in out) == 600
    lo, hi = m.min(axis=0), m.max(axis=0)
    for r in made:  # on a segment between minority points
        assert (np.array(r["v"]) >= lo - 1e-9).all() and (np.array(r["v"]) <= hi + 1e-9).all()


def test_impute_and_scale(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 100.0)], "id int, x double")
    got = [r["x"] for r in P.impute_scale(df, ["x"]).orderBy("id").collect()]
    want = np.array([1.0, 3.0, 3.0, 100.0])
    assert got == pytest.approx(list((want - want.mean()) / want.std()))


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",), ("b",)], "c string")
    assert P.column_modes(df, ["c"]).first()["mode"] == "a"


def boosting(task):
    return {"gradient_boosting": TR.GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=5, maxDepth=3, seed=1)}


def test_train_candidates(churn):
    result = TR.train_candidates(churn, SMALL, "id", folds=2, tune=True, draws=1, grids={"gradient_boosting": {"maxDepth": [3]}}, resample=False,
                                 models=boosting)
    assert result.rows["validation"] > 0 and 0.5 < result.metrics["roc_auc"] <= 1
    m = result.metrics
    assert m["tp"] + m["fp"] + m["tn"] + m["fn"] == result.rows["test"]
    assert result.calibrator.method in ("isotonic", "sigmoid")
    meta = result.metadata()
    assert meta["target"] == "churn_flag" and meta["pipeline"]["threshold_fit"] == "validation_holdout" and meta["metrics"]["tuning_seconds"] > 0


def test_unknown_category_scores(churn, spark):
    model = TR.fit_candidate(churn, SMALL, TR.candidates("churn")["logistic_regression"], "id")
    odd = churn.limit(5).withColumn("contract_type", F.lit("never seen")).withColumn("tenure", F.lit(None).cast("int"))
    scores = [r["score"] for r in TR.scored(model, odd, "id", "churn_flag").collect()]
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    top = TR.feature_importance(model, SMALL, spark)
    assert top.count() == len(TR.encoded_names(model, SMALL)) == 6
    parts = TR.explain_linear(model, churn, SMALL, "id")
    assert parts.count() == 1500 * 6
    assert TR.top_features(parts).first()["impact"] > 0


def test_saved_pipeline_scores_the_same(churn, spark, tmp_path):
    from pyspark.ml import PipelineModel

    model = TR.fit_candidate(churn, SMALL, TR.candidates("churn")["logistic_regression"], "id")
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a = TR.scored(model, churn, "id", "churn_flag").orderBy("id").collect()
    assert a == TR.scored(again, churn, "id", "churn_flag").orderBy("id").collect()


def test_permutation_importance(churn):
    model = TR.fit_candidate(churn, SMALL, TR.candidates("churn")["logistic_regression"], "id")
    got = {r["feature"]: r["importance"] for r in TR.permutation_importance(model, churn, SMALL, "id").collect()}
    assert set(got) == set(SMALL.features) and max(got, key=got.get) == "tenure"


def test_resampled_fit(spark):
    df, _ = points(spark, 80, 700)
    spec = P.FeatureSpec("fraud", "y", ("a", "b"), ())
    flat = df.select("id", "y", F.col("v")[0].alias("a"), F.col("v")[1].alias("b"))
    prep, ready = TR.encode(flat, spec, "id", resample=True)
    got = {r["label"]: r["count"] for r in ready.groupBy("label").count().collect()}
    assert got == {1.0: 175, 0.0: 350}


@pytest.mark.parametrize("power", [2.0])
def test_calibration_choice(spark, power):
    rng = random.Random(2)
    rows = [(i, s := rng.random(), int(rng.random() < s**power)) for i in range(800)]
    df = spark.createDataFrame(rows, "id int, score double, y int")
    cal = TR.calibrate_scores(df, "y", "score", "id")
    out = cal.apply(df)
    assert cal.method in ("isotonic", "sigmoid")
    lo, hi = out.agg(F.min("score"), F.max("score")).first()
    assert 0 <= lo <= hi <= 1
    brier = lambda d: d.agg(F.avg((F.col("score") - F.col("y")) ** 2)).first()[0]
    assert brier(out) < brier(df)


def test_forest_finds_outliers(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(600)] + [(1000 + i, [8.0 + i, -9.0, 8.0]) for i in range(5)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    top = [r["id"] for r in AN.anomaly_scores(df, "id", "v", trees=30).orderBy(F.col("score").desc()).limit(5).collect()]
    assert sum(i >= 1000 for i in top) >= 4


def test_fraud_run_includes_the_forest(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        y = int(rng.random() < 0.12)
        rows.append((i, i, rng.gauss(50 + 150 * y, 40), rng.choice(["mobile", "desktop"]), y))
    df = spark.createDataFrame(rows, "id int, transaction_dt int, transaction_amt double, device_type string, is_fraud int")
    spec = P.FeatureSpec("fraud", "is_fraud", ("transaction_amt",), ("device_type",))
    result = TR.train_candidates(df, spec, "id", "transaction_dt", folds=2, tune=False, forest_trees=20,
                                 models=boosting)
    assert {r["algorithm"] for r in result.leaderboard} == {"gradient_boosting", "isolation_forest"}
    assert result.metrics["baseline_cost"] >= result.metrics["expected_cost"] and result.metrics["roc_auc"] > 0.8

"""Model training on Spark ML: candidates, search, calibration, explanation.

Loops run over a handful of models and folds; all row work is DataFrame jobs
and only fitted models and single metrics come back to the driver.
"""

from __future__ import annotations

import itertools
import random
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import anomaly as AN
from . import evaluation as E
from .attribution import explain_trees
from .boosting import PART_ROWS, HistogramBoosting, HistogramBoostingModel, fit_together, margins_together
from .isotonic import fit_isotonic
from .ordered import exact_medians, hashed_rank
from .preparation import FeatureSpec, class_counts, class_weights, column_modes, fold_count, kfold_stratified, resample_smote, resample_under, split_for_training
from .ridges import is_ridge, ridge_scores, ridges

# Search spaces: forest depths end at 30, the deepest that Spark fits; ``C`` is the inverse
# regularisation, turned into ``regParam`` with the number of training rows.
GRIDS = {
    "logistic_regression": {"C": [0.1, 1.0, 10.0], "weighted": [True, False]},
    "random_forest": {"numTrees": [100, 200, 400], "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 2, 5]},
    "gradient_boosting": {
        "maxIter": [20, 50, 100], "maxDepth": [3, 5, 7], "stepSize": [0.05, 0.1, 0.2], "subsamplingRate": [0.6, 0.8, 1.0], "featureRate": [0.6, 0.8, 1.0],
        "minHessian": [1.0, 3.0, 7.0, 15.0], "gamma": [0.0, 0.1, 0.5, 1.0], "l2": [1.0, 3.0, 10.0],
    },
}
# Sizes and limits of training.
SEARCH_DRAWS, SEARCH_FOLDS, FOLDS = 6, 3, 5
MIN_VALIDATION, MIN_VALIDATION_CLASS = 200, 20
ISOTONIC_ROWS, ISOTONIC_POSITIVES = 500, 30
LOGIT_CLIP = 1e-6
SEED = 42


def candidates(task: str, pos_weight: float | None = None) -> dict[str, Estimator]:
    """Estimators tried for a task; boosting for fraud weighs positives by `pos_weight` instead of balancing the classes."""
    common = {"featuresCol": "features", "labelCol": "label"}
    trees = {"churn": 180, "default": 220, "fraud": 200}[task]
    out: dict[str, Estimator] = {}
    if task == "churn":
        out["logistic_regression"] = LogisticRegression(maxIter=100, weightCol="weight", **common)
    out["random_forest"] = RandomForestClassifier(numTrees=trees, maxDepth=10, weightCol="weight", seed=SEED, **common)
    boosting = HistogramBoosting(maxIter=50, maxDepth=5, stepSize=0.1, seed=SEED, **common)
    scaled = task == "fraud" and pos_weight
    out["gradient_boosting"] = boosting.copy({boosting.posWeight: round(pos_weight, 3)} if scaled else {boosting.weightCol: "weight"})
    return out


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def preprocessor(train: DataFrame, spec: FeatureSpec) -> Pipeline:
    """Median impute and population scaling, mode impute and one-hot.

    The statistics (one small row per column) become literals of a
    ``SQLTransformer``, so the fitted pipeline can be saved like any other.
    Unknown categories are encoded as all zeros.
    """
    numeric, categorical = list(spec.numeric), list(spec.categorical)
    typed = train.select(*[F.col(c).cast("double").alias(c) for c in numeric])
    medians = exact_medians(typed, numeric)
    filled = typed.select(*[F.coalesce(F.col(c), F.lit(medians.get(c, 0.0))).alias(c) for c in numeric])
    stats = filled.agg(*[F.avg(c).alias(f"m_{c}") for c in numeric], *[F.stddev_pop(c).alias(f"s_{c}") for c in numeric]).first()
    modes = {r["column"]: r["mode"] for r in column_modes(train, categorical).collect()} if categorical else {}

    def z(c: str) -> str:
        mean, spread = stats[f"m_{c}"] or 0.0, stats[f"s_{c}"] or 1.0
        return f"(coalesce(cast(`{c}` as double), {medians.get(c, 0.0)!r}D) - {mean!r}D) / {spread!r}D AS `{c}__z`"

    def cat(c: str) -> str:
        return f"coalesce(cast(`{c}` as string), {_quoted(modes.get(c, 'unknown'))}) AS `{c}__v`"

    select = ", ".join(["*", *map(z, numeric), *map(cat, categorical)])
    stages = [SQLTransformer(statement=f"SELECT {select} FROM __THIS__")]
    if categorical:
        stages += [
            StringIndexer(inputCols=[f"{c}__v" for c in categorical], outputCols=[f"{c}__i" for c in categorical], handleInvalid="keep"),
            OneHotEncoder(inputCols=[f"{c}__i" for c in categorical], outputCols=[f"{c}__o" for c in categorical], dropLast=True),
        ]
    stages.append(VectorAssembler(inputCols=[*[f"{c}__z" for c in numeric], *[f"{c}__o" for c in categorical]], outputCol="features"))
    return Pipeline(stages=stages)


def encoded_names(prep: PipelineModel, spec: FeatureSpec) -> list[str]:
    """Names of the encoded features, in vector order."""
    names = list(spec.numeric)
    if spec.categorical:
        labels = prep.stages[1].labelsArray
        for column, values in zip(spec.categorical, labels):
            names += [f"{column}_{v}" for v in values]
    return names


def _ready(df: DataFrame, y: str) -> DataFrame:
    return class_weights(df.withColumn("label", F.col(y).cast("double")), y)


def rebalance(encoded: DataFrame, y: str, id_: str) -> DataFrame:
    """SMOTE to a quarter of the majority, then the majority down to twice the minority."""
    rows = encoded.select(id_, y, vector_to_array("features").alias("v"))
    # synthetic rows share the id of their origin, but only majority rows are ranked
    kept = resample_under(resample_smote(rows, y, id_, "v"), y, id_)
    return kept.select(id_, y, array_to_vector("v").alias("features"))


def encode(train: DataFrame, spec: FeatureSpec, id_: str, resample: bool = False) -> tuple[PipelineModel, DataFrame]:
    """Preprocessing fitted on the training rows, and those rows ready to fit on."""
    prep = preprocessor(train, spec).fit(train)
    encoded = prep.transform(train).select(id_, spec.target, "features")
    if resample:
        encoded = rebalance(encoded, spec.target, id_)
    return prep, _ready(encoded, spec.target).select("label", "weight", "features")


def spread(df: DataFrame, id_: str) -> DataFrame:
    """Rows dealt to all cores and kept: few files or a coalesced shuffle would leave every pass of a fit to a few tasks."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // PART_ROWS))
    return df.repartition(parts, id_).persist(StorageLevel.MEMORY_AND_DISK)


def fit_candidate(train: DataFrame, spec: FeatureSpec, estimator: Estimator, id_: str, resample: bool = False) -> PipelineModel:
    """One pipeline of preprocessing and estimator, fitted on the training rows only."""
    train = spread(train.select(id_, *spec.features, spec.target), id_)
    prep, ready = encode(train, spec, id_, resample)
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel(stages=[*prep.stages, estimator.fit(ready)])
    finally:
        ready.unpersist()
        train.unpersist()


@dataclass
class ForestModel:
    """Preprocessing and an isolation forest (unsupervised candidate)."""

    prep: PipelineModel
    nodes: object

    def scores(self, df: DataFrame, id_: str, y: str) -> DataFrame:
        vectors = self.prep.transform(df).select(id_, y, vector_to_array("features").alias("v"))
        return AN.anomaly_scores(vectors, id_, "v", nodes=self.nodes)


def fit_forest(train: DataFrame, spec: FeatureSpec, id_: str, trees: int = AN.TREES) -> ForestModel:
    prep = preprocessor(train, spec).fit(train)
    vectors = prep.transform(train).select(id_, vector_to_array("features").alias("v"))
    return ForestModel(prep, AN.grow_forest(vectors, id_, "v", trees).toPandas())


def scored(model: PipelineModel | ForestModel, df: DataFrame, id_: str, y: str) -> DataFrame:
    if isinstance(model, ForestModel):
        return model.scores(df, id_, y)
    return model.transform(df).select(id_, y, vector_to_array("probability")[1].alias("score"))


def cross_validate(
    folded: DataFrame, spec: FeatureSpec, id_: str, k: int, estimators: Mapping[str, Estimator], resample: bool = False
) -> dict[str, tuple[float, float]]:
    """Out-of-fold ROC-AUC and seconds of each estimator.

    All estimators are fitted on a fold while it is cached, and only their narrow scores are
    kept for the end.  Histogram boosters of all folds and settings are grown together
    after that: they cost the passes of one.  So are the logistic regressions of a search.
    """
    y = spec.target
    folded = spread(folded.select(id_, "fold", *spec.features, y), id_)
    boosters = {name: e for name, e in estimators.items() if isinstance(e, HistogramBoosting)}
    linear = {name: e for name, e in estimators.items() if is_ridge(e)}
    linear = linear if len(linear) > 1 else {}
    kept: dict[str, list[DataFrame]] = {name: [] for name in estimators if name not in linear and name not in boosters}
    seconds, held, parts = dict.fromkeys(estimators, 0.0), [], []
    try:
        for fold in range(k):
            prep, train = encode(folded.where(F.col("fold") != fold), spec, id_, resample)
            train = train.persist(StorageLevel.MEMORY_AND_DISK)
            test = prep.transform(folded.where(F.col("fold") == fold)).select(id_, y, "features").persist(StorageLevel.MEMORY_AND_DISK)
            held += [train, test]
            parts.append((train.withColumn("_fold", F.lit(fold)), test))
            for name, estimator in estimators.items():
                if name not in boosters and name not in linear:
                    started = time.time()
                    kept[name].append(_taken(scored(estimator.fit(train), test, id_, y)))
                    seconds[name] += time.time() - started
            if not boosters and not linear:
                for h in (train, test):
                    h.unpersist()
        out = {}
        # boosters that read the same columns share their rows, and their scores are ranked together
        for weight in {_weight_of(e) for e in boosters.values()}:
            together = {name: e for name, e in boosters.items() if _weight_of(e) == weight}
            started = time.time()
            every = parts[0][0]
            for train, _ in parts[1:]:
                every = every.unionByName(train)
            tested = None
            for fold, models in fit_together(every, list(together.values()), group="_fold").items():
                part = margins_together(parts[fold][1], [m.model for m in models])
                tested = part if tested is None else tested.unionByName(part)
            tested = _taken(tested)
            held.append(tested)
            areas = _areas(tested.select(y, F.posexplode("margins").alias("trial", "margin")).select(y, "trial", (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))).alias("score")), y)
            out |= {name: (areas[i], (time.time() - started) / len(together)) for i, name in enumerate(together)}
        if linear:
            started, names = time.time(), list(linear)
            every = parts[0][0]
            for train, _ in parts[1:]:
                every = every.unionByName(train)
            tested = None
            for fold, found in ridges(every, list(linear.values()), "_fold").items():
                part = ridge_scores(parts[fold][1], found)
                tested = part if tested is None else tested.unionByName(part)
            areas = _areas(tested.select(F.col(y), F.posexplode("scores").alias("trial", "score")), y)
            out |= {name: (areas[i], (time.time() - started) / len(linear)) for i, name in enumerate(names)}
        for name, scores in kept.items():
            every = scores[0]
            for part in scores[1:]:
                every = every.unionByName(part)
            out[name] = (_auc(every, y), seconds[name])
        return {name: out[name] for name in estimators}
    finally:
        for part in (*held, *(p for scores in kept.values() for p in scores)):
            part.unpersist()
        folded.unpersist()


def _weight_of(estimator: HistogramBoosting) -> str | None:
    return estimator.getWeightCol() if estimator.isDefined("weightCol") else None


def _taken(scores: DataFrame) -> DataFrame:
    """Scores computed now, while what they come from is cached."""
    scores = scores.persist(StorageLevel.MEMORY_AND_DISK)
    scores.count()
    return scores


def _areas(long: DataFrame, y: str) -> dict[int, float]:
    """ROC-AUC of the scores of each trial, in the passes of one."""
    return {r["trial"]: r["roc_auc"] or 0.0 for r in E.roc_auc_by(long, y, "score", "trial").collect()}  # a row a trial


def _auc(df: DataFrame, y: str) -> float:
    return E.roc_auc(df, y, "score").first()[0] or 0.0


def with_setting(estimator: Estimator, setting: Mapping[str, object], rows: int) -> Estimator:
    """A copy of an estimator with one draw of a search space."""
    plain = {p: v for p, v in setting.items() if p not in ("weighted", "C")}
    if "C" in setting:
        plain["regParam"] = 1.0 / (setting["C"] * max(rows, 1))
    trial = estimator.copy({estimator.getParam(p): v for p, v in plain.items()})
    if setting.get("weighted") is False:
        trial.clear(trial.weightCol)
    return trial


def tune_winner(
    folded: DataFrame, spec: FeatureSpec, id_: str, k: int, name: str, estimator: Estimator, draws: int = SEARCH_DRAWS,
    grid: Mapping[str, Sequence] | None = None, resample: bool = False,
) -> tuple[Estimator, float]:
    """Best of a seeded random draw of settings by cross-validated ROC-AUC."""
    space = grid or GRIDS[name]
    every = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    rows = folded.count() * (k - 1) // k
    trials = {str(i): with_setting(estimator, s, rows) for i, s in enumerate(random.Random(SEED).sample(every, min(draws, len(every))))}
    found = cross_validate(folded, spec, id_, k, trials, resample)
    # of equal trials the first
    best = max(trials, key=lambda n: (found[n][0], -int(n)))
    return trials[best], found[best][0]


# ---------------------------------------------------------------- calibration


def _logit(score: str | Column) -> Column:
    p = F.least(F.greatest(F.col(score) if isinstance(score, str) else score, F.lit(LOGIT_CLIP)), F.lit(1 - LOGIT_CLIP))
    return F.log(p / (F.lit(1.0) - p))


@dataclass
class Calibrator:
    """Maps raw scores to probabilities."""

    method: str
    model: object

    def apply(self, df: DataFrame, score: str = "score") -> DataFrame:
        keep = [c for c in df.columns if c != score]
        if self.method == "isotonic":
            return df.select(*keep, self.model.predict(F.col(score)).alias(score))
        out = self.model.transform(df.withColumn("features", array_to_vector(F.array(_logit(score)))))
        return out.select(*keep, vector_to_array("probability")[1].alias(score))


def _fit_isotonic(df: DataFrame, y: str, score: str) -> Calibrator:
    return Calibrator("isotonic", fit_isotonic(df, y, score))


def _fit_sigmoid(df: DataFrame, y: str, score: str) -> Calibrator:
    points = df.select(array_to_vector(F.array(_logit(score))).alias("features"), F.col(y).cast("double").alias("label"))
    return Calibrator("sigmoid", LogisticRegression(regParam=0.0, maxIter=100).fit(points))


def calibrate_scores(df: DataFrame, y: str, score: str, id_: str) -> Calibrator:
    """Isotonic or sigmoid, whichever has the lower two-fold Brier score.

    Isotonic is only considered with enough rows and positives."""
    counts = class_counts(df, y)
    if sum(counts.values()) >= ISOTONIC_ROWS and counts.get(1, 0) >= ISOTONIC_POSITIVES:
        halves = hashed_rank(df, id_, SEED, grand=True)
        halves = halves.withColumn("half", (F.col("rank") * 2 > F.col("rank_all")).cast("int")).drop("rank", "rank_all")
        halves = halves.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sides = [class_counts(halves.where(F.col("half") == h), y).get(1, 0) for h in (0, 1)]
            if min(sides) > 0:
                brier = {}
                for name, fit in (("isotonic", _fit_isotonic), ("sigmoid", _fit_sigmoid)):
                    tested = None
                    for h in (0, 1):
                        part = fit(halves.where(F.col("half") != h), y, score).apply(halves.where(F.col("half") == h), score)
                        tested = part if tested is None else tested.unionByName(part)
                    error = F.col(score) - F.col(y).cast("double")
                    brier[name] = tested.agg(F.avg(error * error)).first()[0]
                if brier["isotonic"] < brier["sigmoid"]:
                    return _fit_isotonic(df, y, score)
        finally:
            halves.unpersist()
    return _fit_sigmoid(df, y, score)


# ---------------------------------------------------------------- the whole run


@dataclass
class TrainingResult:
    """A fitted winner and what was measured on the way."""

    task: str
    algorithm: str
    model: PipelineModel | ForestModel
    calibrator: Calibrator | None
    threshold: float
    metrics: dict[str, float]
    leaderboard: list[dict]
    rows: dict[str, int]
    features: list[str] = field(default_factory=list)
    validation_holdout: bool = True
    tuned: bool = False

    def metadata(self) -> dict:
        """Training record in the shape ``read_model_metadata`` reads."""
        return {
            "name": f"risk_{self.task}", "task": self.task, "algorithm": self.algorithm, "version": "2.0.0",
            "threshold": self.threshold, "metrics": self.metrics, "features": self.features, "target": SPEC_TARGETS[self.task],
            "pipeline": {**{f"{k}_rows": v for k, v in self.rows.items()}, "hyperparameter_tuning": self.tuned,
                         "calibration": self.calibrator.method if self.calibrator else "none",
                         "threshold_fit": "validation_holdout" if self.validation_holdout else "test_set"},
        }


SPEC_TARGETS = {"churn": "churn_flag", "default": "default_flag", "fraud": "is_fraud"}


def _threshold(task: str, df: DataFrame, y: str) -> float:
    """Cost-aware for fraud, best F1 for the others."""
    job = E.threshold_cost if task == "fraud" else E.threshold_f1
    return float(job(df, y, "score").first()["threshold"])


def train_candidates(
    df: DataFrame, spec: FeatureSpec, id_: str, ts: str | None = None, folds: int = FOLDS,
    tune: bool = True, draws: int = SEARCH_DRAWS, resample: bool | None = None, grids: Mapping[str, Mapping[str, Sequence]] = GRIDS,
    models: Callable[[str], dict[str, Estimator]] = candidates, forest_trees: int = AN.TREES,
) -> TrainingResult:
    """Split, compare candidates out of fold, tune the best, calibrate, pick a
    threshold on the validation part and measure on the test part."""
    y = spec.target
    resample = spec.task in ("default", "fraud") if resample is None else resample
    parts = split_for_training(df, y, id_, ts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _train(parts, spec, y, id_, folds, tune, draws, resample, grids, models, forest_trees)
    finally:
        parts.unpersist()


def _train(parts, spec, y, id_, folds, tune, draws, resample, grids, models, forest_trees) -> TrainingResult:
    train = parts.where(F.col("part") != "test")
    sizes = class_counts(train, y)
    fit_part, val = parts.where(F.col("part") == "fit"), parts.where(F.col("part") == "val")
    sides = (class_counts(fit_part, y), class_counts(val, y))
    holdout = (
        sum(sizes.values()) >= MIN_VALIDATION and len(sizes) == 2 and min(sizes.values()) >= MIN_VALIDATION_CLASS
        and all(len(s) == 2 for s in sides)
    )
    if not holdout:
        fit_part, val = train, parts.where(F.col("part") == "test")
    test = parts.where(F.col("part") == "test")
    k = fold_count(fit_part, y, folds)
    positives = max(sides[0].get(1, 0), 1) if holdout else max(sizes.get(1, 0), 1)
    rest = sum((sides[0] if holdout else sizes).values()) - positives
    board, tried = [], models(spec.task, rest / positives) if models is candidates else models(spec.task)
    for name, (auc, took) in cross_validate(kfold_stratified(fit_part, y, id_, k), spec, id_, k, tried, resample).items():
        board.append({"task": spec.task, "algorithm": name, "cv_roc_auc": round(auc, 4), "training_seconds": round(took, 2)})
    forest = None
    if spec.task == "fraud":  # unsupervised, so it is measured on the test part without folds
        started = time.time()
        forest = fit_forest(fit_part, spec, id_, forest_trees)
        auc = _auc(scored(forest, test, id_, y), y)
        board.append({"task": spec.task, "algorithm": "isolation_forest", "cv_roc_auc": None, "roc_auc": round(auc, 4),
                      "training_seconds": round(time.time() - started, 2)})
    best = max(board, key=lambda r: r["cv_roc_auc"] if r["cv_roc_auc"] is not None else r["roc_auc"])
    unsupervised = best["algorithm"] == "isolation_forest"
    winner, tuning = tried.get(best["algorithm"]), None
    if tune and not unsupervised:
        started, k_search = time.time(), min(SEARCH_FOLDS, k)
        again = kfold_stratified(fit_part, y, id_, k_search, seed=7)
        winner, _ = tune_winner(again, spec, id_, k_search, best["algorithm"], winner, draws, grids[best["algorithm"]], resample)
        tuning = round(time.time() - started, 2)
    model = forest if unsupervised else fit_candidate(fit_part, spec, winner, id_, resample)
    raw_val, raw_test = scored(model, val, id_, y), scored(model, test, id_, y)
    calibrator = calibrate_scores(raw_val, y, "score", id_) if holdout and not unsupervised else None
    adjust = calibrator.apply if calibrator else (lambda d: d)
    threshold = _threshold(spec.task, adjust(raw_val), y)
    final = adjust(raw_test).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        metrics = {k_: v for k_, v in E.evaluate(final, y, "score", id_, threshold).first().asDict().items()}
        if spec.task == "fraud":
            metrics |= E.cost_impact(final, y, "score", threshold).first().asDict()
    finally:
        final.unpersist()
    metrics["cv_roc_auc"], metrics["training_seconds"] = best["cv_roc_auc"], best["training_seconds"]
    if tuning is not None:
        metrics["tuning_seconds"] = tuning
    rows = {r[0]: r[1] for r in parts.groupBy("part").count().collect()}
    sized = {"train": rows.get("fit", 0) if holdout else rows.get("fit", 0) + rows.get("val", 0),
             "validation": rows.get("val", 0) if holdout else 0, "test": rows.get("test", 0)}
    return TrainingResult(spec.task, best["algorithm"], model, calibrator, threshold, metrics, board, sized,
                          list(spec.features), holdout, tuning is not None)


# ---------------------------------------------------------------- explanation


def feature_importance(model: PipelineModel, spec: FeatureSpec, spark) -> DataFrame:
    """Importance, or absolute coefficient, per encoded feature, descending."""
    last = model.stages[-1]
    if isinstance(last, HistogramBoostingModel):
        values = last.importances
    elif hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    else:
        values = abs(last.coefficients.toArray())
    names = encoded_names(model, spec)
    rows = sorted(zip(names, map(float, values)), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def explain_linear(model: PipelineModel, df: DataFrame, spec: FeatureSpec, id_: str) -> DataFrame:
    """Contribution of every encoded feature of a linear model to every row:
    coefficient x (value - mean value), as ``id, feature, contribution``."""
    names, weights = encoded_names(model, spec), model.stages[-1].coefficients.toArray()
    prepared = PipelineModel(stages=model.stages[:-1]).transform(df).select(id_, vector_to_array("features").alias("v"))
    means = prepared.agg(F.array(*[F.avg(F.col("v")[i]) for i in range(len(names))])).scalar()
    cells = F.array(*[
        F.struct(F.lit(n).alias("feature"), (F.lit(float(w)) * (F.col("v")[i] - F.col("m")[i])).alias("contribution"))
        for i, (n, w) in enumerate(zip(names, weights))
    ])
    return prepared.withColumn("m", means).select(id_, F.explode(cells).alias("c")).select(id_, "c.*")


def explain_rows(model: PipelineModel, df: DataFrame, spec: FeatureSpec, id_: str) -> DataFrame:
    """Contribution of every encoded feature to every row, for linear models and trees alike."""
    if hasattr(model.stages[-1], "coefficients"):
        return explain_linear(model, df, spec, id_)
    return explain_trees(model, df, encoded_names(model, spec), id_)


def top_features(contributions: DataFrame) -> DataFrame:
    """Features by mean absolute contribution, the most impactful first."""
    return contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("impact")).orderBy(F.col("impact").desc(), "feature")


def permutation_importance(model: PipelineModel, df: DataFrame, spec: FeatureSpec, id_: str, seed: int = SEED) -> DataFrame:
    """Loss of ROC-AUC when one feature is shuffled among the rows, for any model.

    Values are moved by joining two seeded hash ranks, never by collecting."""
    y = spec.target
    rows = []
    base = _auc(scored(model, df, id_, y), y)
    own = hashed_rank(df, id_, seed)
    for feature in spec.features:
        other = hashed_rank(df.select(id_, F.col(feature).alias("_moved")), id_, f"{seed}-{feature}").select("rank", "_moved")
        mixed = own.join(other, "rank").withColumn(feature, F.col("_moved")).select(*df.columns)
        rows.append((feature, base - _auc(scored(model, mixed, id_, y), y)))
    rows.sort(key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")

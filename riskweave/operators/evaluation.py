"""Metrics of binary scores.

Rows are first counted per distinct score; everything cumulative then runs over
those counts with ``running_totals``, so no task sees all scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arithmetic import mean, safe_divide
from ..session import work_dir
from .ordered import exact_quantiles, following, hashed_rank, running_totals, unit_levels

# Costs, grids and clips of the evaluation.
COST_MISSED, COST_REVIEW = 500.0, 15.0
F1_GRID_PERCENT = range(10, 91, 2)
LOG_CLIP = 1e-6
CURVE_POINTS = 100
CALIBRATION_BINS = 10


def threshold_counts(df: DataFrame, y: str, score: str, threshold: float | Column, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, tn, fn when scores at or above the threshold are flagged."""
    flagged, positive = F.col(score) >= threshold, F.col(y) == 1
    return df.groupBy(*by).agg(
        F.count_if(flagged & positive).alias("tp"),
        F.count_if(flagged & ~positive).alias("fp"),
        F.count_if(~flagged & ~positive).alias("tn"),
        F.count_if(~flagged & positive).alias("fn"),
    )


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1, specificity and base rate; 0 where undefined."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    return counts.select(
        "*",
        safe_divide(tp + tn, n).alias("accuracy"),
        safe_divide(tp, tp + fp).alias("precision"),
        safe_divide(tp, tp + fn).alias("recall"),
        safe_divide(tp * 2, tp * 2 + fp + fn).alias("f1"),
        safe_divide(tn, tn + fp).alias("specificity"),
        safe_divide(tp + fn, n).alias("base_rate"),
    )


def confusion_metrics(df: DataFrame, y: str, score: str, threshold: float = 0.5) -> DataFrame:
    return rates(threshold_counts(df, y, score, threshold))


def score_counts(df: DataFrame, y: str, score: str) -> DataFrame:
    """Rows and positives per distinct score."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("bigint")).alias("pos")
    )


def score_steps(df: DataFrame, y: str, score: str) -> DataFrame:
    """Per distinct score, from the highest: rows and positives so far and in all."""
    return running_totals(
        score_counts(df, y, score),
        {"cum_n": F.col("n"), "cum_pos": F.col("pos")},
        unit_levels(F.col("score"), descending=True),
        [F.col("score").desc()],
        grand=True,
    )


def _big(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def _roc_auc() -> Column:
    negatives = F.col("n") - F.col("pos")
    wins = F.sum((_big(negatives) * _big(F.col("cum_pos") * 2 - F.col("pos"))).cast("decimal(38,0)"))
    pairs = F.sum("pos").cast("double") * F.sum(negatives).cast("double") * 2.0
    return F.try_divide(wins.cast("double"), pairs).alias("roc_auc")


def _pr_auc() -> Column:
    precision = F.col("cum_pos").cast("double") / F.col("cum_n").cast("double")
    gained = F.try_divide(F.col("pos").cast("double"), F.col("cum_pos_all").cast("double"))
    return F.sum(gained * precision).alias("pr_auc")


def _ks() -> Column:
    tpr = F.try_divide(F.col("cum_pos").cast("double"), F.col("cum_pos_all").cast("double"))
    false = F.col("cum_n") - F.col("cum_pos")
    fpr = F.try_divide(false.cast("double"), (F.col("cum_n_all") - F.col("cum_pos_all")).cast("double"))
    return F.greatest(F.max(tpr - fpr), F.lit(0.0)).alias("ks")


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Area under the ROC curve; a tie counts half."""
    return score_steps(df, y, score).agg(_roc_auc())


def roc_auc_by(df: DataFrame, y: str, score: str, by: str) -> DataFrame:
    """`roc_auc` of each group of rows, in the passes of one."""
    counts = df.groupBy(by, F.col(score).alias("score")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("bigint")).alias("pos"))
    totals = {"cum_n": F.col("n"), "cum_pos": F.col("pos")}
    steps = running_totals(counts, totals, unit_levels(F.col("score"), descending=True), [F.col("score").desc()], [by], grand=True)
    return steps.groupBy(by).agg(_roc_auc())


def pr_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Average precision: recall gained times precision reached, summed in steps."""
    return score_steps(df, y, score).agg(_pr_auc())


def ks_statistic(df: DataFrame, y: str, score: str) -> DataFrame:
    """Largest distance between true and false positive rate."""
    return score_steps(df, y, score).agg(_ks())


def ranking_metrics(df: DataFrame, y: str, score: str, steps: DataFrame | None = None) -> DataFrame:
    """ROC-AUC, average precision and KS from one pass over the score counts."""
    return (score_steps(df, y, score) if steps is None else steps).agg(_roc_auc(), _pr_auc(), _ks())


def lift_at(df: DataFrame, y: str, score: str, id_: str, fraction: float = 0.1, steps: DataFrame | None = None) -> DataFrame:
    """Precision among the top fraction of scores over the base rate.

    Only the rows tied at the cut are ranked (in hash order of the id); whole
    scores above it are known from the counts.
    """
    before = F.col("cum_n") - F.col("n")
    size = F.greatest(F.lit(1), F.floor(F.col("cum_n_all") * F.lit(fraction)))
    cut = (score_steps(df, y, score) if steps is None else steps).select("*", size.alias("size")).where(
        (before < F.col("size")) & (F.col("size") <= F.col("cum_n"))
    )
    cut = cut.select(
        F.col("score").alias(score), (F.col("size") - before).alias("take"), "size",
        (F.col("cum_pos") - F.col("pos")).alias("above"), "cum_n_all", "cum_pos_all",
    )
    # exactly one score holds the cut, so the broadcast side is one row
    tied = df.select(id_, y, score).join(F.broadcast(cut), score)
    ranked = hashed_rank(tied, id_, "tie")
    hits = F.sum(F.when(F.col("rank") <= F.col("take"), F.col(y))) + F.max("above")
    base = safe_divide(F.max("cum_pos_all"), F.max("cum_n_all"))
    return ranked.agg(safe_divide(safe_divide(hits, F.max("size")), base).alias("lift"))


def brier_logloss(df: DataFrame, y: str, score: str) -> DataFrame:
    """Brier score and log loss; null unless all scores lie in [0, 1]."""
    s, t = F.col(score), F.col(y).cast("double")
    clipped = F.least(F.greatest(s, F.lit(LOG_CLIP)), F.lit(1 - LOG_CLIP))
    loss = -(t * F.log(clipped) + (F.lit(1.0) - t) * F.log(F.lit(1.0) - clipped))
    valid = (F.min(s) >= 0) & (F.max(s) <= 1)
    return df.agg(
        F.when(valid, F.avg((s - t) * (s - t))).alias("brier"), F.when(valid, F.avg(loss)).alias("log_loss")
    )


def threshold_f1(df: DataFrame, y: str, score: str) -> DataFrame:
    """First threshold of the 0.10 .. 0.90 grid (step 0.02) with the best F1.

    Each row is put in the highest grid cell it reaches; F1 at a threshold is a
    suffix sum over the 42 cells.
    """
    spark = df.sparkSession
    grid = F.array(*[F.lit(p / 100) for p in F1_GRID_PERCENT])
    reached = F.size(F.filter(grid, lambda g: F.col(score) >= g))
    cells = df.groupBy(reached.alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("bigint")).alias("pos")
    )
    slots = spark.range(0, len(F1_GRID_PERCENT) + 1).select(F.col("id").cast("int").alias("cell"))
    suffix = Window.partitionBy(F.lit(0)).orderBy(F.col("cell").desc())
    everything = Window.partitionBy(F.lit(0))
    sums = slots.join(cells, "cell", "left").fillna(0, ["n", "pos"]).select(
        "cell", F.sum("n").over(suffix).alias("flagged"), F.sum("pos").over(suffix).alias("tp"),
        F.sum("pos").over(everything).alias("positives"),
    )
    f1 = safe_divide(F.col("tp") * 2, F.col("flagged") + F.col("positives"))
    at = F.element_at(grid, F.col("cell"))
    graded = sums.where("cell > 0").select(at.alias("threshold"), f1.alias("f1"))
    return graded.agg(
        F.max_by("threshold", F.struct(F.col("f1"), (-F.col("threshold")).alias("first"))).alias("threshold"),
        F.max("f1").alias("f1"),
    )


def threshold_cost(
    df: DataFrame, y: str, score: str, cost_fn: float = COST_MISSED, cost_fp: float = COST_REVIEW
) -> DataFrame:
    """Threshold of least total cost over the distinct scores (lowest on a tie);
    0.5 if flagging nothing is cheaper still."""
    missed = (F.col("cum_pos_all") - F.col("cum_pos")).cast("double") * cost_fn
    alarms = (F.col("cum_n") - F.col("cum_pos")).cast("double") * cost_fp
    costs = score_steps(df, y, score).select("score", (missed + alarms).alias("cost"), "cum_pos_all")
    best = costs.agg(
        F.min_by("score", F.struct("cost", "score")).alias("score"),
        F.min("cost").alias("cost"),
        (F.max("cum_pos_all").cast("double") * cost_fn).alias("nothing"),
    )
    idle = F.col("nothing") < F.col("cost")
    return best.select(
        F.when(idle, F.lit(0.5)).otherwise(F.col("score")).alias("threshold"),
        F.least("cost", "nothing").alias("cost"),
    )


def cost_impact(
    df: DataFrame, y: str, score: str, threshold: float, cost_fn: float = COST_MISSED, cost_fp: float = COST_REVIEW
) -> DataFrame:
    """Expected cost at a threshold against flagging nothing."""
    c = threshold_counts(df, y, score, threshold)
    expected = F.col("fn").cast("double") * cost_fn + F.col("fp").cast("double") * cost_fp
    baseline = (F.col("fn") + F.col("tp")).cast("double") * cost_fn
    return c.select(
        expected.alias("expected_cost"), baseline.alias("baseline_cost"), (baseline - expected).alias("savings")
    )


def _kept_position(idx: Column, size: Column) -> Column:
    """Place of an index among at most ``CURVE_POINTS`` evenly spaced ones, or null.

    The k-th kept index is ``floor(k * (size - 1) / 99)``; the spacing is at
    least one, so an index is kept for at most one k, next to ``idx / spacing``.
    """
    last = CURVE_POINTS - 1
    step = (size - 1).cast("double") / float(last)
    near = F.floor(idx.cast("double") / step)
    found = F.when(idx == size - 1, F.lit(last).cast("bigint"))
    for k in (near, near + 1):
        found = found.when((F.floor(k.cast("double") * step) == idx) & (k < last), k)
    return F.when(size <= CURVE_POINTS, idx).otherwise(found)


def roc_pr_curves(df: DataFrame, y: str, score: str) -> DataFrame:
    """ROC (x = fpr, y = tpr) and PR (x = recall, y = precision) curve points.

    The ROC curve leaves out points on a straight line between their
    neighbours; both are thinned to at most 100 evenly spaced points.
    """
    levels = unit_levels(F.col("score"), descending=True)
    counts = score_counts(df, y, score).withColumn("down", -F.col("score"))
    linked = following(counts, ["n", "pos"], levels, ["down"])
    bend = F.col("next").isNull() | (F.col("next.n") != F.col("n")) | (F.col("next.pos") != F.col("pos"))
    first = F.col("down") == counts.agg(F.min("down")).scalar()
    linked = linked.select("score", "n", "pos", (bend | first).alias("corner"))
    steps = running_totals(
        linked,
        {"cum_n": F.col("n"), "cum_pos": F.col("pos"), "place": F.lit(1).cast("bigint"),
         "turn": F.col("corner").cast("bigint")},
        levels, [F.col("score").desc()], grand=True,
    )
    fpr = safe_divide(F.col("cum_n") - F.col("cum_pos"), F.col("cum_n_all") - F.col("cum_pos_all"))
    tpr = safe_divide("cum_pos", "cum_pos_all")
    turns, places = F.col("turn_all") + 1, F.col("place_all") + 1

    def point(curve: str, when: Column | None, idx: Column, size: Column, x: Column, y_: Column) -> Column:
        p = F.struct(F.lit(curve).alias("curve"), idx.cast("bigint").alias("idx"), size.alias("size"), x.alias("x"), y_.alias("y"))
        return p if when is None else F.when(when, p)

    top = F.col("place") == 1  # the highest score also carries the two fixed end points
    points = F.array(
        point("roc", F.col("corner"), F.col("turn"), turns, fpr, tpr),
        point("roc", top, F.lit(0), turns, F.lit(0.0), F.lit(0.0)),
        point("pr", None, F.col("place_all") - F.col("place"), places, tpr, safe_divide("cum_pos", "cum_n")),
        point("pr", top, F.col("place_all"), places, F.lit(0.0), F.lit(1.0)),
    )
    out = steps.select(F.explode(points).alias("p")).where(F.col("p").isNotNull()).select("p.*")
    out = out.withColumn("position", _kept_position(F.col("idx"), F.col("size"))).where(F.col("position").isNotNull())
    return out.select("curve", F.col("position").cast("int").alias("position"), *[
        F.round(F.col(c).cast("decimal(20,10)"), 4).cast("decimal(10,4)").alias(c) for c in ("x", "y")
    ])


def calibration_curve(df: DataFrame, y: str, score: str, bins: int = CALIBRATION_BINS) -> DataFrame:
    """Quantile bins of the score: mean score against observed rate; empty bins left out."""
    inner = [i / bins for i in range(1, bins)]
    quantiles = exact_quantiles(df.select(score), [score], inner, unit_range=True)
    edges = quantiles.agg(F.array_sort(F.collect_list("value"))).scalar()  # bins - 1 values
    binned = df.groupBy(F.col(score).alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("bigint")).alias("pos")
    ).withColumn("edges", edges)
    binned = binned.withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("s"))))
    n = F.sum("n").cast("double")
    return binned.groupBy("bin").agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("s") * F.col("n").cast("double")) / n).alias("mean_predicted"),
        (F.sum("pos").cast("double") / n).alias("fraction_positive"),
    )


def evaluate(df: DataFrame, y: str, score: str, id_: str, threshold: float) -> DataFrame:
    """The whole metric set as one row.

    The running counts by score are written once and serve ranking metrics and lift.
    """
    from .measures import one_row

    path = work_dir(df.sparkSession, "score-steps")
    made = score_steps(df, y, score)
    made.write.parquet(path)
    steps = df.sparkSession.read.schema(made.schema).parquet(path)
    return one_row(
        confusion_metrics(df, y, score, threshold),
        ranking_metrics(df, y, score, steps),
        lift_at(df, y, score, id_, steps=steps),
        brier_logloss(df, y, score),
    )

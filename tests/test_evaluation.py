import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import evaluation as E

PERFECT = list(zip(range(6), [0, 0, 0, 0, 1, 1], [0.1, 0.2, 0.2, 0.3, 0.8, 0.9]))


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, y int, s double")


def one(df):
    return df.first()[0]


def test_perfect_ranking(spark):
    df = frame(spark, PERFECT)
    c = E.confusion_metrics(df, "y", "s", 0.5).first()
    assert (c["tp"], c["fp"], c["tn"], c["fn"]) == (2, 0, 4, 0) and c["base_rate"] == pytest.approx(1 / 3)
    assert one(E.pr_auc(df, "y", "s")) == 1.0 and one(E.ks_statistic(df, "y", "s")) == 1.0 and one(E.roc_auc(df, "y", "s")) == 1.0
    assert one(E.lift_at(df, "y", "s", "id", 0.34)) == pytest.approx(3.0)


def sample(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.3)
        rows.append((i, y, min(1.0, max(0.0, round(rng.gauss(0.4 + 0.2 * y, 0.2), 2)))))
    return rows


def auc(rows):
    pos, neg = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_against_all_pairs(spark, seed):
    rows = sample(seed)
    df = frame(spark, rows)
    assert one(E.roc_auc(df, "y", "s")) == pytest.approx(auc(rows), rel=1e-12)
    assert one(E.roc_auc(df.withColumn("s", 1 - F.col("s")), "y", "s")) == pytest.approx(1 - auc(rows), rel=1e-9)


def test_cells_sum_to_rows(spark):
    df = frame(spark, sample(3))
    c = E.confusion_metrics(df, "y", "s", 0.45).first()
    assert c["tp"] + c["fp"] + c["tn"] + c["fn"] == 400


def test_f1_threshold_against_grid(spark):
    rows = sample(4)

    def f1(t):
        tp = sum(y and s >= t for _, y, s in rows)
        return 2 * tp / (sum(s >= t for _, _, s in rows) + sum(y for _, y, _ in rows))

    grid = [p / 100 for p in range(10, 91, 2)]
    best = max(grid, key=lambda t: (f1(t), -t))
    assert E.threshold_f1(frame(spark, rows), "y", "s").first()["threshold"] == best


def test_cost_threshold_against_all_scores(spark):
    rows = sample(5)

    def cost(t):
        return 500.0 * sum(y and s < t for _, y, s in rows) + 15.0 * sum((not y) and s >= t for _, y, s in rows)

    best = min(sorted({s for _, _, s in rows}), key=cost)
    got = E.threshold_cost(frame(spark, rows), "y", "s").first()
    assert got["threshold"] == best and got["cost"] == cost(best)


def test_flagging_nothing_can_be_cheapest(spark):
    df = frame(spark, [(0, 0, 0.9), (1, 0, 0.8), (2, 1, 0.1)])
    assert E.threshold_cost(df, "y", "s", cost_fn=1.0, cost_fp=100.0).first()["threshold"] == 0.5


def test_scores_outside_unit_range_have_no_brier(spark):
    df = frame(spark, [(0, 0, -1.0), (1, 1, 3.0)])
    assert E.brier_logloss(df, "y", "s").first()["brier"] is None
    assert one(E.roc_auc(df, "y", "s")) == 1.0


def test_curves_are_whole_when_short(spark):
    out = E.roc_pr_curves(frame(spark, PERFECT), "y", "s").collect()
    roc = [(float(r["x"]), float(r["y"])) for r in sorted(out, key=lambda r: r["position"]) if r["curve"] == "roc"]
    pr = [(float(r["x"]), float(r["y"])) for r in sorted(out, key=lambda r: r["position"]) if r["curve"] == "pr"]
    # increments per distinct score, from the top: (0,1) (0,1) (1,0) (2,0) (1,0)
    assert roc == [(0.0, 0.0), (0.0, 0.5), (0.0, 1.0), (0.25, 1.0), (0.75, 1.0), (1.0, 1.0)]
    assert pr[0] == (1.0, 0.3333) and pr[-1] == (0.0, 1.0) and len(pr) == 6


def test_curves_are_thinned(spark):
    rng = random.Random(8)
    df = frame(spark, [(i, int(rng.random() < 0.5), rng.random()) for i in range(1000)])
    counts = {r["curve"]: r["count"] for r in E.roc_pr_curves(df, "y", "s").groupBy("curve").count().collect()}
    assert counts == {"roc": 100, "pr": 100}


def test_calibration_bins_cover_all_rows(spark):
    bins = E.calibration_curve(frame(spark, sample(6)), "y", "s").collect()
    assert sum(b["n"] for b in bins) == 400 and all(0 <= b["fraction_positive"] <= 1 for b in bins)

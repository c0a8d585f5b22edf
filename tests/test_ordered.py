import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import ordered as O


def test_running_totals_match_a_plain_sort(spark):
    rng = random.Random(3)
    rows = [(i, "ab"[rng.random() < 0.7], rng.choice([0.0, 0.25, 0.250001, rng.random(), 1.0]), rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, g string, u double, v int")
    out = O.running_totals(df, {"total": F.col("v"), "place": F.lit(1)}, O.unit_levels(F.col("u"), descending=True), [F.col("u").desc(), F.col("id")], ["g"], grand=True)
    got = {r["id"]: r for r in out.collect()}
    for g in "ab":
        total = 0
        ordered = sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0]))
        for place, r in enumerate(ordered, 1):
            total += r[3]
            assert (got[r[0]]["total"], got[r[0]]["place"]) == (total, place)
        assert {got[r[0]]["total_all"] for r in ordered} == {total}


def test_following_row(spark):
    rng = random.Random(4)
    values = sorted({rng.random() ** 8 for _ in range(300)})
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "u double, i int")
    got = {r["i"]: r["next"] for r in O.following(df, ["i"], O.unit_levels(F.col("u")), ["u"]).collect()}
    assert all(got[i]["i"] == i + 1 for i in range(len(values) - 1)) and got[len(values) - 1] is None


@pytest.mark.parametrize("spread", [1.0, 1e-7, 1e6])
def test_quantiles(spark, spread):
    rng = np.random.default_rng(7)
    a, b = rng.normal(size=501) * spread + 3, rng.integers(0, 4, 501).astype(float)
    rows = [(float(x), None if i % 10 == 0 else float(y)) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in O.exact_quantiles(df, ["a", "b"], probs).collect()}
    kept = [y for x, y in rows if y is not None]
    for q in probs:
        assert got["a", q] == pytest.approx(np.quantile(a, q), rel=1e-12) and got["b", q] == pytest.approx(np.quantile(kept, q))


def test_quantile_of_one_value(spark):
    df = spark.createDataFrame([(5.0,)] * 3, "a double")
    assert [r["value"] for r in O.exact_quantiles(df, ["a"], [0.5]).collect()] == [5.0]


def test_time_rank_with_a_hot_time(spark):
    rows = [(i, 100 if i % 3 else i * 1000) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, t long")
    got = O.time_rank(df, "t", "id").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 301)) and [r["t"] for r in got] == sorted(t for _, t in rows)


def test_hashed_rank_is_stable(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    a = O.hashed_rank(df, "id", 42, ["y"]).orderBy("id").collect()
    b = O.hashed_rank(df.repartition(7), "id", 42, ["y"]).orderBy("id").collect()
    assert a == b and sorted(r["rank"] for r in a if r["y"] == 1) == list(range(1, 101))


def test_medians_are_exact_and_read_few_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    n = 30_001
    data = [(float(a), float(i % 7), None if i % 3 else float(b), None, float(i < 5)) for i, (a, b) in enumerate(rng.normal(size=(n, 2)))]
    df = spark.createDataFrame(data, "a double, few double, part double, none double, flag double").repartition(6)
    want = {r["column"]: r["value"] for r in O.exact_quantiles(df, df.columns, [0.5]).collect()}
    monkeypatch.setattr(O, "exact_quantiles", lambda *a: pytest.fail("all rows ranked"))
    assert O.exact_medians(df, df.columns) == want
    for k in (1, 2, 3, 4):
        assert O.exact_medians(df.orderBy("a").limit(k), ["a"])["a"] == pytest.approx(float(np.median([r["a"] for r in df.orderBy("a").limit(k).collect()])))
    monkeypatch.undo()
    monkeypatch.setattr(O, "MIDDLE", -0.2)  # ends that miss the middle
    assert O.exact_medians(df, df.columns) == want

import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import preparation as P
from riskweave.operators import velocity as V

RAW = [
    ("T0", 100, 50.0, 101, "visa", 1, 0), ("T1", 200, 30.0, 101, "visa", 1, 0), ("T2", 400, 20.0, 101, "visa", 1, 1),
    ("T3", 900, 500.0, 202, "mastercard", 2, 0), ("T4", 1000, 10.0, 202, "mastercard", 2, 0), ("T5", 1200, 25.0, 202, "mastercard", 2, 0),
]
COLUMNS = "TransactionID string, TransactionDT int, TransactionAmt double, card1 int, card4 string, addr1 int, isFraud int"


def frame(spark, rows, cutoff=None):
    out = P.normalize_fraud_frame(spark.createDataFrame(rows, COLUMNS), cutoff_seconds=cutoff, keep=["TransactionID"])
    return out


def test_fixture(spark):
    out = frame(spark, RAW)
    assert out.columns == ["TransactionID", *P.FRAUD.features, "is_fraud"]
    got = {r["TransactionID"]: r for r in out.collect()}
    assert [got[t]["txn_cnt_1h"] for t in ("T0", "T1", "T2", "T3")] == [1, 2, 3, 1]
    assert got["T2"]["txn_amt_sum_24h"] == 100.0 and round(got["T2"]["txn_amt_std_24h"], 4) == 12.4722
    assert got["T5"]["txn_amt_sum_24h"] == 535.0
    assert got["T0"]["device_type"] == "unknown" and got["T0"]["dist1"] is None and got["T0"]["C1"] is None and got["T0"]["V1"] is None


def test_input_order_does_not_matter(spark):
    a = {r["TransactionID"]: r for r in frame(spark, RAW).collect()}
    b = {r["TransactionID"]: r for r in frame(spark, RAW[::-1]).collect()}
    assert a == b


def test_cutoff(spark):
    got = {r["TransactionID"]: r for r in frame(spark, RAW, cutoff=500.0).collect()}
    assert got["T0"]["txn_cnt_1h"] == 1 and got["T2"]["txn_cnt_1h"] == 3 and got["T2"]["txn_amt_sum_24h"] == 100.0
    assert got["T3"]["txn_cnt_1h"] is None and got["T5"]["txn_amt_std_24h"] is None


def test_repeated_row(spark):
    got = [r["txn_cnt_1h"] for r in frame(spark, [*RAW, RAW[2]]).where("TransactionID = 'T2'").collect()]
    assert sorted(got) == [3, 4]


def brute(rows, windows):
    out = {}
    for rid, key, t, amount in rows:
        if key is None or t is None:
            out[rid] = None
            continue
        seen = [(r, x or 0.0, s) for r, k, s, x in rows if k == key and s is not None and (s < t or (s == t and r <= rid))]
        out[rid] = [[x for r, x, s in seen if s >= t - w] for w in windows]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    """One key holds most rows; equal times, missing keys, times and amounts, times before zero."""
    rng = random.Random(seed)
    rows = []
    for rid in range(400):
        key = None if rng.random() < 0.03 else (1 if rng.random() < 0.6 else rng.randint(2, 5))
        t = None if rng.random() < 0.03 else rng.randint(-200_000, 400_000) // 50 * 50
        if rng.random() < 0.2:
            t = rng.choice([0, 86_400, 82_800, -86_400, 172_800])
        rows.append((rid, key, t, None if rng.random() < 0.1 else round(rng.uniform(0, 500), 2)))
    df = spark.createDataFrame(rows, "rid int, card1 int, t long, amt double")
    out = V.card_velocity(df, micros=F.col("t") * 1_000_000, amount="amt", row_id=["rid"])
    want = brute(rows, (3600, 86400))
    got = {r["rid"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for rid, w in want.items():
        r = got[rid]
        if w is None:
            assert r["txn_cnt_1h"] is None and r["txn_amt_std_24h"] is None
            continue
        hour, day = w
        n = len(day)
        mean = sum(day) / n
        std = (sum((x - mean) ** 2 for x in day) / n) ** 0.5
        assert (r["txn_cnt_1h"], r["txn_cnt_24h"]) == (len(hour), n)
        assert r["txn_amt_sum_24h"] == pytest.approx(sum(day), abs=1e-6) and r["txn_amt_std_24h"] == pytest.approx(std, abs=1e-5)


def test_bucket_length_changes_nothing(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(1, 3), rng.randint(0, 900_000), round(rng.uniform(0, 90), 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "rid int, card1 int, t long, amt double")
    frames = [
        V.trailing_windows(df, "card1", F.col("t") * 1_000_000, ["rid"], "amt", bucket_seconds=b).orderBy("rid").collect()
        for b in (86_400, 100_000, 10**9)
    ]
    assert frames[0] == frames[1] == frames[2]


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_busy_buckets_are_cut(spark, monkeypatch, broadcast):
    """One card holds most rows, a third of them at one moment; ranges of 10 events give what one task gives."""
    monkeypatch.setattr(V, "BROADCAST_SPLITTERS", broadcast)
    monkeypatch.setattr(V, "RANGE_SAMPLES", 4)
    rng = random.Random(6)
    moments = [rng.choice([90_000, rng.randint(0, 300_000), rng.randint(80_000, 95_000)]) for _ in range(900)]
    rows = [(i, 1 if rng.random() < 0.8 else rng.randint(2, 4), t, round(rng.uniform(0, 90), 2)) for i, t in enumerate(moments)]
    df = spark.createDataFrame(rows, "rid int, card1 int, t long, amt double")
    whole, cut = (
        V.trailing_windows(df, "card1", F.col("t") * 1_000_000, ["rid"], "amt", range_events=n) for n in (10**9, 10)
    )
    assert cut.orderBy("rid").collect() == whole.orderBy("rid").collect()


def test_ranges_are_even(spark):
    """A busy bucket is spread: no range holds a large share of its events, also where all share one moment."""
    df = spark.range(4_000).select(
        F.lit("k").alias("_key"), F.lit(0).alias("_bucket"), F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(0).alias("_at"),
        (F.col("id") % 2 + 1).cast("int").alias("_kind"), F.xxhash64("id").alias("_tie"), F.lit(1).cast("long").alias("_n0"),
    )
    out = V._with_ranges(df, ["_key", "_bucket"], F.struct("_at", "_tie"), ["_n0"], 200)
    sizes = [r["count"] for r in out.where("_kind > 0").groupBy("_range").count().collect()]
    assert sum(sizes) == 4_000 and len(sizes) >= 15 and max(sizes) < 600
    heads = {r["_range"]: r["_n0"] for r in out.where("_kind < 0").collect()}
    assert len(heads) == len(sizes) - 1 and max(heads.values()) < 4_000


def test_cutoff_keeps_earlier_values(spark):
    rng = random.Random(9)
    rows = [(i, rng.randint(1, 3), rng.randint(0, 300_000), 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "rid int, card1 int, t long, amt double")
    micros = F.col("t") * 1_000_000
    full = {r["rid"]: r for r in V.card_velocity(df, micros=micros, amount="amt", row_id=["rid"]).collect()}
    cut = V.card_velocity(df, micros=micros, amount="amt", row_id=["rid"], cutoff_micros=150_000 * 1_000_000).collect()
    for r in cut:
        assert (r == full[r["rid"]]) if r["t"] <= 150_000 else (r["txn_cnt_24h"] is None)


def test_absent_columns_give_nulls(spark):
    out = V.card_velocity(spark.createDataFrame([(1,)], "id int"))
    assert tuple(out.first())[1:] == (None, None, None, None)


def test_request_limit(spark):
    rows = [(i, "k", f"2024-01-01 00:00:{i % 60:02d}") for i in range(50)] + [(99, "k", "2024-01-01 00:01:00")]
    df = spark.createDataFrame(rows, "id int, client string, t string").withColumn("ts", F.col("t").cast("timestamp"))
    got = {r["id"]: r for r in V.request_rate_flag(df, "client", "ts", ["id"], limit=45).collect()}
    assert got[44]["prior_requests"] == 44 and not got[44]["limited"] and got[45]["limited"]
    assert got[99]["prior_requests"] == 49  # the request exactly 60 seconds before is outside


def test_requests_of_one_moment_count_each_other(spark):
    rows = [(1, "k", 0), (2, "k", 0), (3, "k", 0), (4, "k", 30), (5, "k", 60), (6, "other", 0), (7, None, 0), (8, "k", None)]
    df = spark.createDataFrame(rows, "id int, client string, s int").withColumn("ts", F.timestamp_seconds("s"))
    got = {r["id"]: (r["prior_requests"], r["limited"]) for r in V.request_rate_flag(df, "client", "ts", ["id"], limit=2).collect()}
    assert got[1] == got[2] == got[3] == (2, True)
    assert got[4] == (3, True) and got[5] == (1, False) and got[6] == (0, False)
    assert got[7] == got[8] == (None, None)


def test_identities_are_not_read_to_count_busy_cards(spark):
    """Busy cards are counted when the frame is built; identities that cannot be read must not matter before the frame is."""
    raw = spark.createDataFrame([(1, "a", 0, 5.0, 0), (2, "a", 60, 7.0, 1)], "TransactionID long, card1 string, TransactionDT long, TransactionAmt double, isFraud int")
    unreadable = spark.range(1).select(F.raise_error(F.concat(F.lit("read "), F.col("id"))).cast("long").alias("TransactionID"), F.lit("m").alias("DeviceType"))
    P.normalize_fraud_frame(raw, unreadable, keep=["TransactionID"])
    known = spark.createDataFrame([(2, "m")], "TransactionID long, DeviceType string")
    got = {r["TransactionID"]: (r["txn_cnt_1h"], r["device_type"]) for r in P.normalize_fraud_frame(raw, known, keep=["TransactionID"]).collect()}
    assert got == {1: (1, "unknown"), 2: (2, "m")}

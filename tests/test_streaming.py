import json
import os
import time

from pyspark.sql import functions as F

from riskweave.sources import read_json_messages
from riskweave.sources.committed import read_committed
from riskweave.streaming import transactions as X
from riskweave.streaming import velocity as V


def message(i, account="ACC-00001", ts="2024-01-01T00:00:00+00:00", amount=10.0, fraud=0):
    return json.dumps({"transaction_id": f"t{i}", "account_id": account, "amount": amount, "merchant": "m", "category": "c", "city": "x",
                       "is_fraud": fraud, "timestamp": ts})


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    time.sleep(0.05)  # files are taken in order of their time


def run(spark, folder, job, tmp_path, start=X.start_files, **kw):
    source = X.accepted(X.decode(read_json_messages(spark, str(folder), stream=True, per_trigger=1)))
    target = str(tmp_path / "out")
    q = start(job(source), target, str(tmp_path / "checkpoint"), once=True, **kw)
    q.awaitTermination()
    if start is X.start_insert_once:
        return read_committed(spark, target, source.schema), q
    return spark.read.parquet(target), q


def test_decode_separates_malformed(spark):
    no_key = json.dumps({"transaction_id": "t", "amount": 1})
    lines = [message(1), "{oops", no_key, "", message(2, fraud=1)]
    decoded = X.decode(spark.createDataFrame([(x,) for x in lines], "data string"))
    good = X.accepted(decoded).orderBy("transaction_id").collect()
    assert [r["transaction_id"] for r in good] == ["t1", "t2"] and [r["is_fraud"] for r in good] == [False, True]
    assert sorted(r["data"] for r in X.rejected(decoded).collect()) == sorted(["{oops", no_key, ""])


def test_repeated_ids_inside_and_across_batches(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.json", [message(1), message(1), message(2)])
    put(folder, "b.json", [message(2), message(3)])
    out, _ = run(spark, folder, lambda d: d, tmp_path, X.start_insert_once)
    assert sorted(r["transaction_id"] for r in out.collect()) == ["t1", "t2", "t3"]


def test_a_retried_batch_counts_once(spark, tmp_path):
    target = str(tmp_path / "t")
    write = X.insert_batch(target, "first")
    rows = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01")], "transaction_id string, transaction_ts string")
    write(rows, 0)
    write(rows.limit(1), 1)
    write(rows, 0)
    assert read_committed(spark, target, rows.schema).count() == 2


def test_a_new_checkpoint_keeps_stored_rows(spark, tmp_path):
    """Batch numbers start anew with a checkpoint; what an earlier one stored stays, and its keys count as seen."""
    folder, target = tmp_path / "in", str(tmp_path / "out")
    put(folder, "a.json", [message(1), message(2)])
    for checkpoint in ("one", "two"):
        source = X.accepted(X.decode(read_json_messages(spark, str(folder), stream=True, per_trigger=1)))
        X.start_insert_once(source, target, str(tmp_path / checkpoint), once=True).awaitTermination()
        put(folder, "b.json", [message(2), message(3)])
    got = read_committed(spark, target, source.schema)
    assert sorted(r["transaction_id"] for r in got.collect()) == ["t1", "t2", "t3"]
    assert got.select("run_id").distinct().count() == 2


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.json", [message(1, ts="2024-01-01T10:00:00+00:00")])
    put(folder, "b.json", [message(2, ts="2024-01-01T10:30:00+00:00")])
    put(folder, "c.json", [message(3, ts="2024-01-01T09:00:00+00:00"), message(4, ts="2024-01-01T10:29:30+00:00")])
    out, _ = run(spark, folder, lambda d: X.tumbling_minute(d, delay="1 minute"), tmp_path, X.start_updates)
    got = X.latest_updates(out, ["minute_bucket"])
    assert tuple(X.late_rows(spark.range(4), got).first()) == (3, 1)


def test_counters(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.json", [message(1), message(2, fraud=1)])
    put(folder, "b.json", [message(3, fraud=1), "bad"])
    out, _ = run(spark, folder, X.counters, tmp_path, X.start_updates, mode="complete")
    assert tuple(X.latest_updates(out, []).first()) == (3, 2)


def test_rolling_window_includes_both_edges(spark):
    rows = [("2024-01-01 00:05:00.000001", 99.0), ("2024-01-02 00:00:00", 99.0), ("2024-01-01 00:00:00", 10.0), ("2024-01-01 00:04:00", 20.0), ("2023-12-31 23:59:59", 99.0)]
    df = spark.createDataFrame(rows, "t string, a double").select(
        F.col("t").cast("timestamp").alias("transaction_ts"), F.col("a").cast("decimal(12,2)").alias("amount"), F.lit(False).alias("is_fraud")
    )
    r = X.rolling_5min(df, "2024-01-01 00:05:00").first()
    assert r["transactions_last_5min"] == 2 and float(r["avg_amount_5min"]) == 15.0


def test_velocity_with_disorder(spark, tmp_path):
    V.enable_state_store(spark)
    folder = tmp_path / "in"
    put(folder, "a.json", [message(2, ts="2024-01-01T01:00:00+00:00", amount=30.0), message(1, ts="2024-01-01T00:30:00+00:00", amount=50.0)])
    put(folder, "b.json", [message(3, ts="2024-01-01T00:50:00+00:00", amount=20.0), message(9, "ACC-2", ts="2024-01-01T01:10:00+00:00")])
    put(folder, "c.json", [message(4, ts="2024-01-02T00:40:00+00:00", amount=5.0)])
    put(folder, "z.json", [message("z", "~", ts="2024-02-01T00:00:00+00:00")])
    out, _ = run(spark, folder, lambda d: V.stream_velocity(d, "2 hours"), tmp_path)
    got = {r["transaction_id"]: r for r in out.collect()}
    assert got["t1"]["txn_cnt_1h"] == 1 and got["t3"]["txn_cnt_1h"] == 2 and got["t2"]["txn_cnt_1h"] == 3
    assert got["t2"]["txn_amt_sum_24h"] == 100.0 and round(got["t2"]["txn_amt_std_24h"], 4) == 12.4722
    assert got["t4"]["txn_cnt_24h"] == 3 and got["t9"]["txn_cnt_24h"] == 1 and got["t4"]["txn_amt_sum_24h"] == 55.0


def test_batches_do_not_grow_with_the_files_of_the_events(spark, tmp_path, monkeypatch):
    """Events in several files are sent in as many more messages files, and a batch takes as many more."""
    from riskweave.plans import streaming_queries as S
    from riskweave.plans.domain import Tables

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    taken, read = [], S.read_json_messages
    monkeypatch.setattr(S, "read_json_messages", lambda s, path, **kw: taken.append(kw.get("per_trigger")) or read(s, path, **kw))
    got = S.stream_late_rows(Tables(spark, str(tmp_path))).first()
    early = spark.read.parquet(str(tmp_path / "events.parquet"))
    first = early.agg(F.min("ts")).first()[0]
    assert taken[0] == 3 and got["ingested"] == early.count()
    assert got["dropped"] == early.where(F.col("ts") < F.lit(first) + F.expr("interval 5 days")).count()
    S.messages(Tables(spark, str(tmp_path)))
    assert taken[-1] == 6


def test_velocity_keeps_a_block_of_rows_in_an_entry_of_state():
    import numpy as np
    import pandas as pd

    rows = pd.DataFrame({"us": [1, 2, 5], "transaction_id": ["a", "b", "ü"], "cents": [-3, 2**62, 0], "waiting": [True, False, True]})
    back = V._unpacked([V._packed(rows.iloc[:2]), V._packed(rows.iloc[2:])])
    assert back.to_dict("list") == rows.to_dict("list")
    us = np.array([0, 1, 2])
    small, big = (V.window_features(us, np.array(c, np.int64), np.array([2])) for c in ([100, 200, 600], [10**17, 2 * 10**17, 6 * 10**17]))
    assert small["txn_amt_sum_24h"][0] == 9.0 and abs(big["txn_amt_std_24h"][0] / small["txn_amt_std_24h"][0] - 1e15) < 1.0


def test_velocity_of_an_account_with_several_timers_of_one_moment(spark, tmp_path):
    """The account's rows came in batches of falling time; the last watermark passes all of them, and the day after, at once."""
    V.enable_state_store(spark)
    folder = tmp_path / "in"
    put(folder, "a.json", [message(1, ts="2024-01-05T00:00:00+00:00", amount=3.0)])
    put(folder, "b.json", [message(2, ts="2024-01-04T23:00:00+00:00", amount=4.0)])
    put(folder, "c.json", [message(3, ts="2024-01-05T00:30:00+00:00", amount=5.0)])
    put(folder, "z.json", [message("z", "~", ts="2024-03-01T00:00:00+00:00")])
    out, _ = run(spark, folder, lambda d: V.stream_velocity(d, "12 days"), tmp_path)
    got = {r["transaction_id"]: (r["txn_cnt_1h"], r["txn_cnt_24h"], r["txn_amt_sum_24h"]) for r in out.collect()}
    assert got == {"t2": (1, 1, 4.0), "t1": (2, 2, 7.0), "t3": (2, 3, 12.0)}


def test_velocity_answers_a_timer_without_rows():
    """State written by an earlier version may hold several timers of an account: those after the first find nothing."""
    class Empty:
        def get(self):
            return iter(())

    class Now:
        def getCurrentWatermarkInMs(self):
            return 10**12

    processor = V._Velocity()
    processor.rows = Empty()
    assert list(processor.handleExpiredTimer(("a",), Now(), None)) == []

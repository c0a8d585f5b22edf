"""Streaming jobs run to completion over messages made from the events table,
and the batch forms of the monitoring views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import work_dir
from ..sources import read_json_messages
from ..sources.committed import read_committed
from ..streaming import transactions as X
from ..streaming import velocity as V
from .registry import query
from .window_queries import VELOCITY_OUT, velocity_sql

SLICES = 4
NOON = "2024-01-20 12:00:00"
DELAY = "12 days"


def payload(rows):
    """One JSON text per transaction, as a producer sends it."""
    at = F.date_format(F.col("transaction_ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return F.to_json(F.struct(
        "transaction_id", "account_id", "amount", "merchant", "category", "city",
        F.col("is_fraud").cast("int").alias("is_fraud"), at.alias("timestamp"),
    )).alias("value")


def write_messages(t, duplicates: bool = False, bad: bool = False, flush: bool = False, late: bool = False) -> str:
    """Message files in time order: the events, cut into slices of their period."""
    path = work_dir(t.spark, "messages")
    rows = t.stream_txns()
    k = F.substring_index("transaction_id", "-", -1).cast("bigint")
    span = rows.agg(F.min("transaction_ts").alias("lo"), F.max("transaction_ts").alias("hi")).first()
    step = (span["hi"] - span["lo"]) / SLICES
    files = files_at_once(t)
    edges = [F.lit(span["lo"] + step * i).cast("timestamp_ntz") for i in range(SLICES)] + [F.lit(span["hi"]).cast("timestamp_ntz")]
    for i in range(SLICES):
        lo, hi = edges[i], edges[i + 1]
        ts = F.col("transaction_ts")
        mine = rows.where((ts >= lo) & ((ts <= hi) if i == SLICES - 1 else (ts < hi)))
        text = mine.select(payload(mine))
        if duplicates:
            before = rows.where((k % 5 == 0) & (ts < lo)).select(payload(rows))
            twice = mine.where(k % 3 == 0).select(payload(mine))
            text = text.unionByName(before).unionByName(twice)
        if bad:
            text = text.unionByName(mine.where(k % 10 == 0).select(F.concat(F.lit('{"transaction_id": "'), "transaction_id").alias("value")))
            text = text.unionByName(mine.where(k % 10 == 1).select(F.to_json(F.struct("transaction_id", "account_id")).alias("value")))
        if late:  # a slice is a batch then, so that the late rows come in one of their own
            text = text.repartition(files)
        text.write.mode("append").text(path)
    if late:
        early = rows.where(F.col("transaction_ts") < F.lit(span["lo"]).cast("timestamp_ntz") + F.expr("interval 5 days"))
        early.select(payload(early)).coalesce(1).write.mode("append").text(path)
    if flush:
        last = rows.orderBy(F.col("transaction_ts").desc()).limit(1).withColumns({
            "account_id": F.lit("~flush"), "transaction_id": F.lit("~flush"),
            "transaction_ts": F.col("transaction_ts") + F.expr("interval 60 days"),
        })
        last.select(payload(last)).write.mode("append").text(path)
    return path


def files_at_once(t) -> int:
    """Files that the producers write at a time, one a partition of the events.  A batch takes so many
    times more files as they are, so that the number of batches does not grow with the table."""
    return max(1, t.stream_txns().rdd.getNumPartitions())


def messages(t, **kind):
    return read_json_messages(t.spark, write_messages(t, **kind), stream=True, per_trigger=2 * files_at_once(t))


def finish(start, df, t, name: str, **kw) -> str:
    """Run a stream over everything available; returns the sink's path."""
    target = work_dir(t.spark, name)
    q = start(df, target, work_dir(t.spark, f"{name}-checkpoint"), once=True, **kw)
    q.awaitTermination()
    return target


def naive(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


TXN_COLUMNS = ["transaction_id", "account_id", "amount", "merchant", "category", "city", "is_fraud", "transaction_ts"]


@query("stream_decode", "stream_txns", "SELECT * FROM stream_txns")
def stream_decode(t):
    good = X.accepted(X.decode(messages(t, bad=True)))
    out = t.spark.read.parquet(finish(X.start_files, good, t, "decoded"))
    return out.withColumn("transaction_ts", naive("transaction_ts"))


@query("stream_dead_letters", "", """
 SELECT data, count(*) AS n FROM (SELECT '{"transaction_id": "t-'||CAST(event_id AS VARCHAR) AS data FROM events WHERE event_id%10=0
  UNION ALL SELECT '{"transaction_id":"t-'||CAST(event_id AS VARCHAR)||'","account_id":"ACC-'||lpad(CAST(user_id AS VARCHAR),5,'0')||'"}' FROM events WHERE event_id%10=1) GROUP BY 1""")
def stream_dead_letters(t):
    bad = X.rejected(X.decode(messages(t, bad=True)))
    return t.spark.read.parquet(finish(X.start_files, bad, t, "dead")).groupBy("data").agg(F.count(F.lit(1)).alias("n"))


@query("stream_insert_once", "stream_txns", "SELECT * FROM stream_txns")
def stream_insert_once(t):
    good = X.accepted(X.decode(messages(t, duplicates=True)))
    out = read_committed(t.spark, finish(X.start_insert_once, good, t, "inserted"), good.schema)
    return out.withColumn("transaction_ts", naive("transaction_ts")).select(*TXN_COLUMNS)


@query("stream_dedup_watermark", "stream_txns", "SELECT * FROM stream_txns")
def stream_dedup_watermark(t):
    good = X.once_within(X.accepted(X.decode(messages(t, duplicates=True))), "31 days")
    out = t.spark.read.parquet(finish(X.start_files, good, t, "once"))
    return out.withColumn("transaction_ts", naive("transaction_ts")).select(*TXN_COLUMNS)


@query("stream_counters", "stream_txns", "SELECT count(*) AS ingested, count(*) FILTER (WHERE is_fraud) AS fraud_detected FROM stream_txns")
def stream_counters(t):
    totals = X.counters(X.accepted(X.decode(messages(t, bad=True))))
    log = t.spark.read.parquet(finish(X.start_updates, totals, t, "counters", mode="complete"))
    return X.latest_updates(log, [])


def _avg2(total: str, n: str) -> str:
    return f"CAST(((2*CAST({total}*100 AS HUGEINT)+CAST({n} AS HUGEINT))//(2*CAST({n} AS HUGEINT)))::DECIMAL(18,0)/100 AS DECIMAL(38,2))"


# the latest transaction before noon of a day in the middle: the windows before it hold rows, and later rows exist
NOW = f"(SELECT max(transaction_ts) FROM stream_txns WHERE transaction_ts<=TIMESTAMP '{NOON}')"


def now_of(t) -> str:
    ts = F.col("transaction_ts")
    return str(t.stream_txns().where(ts <= F.lit(NOON).cast("timestamp_ntz")).agg(F.max(ts)).first()[0])


MINUTES = f"""SELECT date_trunc('minute', transaction_ts) AS minute_bucket, count(*) AS total_transactions, count(*) FILTER (WHERE is_fraud) AS fraud_count,
  {_avg2('sum(amount)', 'count(amount)')} AS avg_amount, sum(amount)::DECIMAL(38,2) AS total_amount FROM stream_txns {{where}} GROUP BY 1"""


@query("tumbling_minute", "stream_txns", MINUTES.format(where=f"WHERE transaction_ts BETWEEN {NOW}-INTERVAL 2 HOUR AND {NOW}"))
def tumbling_minute(t):
    return X.tumbling_minute(t.stream_txns(), now=now_of(t)).withColumn("minute_bucket", naive("minute_bucket"))


@query("tumbling_minute_stream", "stream_txns", MINUTES.format(where=""))
def tumbling_minute_stream(t):
    windows = X.tumbling_minute(X.accepted(X.decode(messages(t))), delay=DELAY)
    log = t.spark.read.parquet(finish(X.start_updates, windows, t, "minutes"))
    return X.latest_updates(log, ["minute_bucket"]).withColumn("minute_bucket", naive("minute_bucket"))


@query("rolling_5min", "stream_txns", f"""
 SELECT {NOW} AS window_end, count(*) AS transactions_last_5min, count(*) FILTER (WHERE is_fraud) AS fraud_last_5min,
  {_avg2('sum(amount)', 'count(amount)')} AS avg_amount_5min FROM stream_txns WHERE transaction_ts BETWEEN {NOW}-INTERVAL 5 MINUTE AND {NOW}""")
def rolling_5min(t):
    return X.rolling_5min(t.stream_txns(), now_of(t)).withColumn("window_end", naive("window_end"))


SLIDING = f"""SELECT w AS window_end, count(*) AS total_transactions, count(*) FILTER (WHERE is_fraud) AS fraud_count,
  {_avg2('sum(amount)', 'count(amount)')} AS avg_amount
 FROM (SELECT *, date_trunc('minute', transaction_ts)+to_minutes(i) AS w FROM stream_txns, (SELECT unnest(range(1,6)) AS i)) GROUP BY 1"""


@query("sliding_5min", "stream_txns", SLIDING)
def sliding_5min(t):
    return X.sliding_5min(t.stream_txns()).withColumn("window_end", naive("window_end"))


@query("sliding_5min_stream", "stream_txns", SLIDING)
def sliding_5min_stream(t):
    windows = X.sliding_5min(X.accepted(X.decode(messages(t))), delay=DELAY)
    log = t.spark.read.parquet(finish(X.start_updates, windows, t, "sliding"))
    return X.latest_updates(log, ["window_end"]).withColumn("window_end", naive("window_end"))


@query("stream_alerts", "stream_txns", "SELECT transaction_id, account_id, amount, merchant, transaction_ts FROM stream_txns WHERE is_fraud")
def stream_alerts(t):
    found = X.alerts(X.accepted(X.decode(messages(t))))
    out = t.spark.read.parquet(finish(X.start_files, found, t, "alerts"))
    return out.select("transaction_id", "account_id", "amount", "merchant", naive("transaction_ts"))


STREAM_ROWS = """WITH rows_ AS (SELECT transaction_id AS rid, account_id AS card1, transaction_ts AS ts, amount AS amt FROM stream_txns)"""


@query("stream_velocity", "stream_txns", velocity_sql(STREAM_ROWS, "(b.ts<a.ts OR b.rid<=a.rid)", "ts IS NOT NULL") + f"""
 SELECT r.rid AS transaction_id, r.card1 AS account_id, r.ts AS transaction_ts, {VELOCITY_OUT} FROM rows_ r LEFT JOIN agg USING (rid)""")
def stream_velocity(t):
    V.enable_state_store(t.spark)
    good = X.accepted(X.decode(messages(t, flush=True)))
    made = V.stream_velocity(good, DELAY)
    out = t.spark.read.parquet(finish(X.start_files, made, t, "velocity"))
    return out.where(F.col("account_id") != "~flush").withColumn("transaction_ts", naive("transaction_ts"))


@query("stream_late_rows", "stream_txns", """
 SELECT (SELECT count(*) FROM stream_txns) AS ingested,
  (SELECT count(*) FROM stream_txns WHERE transaction_ts<(SELECT min(transaction_ts) FROM stream_txns)+INTERVAL 5 DAY) AS dropped""")
def stream_late_rows(t):
    """The first five days are sent once more at the end, when the watermark is past them
    (rows are tested against the watermark of two batches before)."""
    path = write_messages(t, late=True)
    windows = X.tumbling_minute(X.accepted(X.decode(read_json_messages(t.spark, path, stream=True, per_trigger=files_at_once(t)))), delay=DELAY)
    log = X.latest_updates(t.spark.read.parquet(finish(X.start_updates, windows, t, "late")), ["minute_bucket"])
    return X.late_rows(X.accepted(X.decode(read_json_messages(t.spark, path))), log)

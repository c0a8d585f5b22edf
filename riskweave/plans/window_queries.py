"""Windows, velocity and the customer feature store."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning as K
from ..operators import features as FS
from ..operators import velocity as V
from ..operators.windows import latest_bucket, latest_per_key
from .registry import query

ASOF = "2024-01-25 00:00:00"


def velocity_sql(rows: str, before: str, cutoff: str = "TRUE") -> str:
    """Windows by self-join: every pair (row, earlier row of the card) within 24 hours."""
    return f"""
 {rows}, pairs AS (SELECT a.rid, a.ts, b.ts AS bts, CAST(coalesce(b.amt,0)*100 AS HUGEINT) AS u FROM rows_ a JOIN rows_ b
   ON a.card1=b.card1 AND b.ts>=a.ts-INTERVAL 24 HOUR AND b.ts<=a.ts AND {before} WHERE a.{cutoff}),
 agg AS (SELECT rid, count(*) FILTER (WHERE bts>=ts-INTERVAL 1 HOUR) AS n1, count(*) AS n, sum(u) AS s, sum(u*u) AS q FROM pairs GROUP BY rid)"""


VELOCITY_OUT = """n1 AS txn_cnt_1h, n AS txn_cnt_24h, s::DOUBLE/100 AS txn_amt_sum_24h,
  sqrt((n*q-s*s)::DOUBLE)/n::DOUBLE/100 AS txn_amt_std_24h"""


def card_rows(t):
    """Transactions with some missing cards, times and amounts."""
    k = F.col("transaction_id")
    return t.txns().select(
        k.alias("rid"), F.when(k % 101 != 0, F.col("card1")).alias("card1"),
        F.when(k % 103 != 0, F.col("transaction_dt")).alias("ts"),
        F.when(k % 11 != 0, F.col("transaction_amt")).alias("amt"),
    )


CARD_ROWS = """WITH rows_ AS (SELECT transaction_id AS rid, CASE WHEN transaction_id%101<>0 THEN card1 END AS card1,
  CASE WHEN transaction_id%103<>0 THEN transaction_dt END AS ts, CASE WHEN transaction_id%11<>0 THEN transaction_amt END AS amt FROM txns)"""


@query("velocity_window", "txns", velocity_sql(CARD_ROWS, "(b.ts<a.ts OR b.rid<=a.rid)", "ts IS NOT NULL") + f"""
 SELECT r.rid, {VELOCITY_OUT} FROM rows_ r LEFT JOIN agg USING (rid)""")
def velocity_window(t):
    out = V.card_velocity(card_rows(t), micros=V.micros_of(F.col("ts")), amount="amt", row_id=["rid"])
    return out.select("rid", *V.VELOCITY_COLUMNS)


LEDGER_ROWS = """WITH rows_ AS (SELECT order_id*10+line_id AS rid, card1, transaction_dt AS ts, transaction_amt AS amt FROM ledger)"""


@query("velocity_window_ties", "ledger", velocity_sql(LEDGER_ROWS, "(b.ts<a.ts OR b.rid<=a.rid)", "ts IS NOT NULL") + f"""
 SELECT r.rid, {VELOCITY_OUT} FROM rows_ r LEFT JOIN agg USING (rid)""")
def velocity_window_ties(t):
    rows = K.dedup_keys(t.ledger_raw(), ["order_id", "line_id"], ["part_id", "card1", "transaction_dt", "transaction_amt"])
    rows = rows.withColumn("rid", F.col("order_id") * 10 + F.col("line_id"))
    out = V.card_velocity(rows, micros=V.micros_of(F.col("transaction_dt")), row_id=["rid"])
    return out.select("rid", *V.VELOCITY_COLUMNS)


@query("velocity_window_dense", "txns", velocity_sql(CARD_ROWS, "(b.ts<a.ts OR b.rid<=a.rid)", "ts IS NOT NULL") + f"""
 SELECT r.rid, {VELOCITY_OUT} FROM rows_ r LEFT JOIN agg USING (rid)""")
def velocity_window_dense(t):
    """The same windows with every card and day of more than 64 events cut into ranges."""
    out = V.trailing_windows(card_rows(t), "card1", V.micros_of(F.col("ts")), ["rid"], "amt", range_events=64)
    return out.select("rid", *V.VELOCITY_COLUMNS)


@query("velocity_cutoff", "txns", velocity_sql(CARD_ROWS, "(b.ts<a.ts OR b.rid<=a.rid)", f"ts<=TIMESTAMP '{ASOF}'") + f"""
 SELECT r.rid, {VELOCITY_OUT} FROM rows_ r LEFT JOIN agg USING (rid)""")
def velocity_cutoff(t):
    limit = F.unix_micros(F.lit(ASOF).cast("timestamp_ntz").cast("timestamp"))
    out = V.card_velocity(
        card_rows(t), micros=V.micros_of(F.col("ts")), amount="amt", row_id=["rid"], cutoff_micros=limit
    )
    return out.select("rid", *V.VELOCITY_COLUMNS)


@query("latest_per_key", "predictions", """
 SELECT customer_id, task, prediction_id, prediction_score, created_at FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, task
  ORDER BY created_at DESC, prediction_id DESC) AS rn FROM predictions) WHERE rn=1""")
def latest_prediction(t):
    return latest_per_key(t.predictions(), ["customer_id", "task"], "created_at", "prediction_id").select(
        "customer_id", "task", "prediction_id", "prediction_score", "created_at"
    )


@query("latest_bucket", "stream_txns", """
 SELECT date_trunc('minute', transaction_ts) AS bucket, count(*) AS transactions, count(*) FILTER (WHERE is_fraud) AS fraud
 FROM stream_txns GROUP BY 1 ORDER BY 1 DESC LIMIT 1""")
def latest_minute(t):
    minutes = t.stream_txns().groupBy(F.date_trunc("minute", "transaction_ts").cast("timestamp_ntz").alias("bucket")).agg(
        F.count(F.lit(1)).alias("transactions"), F.count_if("is_fraud").alias("fraud")
    )
    return latest_bucket(minutes, "bucket", ["transactions", "fraud"])


@query("request_rate_flag", "", """
 SELECT event_id, count(*) OVER (PARTITION BY k ORDER BY us RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW)-1 AS prior_requests,
  count(*) OVER (PARTITION BY k ORDER BY us RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW)-1>=2 AS limited
 FROM (SELECT event_id, event_type AS k, epoch_us(ts) AS us FROM events)""")
def request_rate_flag(t):
    # the test stream is far slower than a busy service: a limit of 2 per minute exercises both outcomes
    return V.request_rate_flag(t.raw("events"), "event_type", "ts", ["event_id"], limit=2).select(
        "event_id", "prior_requests", "limited"
    )


LATEST_P = """latest AS (SELECT customer_id, task, prediction_score FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, task
   ORDER BY created_at DESC, prediction_id DESC) AS rn FROM predictions) WHERE rn=1),
 lf AS (SELECT customer_id, count(*) AS loan_count_total, count(*) FILTER (WHERE default_flag=1) AS default_count,
  sum(loan_amount)::DOUBLE/count(*) AS avg_loan_amount, sum(dti)::DOUBLE/count(*) AS dti_latest,
  sum(credit_score)::DOUBLE/count(*) AS credit_score_latest, max(issue_date) AS last_loan_date FROM loans GROUP BY 1),
 ff AS (SELECT customer_id, count(*) AS fraud_count_90d, count(*) FILTER (WHERE is_fraud=1) AS fraud_total,
  sum(transaction_amt)::DOUBLE/count(*) AS avg_monthly_spend FROM txns {where} GROUP BY 1)"""
FEATURES_SQL = """
 SELECT c.c_custkey AS customer_id, DATE '{asof}' AS feature_asof_date,
  coalesce(round(CAST(0.4::DOUBLE*fraud_total::DOUBLE/greatest(fraud_count_90d,1)::DOUBLE+0.3::DOUBLE*d.prediction_score+0.3::DOUBLE*h.prediction_score AS DECIMAL(20,10)),4)::DOUBLE,0) AS customer_risk_score,
  coalesce(avg_monthly_spend,0) AS avg_monthly_spend, coalesce(fraud_count_90d,0) AS fraud_count_90d, coalesce(fraud_total,0) AS fraud_total,
  coalesce(loan_count_total,0) AS loan_count_total, coalesce(default_count,0) AS default_count, coalesce(avg_loan_amount,0) AS avg_loan_amount,
  coalesce(d.prediction_score,0) AS default_probability, coalesce(h.prediction_score,0) AS churn_probability,
  coalesce(dti_latest,0) AS dti_latest, coalesce(credit_score_latest,0) AS credit_score_latest, last_loan_date
 FROM customer c LEFT JOIN lf ON lf.customer_id=c.c_custkey LEFT JOIN ff ON ff.customer_id=c.c_custkey
 LEFT JOIN latest d ON d.customer_id=c.c_custkey AND d.task='default' LEFT JOIN latest h ON h.customer_id=c.c_custkey AND h.task='churn'"""


def _customers(t):
    return t.raw("customer").select(F.col("c_custkey").alias("customer_id"))


@query("customer_features", "loans txns predictions", "WITH " + LATEST_P.format(where="") + FEATURES_SQL.format(asof=ASOF[:10]))
def customer_features(t):
    return FS.customer_features(_customers(t), t.loans_core(), t.txns(), t.predictions(), ASOF[:10])


# orders as card payments: their dates span years, so a window of 90 days leaves most of them out
PAYMENTS = """txns AS (SELECT o_custkey AS customer_id, o_orderdate::TIMESTAMP AS transaction_dt, CAST(o_totalprice AS DECIMAL(12,2)) AS transaction_amt,
 CAST(o_orderkey%29=0 AS INTEGER) AS is_fraud FROM orders)"""
LATE = "1996-06-30"


@query("customer_features_90d", "loans predictions", f"WITH {PAYMENTS}, " + LATEST_P.format(
    where=f"WHERE transaction_dt>TIMESTAMP '{LATE}'-INTERVAL 90 DAY AND transaction_dt<=TIMESTAMP '{LATE}'") + FEATURES_SQL.format(asof=LATE))
def customer_features_90d(t):
    payments = t.raw("orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("transaction_dt"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("transaction_amt"), (F.col("o_orderkey") % 29 == 0).cast("int").alias("is_fraud"),
    )
    return FS.customer_features(_customers(t), t.loans_core(), payments, t.predictions(), LATE, window_days=FS.WINDOW_DAYS)


@query("join_customer_360", "loans txns predictions subscribers", "WITH " + LATEST_P.format(where="") + """
 SELECT c.c_custkey AS customer_id, coalesce(loan_count_total,0) AS loan_count_total, coalesce(fraud_count_90d,0) AS fraud_count_90d,
  coalesce(s.monthly_charges,0)::DECIMAL(8,2) AS monthly_charges, coalesce(d.prediction_score,0) AS default_probability,
  coalesce(h.prediction_score,0) AS churn_probability
 FROM customer c LEFT JOIN lf ON lf.customer_id=c.c_custkey LEFT JOIN ff ON ff.customer_id=c.c_custkey
 LEFT JOIN subscribers s ON s.customer_id=c.c_custkey
 LEFT JOIN latest d ON d.customer_id=c.c_custkey AND d.task='default' LEFT JOIN latest h ON h.customer_id=c.c_custkey AND h.task='churn'""")
def join_customer_360(t):
    from ..operators.joins import customer_360

    zero = ["loan_count_total", "fraud_count_90d", "monthly_charges", "default_probability", "churn_probability"]
    sides = [
        FS.loan_features(t.loans_core()).select("customer_id", "loan_count_total"),
        FS.transaction_features(t.txns()).select("customer_id", "fraud_count_90d"),
        t.subscribers().select("customer_id", "monthly_charges"),
        FS.latest_scores(t.predictions()),
    ]
    return customer_360(_customers(t), sides, "customer_id", zero)

"""KPI sets (one row each) and monitoring aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arithmetic import composite_risk, mean
from ..operators import evaluation as E
from ..operators import measures as M
from .registry import query

REPORT_DATE = "2001-08-01"


@query("kpi_churn", "subscribers", """
 SELECT customers AS total_customers, churned AS churned_customers, rate AS churn_rate, 1.0::DOUBLE-rate AS retention_rate,
  mon AS avg_monthly_charges, ten AS avg_tenure, mon*ten AS customer_lifetime_value,
  churned::DOUBLE*mon*ten AS revenue_at_risk, churned::DOUBLE*mon*ten/(mon*ten*customers::DOUBLE) AS churn_impact_pct, revenue AS total_revenue
 FROM (SELECT count(customer_id) AS customers, count(*) FILTER (WHERE churn_flag=1) AS churned,
  sum(churn_flag)::DOUBLE/count(customer_id) AS rate, sum(monthly_charges)::DOUBLE/count(monthly_charges) AS mon,
  sum(tenure)::DOUBLE/count(tenure) AS ten, sum(total_charges) AS revenue FROM subscribers)""")
def kpi_churn(t):
    return M.totals(t.subscribers(), M.churn_measures())


@query("kpi_loans", "loans", """
 SELECT count(loan_id) AS total_loans, count(*) FILTER (WHERE default_flag=1) AS default_count,
  count(*) FILTER (WHERE default_flag=1)::DOUBLE/count(loan_id) AS default_rate,
  1.0::DOUBLE-count(*) FILTER (WHERE default_flag=1)::DOUBLE/count(loan_id) AS approval_rate,
  sum(interest_rate)::DOUBLE/count(*) AS avg_interest_rate, sum(loan_amount)::DOUBLE/count(*) AS avg_loan_amount,
  sum(loan_amount) AS loan_volume, sum(CASE WHEN default_flag=1 THEN loan_amount END) AS risk_exposure,
  sum(dti)::DOUBLE/count(*) AS avg_dti, count(*) FILTER (WHERE default_flag=1)::DOUBLE/count(*) AS high_risk_loan_rate FROM loans""")
def kpi_loans(t):
    return M.totals(t.loans_core(), M.loan_measures())


@query("kpi_transactions", "txns", """
 SELECT count(*) AS total_transactions, count(*) FILTER (WHERE is_fraud=1) AS fraud_cases,
  sum(is_fraud)::DOUBLE/count(transaction_id) AS fraud_rate, sum(transaction_amt)::DOUBLE/count(*) AS avg_transaction_amount,
  sum(CASE WHEN is_fraud=1 THEN transaction_amt END) AS total_fraud_amount, sum(transaction_amt) AS transaction_volume,
  sum(CASE WHEN is_fraud=1 THEN transaction_amt END)::DOUBLE/sum(transaction_amt)::DOUBLE AS fraud_loss_pct,
  sum(CASE WHEN is_fraud=1 THEN transaction_amt END)::DOUBLE/count(*) FILTER (WHERE is_fraud=1) AS fraud_severity,
  count(*) FILTER (WHERE is_fraud<>1) AS legit_transactions FROM txns""")
def kpi_transactions(t):
    return M.totals(t.txns(), M.transaction_measures())


@query("kpi_stream", "stream_txns", """
 SELECT count(*) AS total_stream_transactions, count(*) FILTER (WHERE is_fraud) AS stream_fraud_cases,
  count(*) FILTER (WHERE is_fraud)::DOUBLE/count(*) AS stream_fraud_rate, sum(amount) AS stream_total_amount,
  sum(amount)::DOUBLE/count(*) AS stream_avg_amount, sum(CASE WHEN is_fraud THEN amount END) AS stream_fraud_amount FROM stream_txns""")
def kpi_stream(t):
    return M.totals(t.stream_txns(), M.stream_measures())


RUN_MS = "sum((epoch_us(completed_at)-epoch_us(started_at))//1000)::DOUBLE/count(completed_at)"


@query("kpi_etl", "runs", f"""
 SELECT count(*) AS total_runs, count(*) FILTER (WHERE upper(trim(status))='SUCCESS') AS successful_runs,
  count(*) FILTER (WHERE upper(trim(status))='FAILED') AS failed_runs,
  count(*) FILTER (WHERE upper(trim(status))='SUCCESS')::DOUBLE/count(*) AS etl_success_rate,
  count(*) FILTER (WHERE upper(trim(status))='SUCCESS')::DOUBLE/count(*)*100 AS refresh_health_score,
  sum(records_read)::BIGINT AS total_records_processed, {RUN_MS}/1000 AS avg_run_duration_seconds,
  {RUN_MS}/1000/60 AS avg_run_duration_minutes FROM runs""")
def kpi_etl(t):
    return M.totals(t.runs(), M.run_measures())


@query("kpi_predictions", "predictions", """
 SELECT count(prediction_id) AS total_predictions, round(sum(prediction_score)/count(prediction_score),9) AS avg_confidence,
  sum(inference_ms)::DOUBLE/count(*) AS avg_latency_ms, count(*) FILTER (WHERE fallback) AS fallback_count,
  count(*) FILTER (WHERE fallback)::DOUBLE/count(*) AS fallback_rate,
  1.0::DOUBLE-count(*) FILTER (WHERE fallback)::DOUBLE/count(*) AS prediction_success_rate,
  count(*) FILTER (WHERE task='churn') AS churn_predictions, count(*) FILTER (WHERE task='default') AS default_predictions,
  count(*) FILTER (WHERE task='fraud') AS fraud_predictions, max(created_at) AS last_prediction_at FROM predictions""")
def kpi_predictions(t):
    # the sum of binary fractions depends on the order of addition in its last digits
    return M.totals(t.predictions(), M.prediction_measures()).withColumn("avg_confidence", F.round("avg_confidence", 9))


@query("kpi_predicted_rates", "predictions", """
 SELECT count(*) FILTER (WHERE task='churn' AND prediction_label='Will Churn')::DOUBLE/count(*) FILTER (WHERE task='churn') AS predicted_churn_rate,
  count(*) FILTER (WHERE task='default' AND prediction_label='Likely Default')::DOUBLE/count(*) FILTER (WHERE task='default') AS predicted_default_rate,
  count(*) FILTER (WHERE task='fraud' AND prediction_label='Fraud')::DOUBLE/count(*) FILTER (WHERE task='fraud') AS predicted_fraud_rate
 FROM predictions""")
def kpi_predicted_rates(t):
    return M.totals(t.predictions(), M.predicted_rate_measures())


def training_table(t):
    """Training records per algorithm, measured on the scores."""
    runs = E.rates(t.model_runs())
    return runs.select(
        F.concat(F.lit("risk_model_"), F.col("algorithm")).alias("model_name"), F.lit("default").alias("task"), "algorithm",
        F.lit("2.0.0").alias("version"), "accuracy", F.col("precision").alias("precision_score"),
        F.col("recall").alias("recall_score"), F.col("f1").alias("f1_score"),
        # balanced accuracy is the ROC-AUC of a single threshold
        ((F.col("recall") + F.col("specificity")) / 2.0).alias("roc_auc"),
        ((F.col("tp") + F.col("fp")).cast("double") / 100.0).alias("training_seconds"),
    )


TRAINING_SQL = """
 training AS (SELECT 'risk_model_'||algorithm AS model_name, algorithm, (tp+tn)::DOUBLE/(tp+tn+fp+fn) AS accuracy,
  tp::DOUBLE/(tp+fp) AS precision_score, tp::DOUBLE/(tp+fn) AS recall_score, (2*tp)::DOUBLE/(2*tp+fp+fn) AS f1_score,
  (tp::DOUBLE/(tp+fn)+tn::DOUBLE/(tn+fp))/2 AS roc_auc, (tp+fp)::DOUBLE/100 AS training_seconds FROM model_runs)"""


@query("kpi_model_training", "model_runs", f"""WITH {TRAINING_SQL}
 SELECT round(avg(accuracy),9) AS avg_accuracy, round(avg(roc_auc),9) AS avg_roc_auc, round(avg(f1_score),9) AS avg_f1,
  round(avg(precision_score),9) AS avg_precision, round(avg(recall_score),9) AS avg_recall,
  round(avg(training_seconds),9) AS avg_training_time, count(*) AS total_models, max(roc_auc) AS best_roc_auc,
  min(roc_auc) AS worst_roc_auc, first(model_name ORDER BY roc_auc DESC, model_name DESC) AS best_model FROM training""")
def kpi_model_training(t):
    out = M.totals(training_table(t), M.training_measures())
    return out.withColumns({c: F.round(c, 9) for c in out.columns if c.startswith("avg_")})


@query("report_training_metrics", "model_runs", f"""WITH {TRAINING_SQL}
 SELECT model_name, accuracy AS avg_accuracy, roc_auc AS avg_roc_auc, f1_score AS avg_f1, precision_score AS avg_precision,
  recall_score AS avg_recall FROM training""")
def report_training_metrics(t):
    chosen = ("avg_accuracy", "avg_roc_auc", "avg_f1", "avg_precision", "avg_recall")
    measures = {k: v for k, v in M.training_measures().items() if k in chosen}
    return M.measure_by(training_table(t), "model_name", measures)


@query("kpi_feature_store", "snapshots", """
 SELECT count(feature_id) AS total_feature_rows, max(customer_risk_score) AS latest_risk_score,
  max(default_rate) AS latest_default_rate, max(avg_debt_ratio) AS avg_debt_ratio FROM snapshots""")
def kpi_feature_store(t):
    snap = t.snapshots()
    return M.totals(snap, M.feature_store_measures(snap.columns))


@query("kpi_feature_store_latest", "snapshots", """
 SELECT (SELECT count(feature_id) FROM snapshots) AS total_feature_rows, customer_risk_score AS latest_risk_score,
  default_rate AS latest_default_rate, avg_debt_ratio FROM snapshots ORDER BY feature_asof_date DESC LIMIT 1""")
def kpi_feature_store_latest(t):
    snap = t.snapshots()
    return M.totals(snap, M.feature_store_measures(snap.columns, latest=True))


@query("kpi_executive", "subscribers loans txns runs", """
 SELECT c.*, l.*, x.*, r.* FROM
  (SELECT sum(churn_flag)::DOUBLE/count(*) AS churn_rate, sum(CASE WHEN churn_flag=1 THEN monthly_charges END)*12 AS annual_revenue_at_risk,
   count(*) AS customers FROM subscribers) c,
  (SELECT sum(default_flag)::DOUBLE/count(*) AS default_rate, sum(CASE WHEN default_flag=1 THEN loan_amount END) AS defaulted_principal,
   count(*) AS loans FROM loans) l,
  (SELECT sum(is_fraud)::DOUBLE/count(*) AS fraud_rate, sum(CASE WHEN is_fraud=1 THEN transaction_amt END) AS fraud_exposure,
   count(*) AS transactions FROM txns) x,
  (SELECT count(*) FILTER (WHERE upper(trim(status)) IN ('SUCCESS','COMPLETED'))::DOUBLE/count(*) AS run_success_rate FROM runs) r""")
def kpi_executive(t):
    return M.executive_banner(t.subscribers(), t.loans_core(), t.txns(), t.runs())


@query("kpi_snapshot_daily", "subscribers loans txns", f"""
 SELECT c.*, l.*, x.*, DATE '{REPORT_DATE}' AS reporting_date FROM
  (SELECT count(*) AS total_customers, sum(total_charges) AS revenue, sum(churn_flag)::DOUBLE/count(*)*100 AS churn_rate_pct FROM subscribers) c,
  (SELECT count(*) FILTER (WHERE default_flag=0) AS loans_approved, count(*) FILTER (WHERE default_flag=1) AS loans_rejected FROM loans) l,
  (SELECT count(*) FILTER (WHERE is_fraud=1) AS fraud_cases FROM txns) x""")
def kpi_snapshot_daily(t):
    return M.daily_snapshot(t.subscribers(), t.loans_core(), t.txns(), REPORT_DATE)


@query("monitoring_by_model", "predictions", """
 SELECT task, model_name, model_version, count(*) AS predictions, round(sum(prediction_score)/count(*),9) AS average_score,
  sum(inference_ms)::DOUBLE/count(*) AS average_inference_ms, max(created_at) AS latest_prediction_at
 FROM predictions GROUP BY 1,2,3""")
def monitoring_by_model(t):
    return M.monitoring_by_model(t.predictions()).withColumn("average_score", F.round("average_score", 9))


def _half_up(total: str, n: str, digits: int) -> str:
    """Exact rounded quotient of an integer total scaled by 100 and a count."""
    unit = 10**digits
    return (f"((2*CAST({total} AS HUGEINT)*{unit} + 100*CAST({n} AS HUGEINT))//(200*CAST({n} AS HUGEINT)))"
            f"::DECIMAL(18,0)/{unit}")


def _avg(c: str, digits: int) -> str:
    return f"CAST({_half_up(f'sum(CAST({c}*100 AS BIGINT))', f'count({c})', digits)} AS DECIMAL(18,{digits}))"


def _share(cond: str) -> str:
    return f"CAST({_half_up(f'100*count(*) FILTER (WHERE {cond})', 'count(*)', 4)} AS DECIMAL(10,4))"


@query("feature_snapshot", "subscribers loans txns", f"""
 SELECT *, CAST(round(CAST(0.40::DOUBLE*fraud_rate::DOUBLE+0.30::DOUBLE*default_rate::DOUBLE+0.30::DOUBLE*churn_rate::DOUBLE AS DECIMAL(20,10)),4) AS DECIMAL(10,4)) AS customer_risk_score
 FROM (SELECT DATE '{REPORT_DATE}' AS feature_asof_date, c.*, l.*, x.* FROM
  (SELECT count(*) AS total_customers, {_avg('tenure', 1)} AS avg_tenure, {_avg('monthly_charges', 2)} AS avg_monthly_charges,
   {_avg('total_charges', 2)} AS avg_total_charges, {_avg('churn_flag', 4)} AS churn_rate,
   {_share("contract_type='Month-to-month'")} AS month_to_month_pct FROM subscribers) c,
  (SELECT count(*) AS total_loans, {_avg('loan_amount', 2)} AS avg_loan_amount, {_avg('interest_rate', 2)} AS avg_interest_rate,
   {_avg('default_flag', 4)} AS default_rate, {_avg('debt_ratio', 2)} AS avg_debt_ratio, {_share('high_risk=1')} AS high_risk_pct
   FROM (SELECT *, CAST(loan_id%250 AS DECIMAL(9,2)) AS debt_ratio FROM loans)) l,
  (SELECT count(*) AS total_transactions, count(*) FILTER (WHERE is_fraud=1) AS fraud_count, {_avg('is_fraud', 4)} AS fraud_rate,
   {_avg('transaction_amt', 2)} AS avg_transaction_amt FROM txns) x)""")
def feature_snapshot(t):
    loans = t.loans_core().withColumn("debt_ratio", (F.col("loan_id") % 250).cast("decimal(9,2)"))
    return M.feature_snapshot(t.subscribers(), loans, t.txns(), REPORT_DATE)


@query("composite_risk_score", "loans", """
 SELECT customer_id, CAST(round(CAST(0.40::DOUBLE*coalesce(f,0)+0.30::DOUBLE*coalesce(d,0)+0.30::DOUBLE*coalesce(h,0) AS DECIMAL(20,10)),4) AS DECIMAL(10,4)) AS score
 FROM (SELECT customer_id, sum(high_risk)::DOUBLE/count(*) AS f, sum(default_flag)::DOUBLE/count(*) AS d,
  CASE WHEN customer_id%5>0 THEN sum(CASE WHEN dti>30 THEN 1 ELSE 0 END)::DOUBLE/count(*) END AS h FROM loans GROUP BY 1)""")
def composite_risk_score(t):
    rates = t.loans_core().groupBy("customer_id").agg(
        mean("high_risk").alias("f"), mean("default_flag").alias("d"), mean((F.col("dti") > 30).cast("int")).alias("h0")
    ).withColumn("h", F.when(F.col("customer_id") % 5 > 0, F.col("h0")))
    score = composite_risk("f", "d", "h").cast("decimal(20,10)")
    return rates.select("customer_id", F.round(score, 4).cast("decimal(10,4)").alias("score"))

"""Grouped analytics, reports and top-k lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bands as B
from ..operators import measures as M
from ..operators import segments as S
from .registry import query


def seg_sql(view: str, key: str, flag: str, value: str | None = None, having: int = 0, alias: str | None = None) -> str:
    lost = f", coalesce(sum(CASE WHEN {flag}=1 THEN {value} END),0)::DECIMAL(38,2) AS value_lost" if value else ""
    tail = f" HAVING count(*)>={having}" if having else ""
    return (f"SELECT {key} AS {alias or key}, sum({flag})::DOUBLE/count(*) AS rate, count(*) AS n, sum({flag})::BIGINT AS events{lost} "
            f"FROM {view} WHERE {key} IS NOT NULL GROUP BY 1{tail}")


@query("segment_rate", "loans", seg_sql("loans", "grade", "default_flag", "loan_amount"))
def segment_rate(t):
    return S.segment_rate(t.loans_core(), "grade", "default_flag", "loan_amount")


@query("segment_rate_min_n", "txns", seg_sql("txns", "coalesce(device_type,'unknown')", "is_fraud", "transaction_amt", 100, "device_type"))
def segment_rate_min_n(t):
    return S.segment_rate_filled(t.txns(), "device_type", "is_fraud", "transaction_amt")


@query("segment_rate_bands", "loans", """
 SELECT band AS fico_band, sum(default_flag)::DOUBLE/count(*) AS rate, count(*) AS n, sum(default_flag)::BIGINT AS events,
  coalesce(sum(CASE WHEN default_flag=1 THEN loan_amount END),0)::DECIMAL(38,2) AS value_lost
 FROM (SELECT *, CASE WHEN credit_score<=600 THEN '<600' WHEN credit_score<=660 THEN '600-659' WHEN credit_score<=700 THEN '660-699'
  WHEN credit_score<=740 THEN '700-739' ELSE '740+' END AS band FROM loans) GROUP BY 1""")
def segment_rate_bands(t):
    return S.segment_rate(t.loans_core().withColumn("fico_band", B.fico_band("credit_score")), "fico_band", "default_flag", "loan_amount")


@query("segment_rate_amount", "txns", """
 SELECT band AS amt_band, sum(is_fraud)::DOUBLE/count(*) AS rate, count(*) AS n, sum(is_fraud)::BIGINT AS events,
  coalesce(sum(CASE WHEN is_fraud=1 THEN transaction_amt END),0)::DECIMAL(38,2) AS value_lost
 FROM (SELECT *, CASE WHEN transaction_amt<=0 THEN NULL WHEN transaction_amt<=25 THEN '<25' WHEN transaction_amt<=100 THEN '25-100'
  WHEN transaction_amt<=250 THEN '100-250' WHEN transaction_amt<=500 THEN '250-500' WHEN transaction_amt<=1000 THEN '500-1k' ELSE '1k+' END AS band FROM txns)
 WHERE band IS NOT NULL GROUP BY 1""")
def segment_rate_amount(t):
    return S.segment_rate(t.txns().withColumn("amt_band", B.amount_band("transaction_amt")), "amt_band", "is_fraud", "transaction_amt")


@query("segment_vs_overall", "txns", """
 SELECT email_domain, n, events, rate, overall, CASE WHEN rate>overall*1.15::DOUBLE THEN 'above' WHEN rate<overall*0.85::DOUBLE THEN 'below' ELSE 'near' END AS tag
 FROM (SELECT email_domain, count(*) AS n, sum(is_fraud)::BIGINT AS events, sum(is_fraud)::DOUBLE/count(*) AS rate,
  (SELECT sum(is_fraud)::DOUBLE/count(*) FROM txns) AS overall FROM txns GROUP BY 1)""")
def segment_vs_overall(t):
    return S.segment_vs_overall(t.txns(), "email_domain", "is_fraud")


RANK_SQL = " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, {d} AS segment, count(*) AS customers, sum(churn_flag)::DOUBLE/count(*) AS churn_rate, "
    f"(coalesce(sum(CASE WHEN churn_flag=1 THEN monthly_charges END),0)*12)::DECIMAL(38,2) AS annual_value_lost, "
    f"(sum(churn_flag)::DOUBLE/count(*)-(SELECT sum(churn_flag)::DOUBLE/count(*) FROM subscribers))*count(*)::DOUBLE AS excess_events "
    f"FROM subscribers GROUP BY {d} HAVING count(*)>=50"
    for d in S.CHURN_DIMENSIONS
)


@query("segment_rank_multi_dim", "subscribers", f"SELECT * FROM ({RANK_SQL}) ORDER BY annual_value_lost DESC, dimension, segment LIMIT 10")
def segment_rank_multi_dim(t):
    return S.rank_segments(t.subscribers(), S.CHURN_DIMENSIONS, "churn_flag", "monthly_charges")


@query("act_first_list", "subscribers loans txns runs", f"""
 (SELECT 'churn' AS domain, s AS segment, rate, n, (value_lost*12)::DECIMAL(38,2) AS value_lost FROM ({seg_sql('subscribers', 'contract_type', 'churn_flag', 'monthly_charges', 0, 's')}) ORDER BY value_lost DESC, s LIMIT 1)
 UNION ALL (SELECT 'lending', s, rate, n, value_lost FROM ({seg_sql('loans', 'grade', 'default_flag', 'loan_amount', 0, 's')}) ORDER BY value_lost DESC, s LIMIT 1)
 UNION ALL (SELECT 'fraud', s, rate, n, 0::DECIMAL(38,2) FROM ({seg_sql('txns', 'email_domain', 'is_fraud', None, 200, 's')}) ORDER BY rate DESC, s LIMIT 1)
 UNION ALL (SELECT 'data_health', 'failed_runs', count(*) FILTER (WHERE upper(trim(status)) NOT IN ('SUCCESS','COMPLETED'))::DOUBLE/count(*),
  count(*) FILTER (WHERE upper(trim(status)) NOT IN ('SUCCESS','COMPLETED')), 0::DECIMAL(38,2) FROM runs)""")
def act_first_list(t):
    return S.act_first(t.subscribers(), t.loans_core(), t.txns(), t.runs())


@query("weighted_rate", "loans", "SELECT sum(CASE WHEN default_flag=1 THEN loan_amount END)::DOUBLE/sum(loan_amount)::DOUBLE AS weighted_rate FROM loans")
def weighted_rate(t):
    return S.weighted_rate(t.loans_core(), "default_flag", "loan_amount")


@query("group_compare", "subscribers", """
 SELECT sum(CASE WHEN churn_flag=1 THEN monthly_charges END)::DOUBLE/count(*) FILTER (WHERE churn_flag=1) AS mean_flagged,
  sum(CASE WHEN churn_flag=0 THEN monthly_charges END)::DOUBLE/count(*) FILTER (WHERE churn_flag=0) AS mean_other,
  (SELECT quantile_cont(tenure::DOUBLE,0.5) FROM subscribers WHERE churn_flag=1) AS median_flagged FROM subscribers""")
def group_compare(t):
    return S.group_compare(t.subscribers(), "churn_flag", "monthly_charges", "tenure")


@query("group_compare_fraud", "txns", """
 SELECT sum(CASE WHEN is_fraud=1 THEN transaction_amt END)::DOUBLE/count(*) FILTER (WHERE is_fraud=1) AS mean_flagged,
  sum(CASE WHEN is_fraud=0 THEN transaction_amt END)::DOUBLE/count(*) FILTER (WHERE is_fraud=0) AS mean_other FROM txns""")
def group_compare_fraud(t):
    return S.group_compare(t.txns(), "is_fraud", "transaction_amt")


@query("revenue_lost_share", "subscribers", """
 SELECT (sum(monthly_charges)*12)::DECIMAL(38,2) AS annual_revenue, (sum(CASE WHEN churn_flag=1 THEN monthly_charges END)*12)::DECIMAL(38,2) AS annual_revenue_lost,
  (sum(CASE WHEN churn_flag=1 THEN monthly_charges END)*12)::DOUBLE/(sum(monthly_charges)*12)::DOUBLE AS lost_share FROM subscribers""")
def revenue_lost_share(t):
    return S.revenue_lost_share(t.subscribers(), "churn_flag", "monthly_charges")


@query("price_vs_loss", "loans", """
 SELECT *, margin_pts<0 AS underpriced, row_number() OVER (ORDER BY margin_pts DESC, grade)=1 AS widest_margin FROM (
 SELECT *, avg_rate-expected_loss AS margin_pts FROM (SELECT *, default_rate*0.6::DOUBLE*100::DOUBLE AS expected_loss FROM (
  SELECT grade, sum(interest_rate)::DOUBLE/count(*) AS avg_rate, sum(default_flag)::DOUBLE/count(*) AS default_rate, count(*) AS n FROM loans GROUP BY 1)))""")
def price_vs_loss(t):
    return S.price_vs_loss(t.loans_core())


@query("vintage_rate", "loans", """
 SELECT CAST(date_trunc('quarter', issue_date) AS DATE) AS vintage, sum(default_flag)::DOUBLE/count(*) AS rate, count(*) AS n
 FROM loans WHERE issue_date IS NOT NULL GROUP BY 1 HAVING count(*)>=100""")
def vintage_rate(t):
    return S.vintage_rate(t.loans_core(), "issue_date", "default_flag")


@query("concentration_share", "loans", """
 SELECT grade, sum(loan_amount) AS total, sum(loan_amount)::DOUBLE/(SELECT sum(loan_amount) FROM loans)::DOUBLE AS share FROM loans GROUP BY 1""")
def concentration_share(t):
    return S.concentration(t.loans_core(), "grade", "loan_amount")


HEAT_SQL = ", ".join(
    f"sum(is_fraud) FILTER (WHERE h={h})::DOUBLE/nullif(count(*) FILTER (WHERE h={h}),0) AS h{h:02d}" for h in range(24)
)


@query("rate_heatmap", "txns", f"""
 SELECT CAST(d AS INTEGER) AS day_no, ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][d+1] AS day_name, {HEAT_SQL}
 FROM (SELECT isodow(transaction_dt)-1 AS d, hour(transaction_dt) AS h, is_fraud FROM txns) GROUP BY d""")
def rate_heatmap(t):
    return S.rate_heatmap(t.txns(), "transaction_dt", "is_fraud")


@query("peak_hour", "txns", """
 WITH hours AS (SELECT hour(transaction_dt) AS h, sum(is_fraud)::DOUBLE/count(*) AS r FROM txns GROUP BY 1)
 SELECT CAST((SELECT h FROM hours ORDER BY r DESC, h LIMIT 1) AS INTEGER) AS peak_hour, (SELECT max(r) FROM hours) AS peak_rate,
  (SELECT sum(is_fraud)::DOUBLE/count(*) FROM txns WHERE hour(transaction_dt)<6) AS overnight_rate,
  (SELECT sum(is_fraud)::DOUBLE/count(*) FROM txns WHERE hour(transaction_dt)>=6) AS day_rate""")
def peak_hour(t):
    return S.peak_hour(t.txns(), "transaction_dt", "is_fraud")


@query("daily_run_health", "runs", """
 SELECT CAST(started_at AS DATE) AS day, count(*) AS runs, count(*) FILTER (WHERE upper(trim(status)) IN ('SUCCESS','COMPLETED'))::DOUBLE/count(*) AS success,
  sum((epoch_us(completed_at)-epoch_us(started_at))//1000)::DOUBLE/count(completed_at)/60000 AS minutes FROM runs GROUP BY 1 HAVING count(completed_at)>0""")
def daily_run_health(t):
    return S.daily_run_health(t.runs())


@query("failure_rate_by_table", "runs", """
 SELECT target_table, count(*) AS runs, 1.0::DOUBLE-count(*) FILTER (WHERE upper(trim(status)) IN ('SUCCESS','COMPLETED'))::DOUBLE/count(*) AS failure_rate FROM runs GROUP BY 1""")
def failure_rate_by_table(t):
    return S.failure_rate_by_table(t.runs())


@query("review_policy_benefit", "txns", """
 SELECT count(*)::DOUBLE*0.1::DOUBLE AS reviews, saved AS fraud_prevented, saved-count(*)::DOUBLE*0.1::DOUBLE*15::DOUBLE AS net_benefit
 FROM txns, (SELECT sum(CASE WHEN is_fraud=1 THEN transaction_amt END)::DOUBLE*0.55::DOUBLE AS saved FROM txns) GROUP BY saved""")
def review_policy_benefit(t):
    return S.review_benefit(t.txns(), "is_fraud", "transaction_amt")


@query("retention_what_if", "subscribers", """
 SELECT gap, n*0.1::DOUBLE*greatest(gap,0) AS customers_retained, n*0.1::DOUBLE*greatest(gap,0)*charge*12 AS annual_revenue FROM (
 SELECT count(*) FILTER (WHERE m)::DOUBLE AS n, sum(churn_flag) FILTER (WHERE m)::DOUBLE/count(*) FILTER (WHERE m)
   - sum(churn_flag) FILTER (WHERE NOT m)::DOUBLE/count(*) FILTER (WHERE NOT m) AS gap,
  sum(monthly_charges) FILTER (WHERE m)::DOUBLE/count(*) FILTER (WHERE m) AS charge FROM (SELECT *, contract_type='Month-to-month' AS m FROM subscribers))""")
def retention_what_if(t):
    return S.retention_what_if(t.subscribers())


# ---------------------------------------------------------------- report visuals: (view, category, measures)

REPORTS = {
    "churned_by_contract": ("subscribers", "contract_type", ("churned_customers",)),
    "churned_by_internet": ("subscribers", "internet_service", ("churned_customers",)),
    "churn_rate_by_tenure": ("subscribers", "tenure_group", ("churn_rate",)),
    "customers_by_payment": ("subscribers", "payment_method", ("total_customers",)),
    "revenue_by_contract": ("subscribers", "contract_type", ("total_revenue",)),
    "default_rate_by_purpose": ("loans", "purpose", ("default_rate",)),
    "loans_by_grade": ("loans", "grade", ("total_loans",)),
    "loans_by_status": ("loans", "loan_status", ("total_loans",)),
    "volume_by_home": ("loans", "home_ownership", ("loan_volume",)),
    "volume_by_status": ("loans", "loan_status", ("loan_volume",)),
    "fraud_rate_by_device": ("txns", "device_type", ("fraud_rate",)),
    "fraud_cases_by_card": ("txns", "card4", ("fraud_cases", "total_transactions")),
    "fraud_cases_by_card_type": ("txns", "card6", ("fraud_cases",)),
    "stream_fraud_by_merchant": ("stream_txns", "merchant", ("stream_fraud_cases",)),
    "stream_fraud_by_category": ("stream_txns", "category", ("stream_fraud_rate", "stream_total_amount")),
    "predictions_by_task": ("predictions", "task", ("total_predictions",)),
}
MEASURES = {
    "subscribers": M.churn_measures, "loans": M.loan_measures, "txns": M.transaction_measures,
    "stream_txns": M.stream_measures, "predictions": M.prediction_measures,
}
MEASURE_SQL = {
    "churned_customers": "count(*) FILTER (WHERE churn_flag=1)",
    "churn_rate": "sum(churn_flag)::DOUBLE/count(customer_id)",
    "total_customers": "count(customer_id)",
    "total_revenue": "sum(total_charges)",
    "default_rate": "count(*) FILTER (WHERE default_flag=1)::DOUBLE/count(loan_id)",
    "total_loans": "count(loan_id)",
    "loan_volume": "sum(loan_amount)",
    "fraud_rate": "sum(is_fraud)::DOUBLE/count(transaction_id)",
    "fraud_cases": "count(*) FILTER (WHERE is_fraud=1)",
    "total_transactions": "count(*)",
    "stream_fraud_cases": "count(*) FILTER (WHERE is_fraud)",
    "stream_fraud_rate": "count(*) FILTER (WHERE is_fraud)::DOUBLE/count(*)",
    "stream_total_amount": "sum(amount)",
    "total_predictions": "count(prediction_id)",
}


def _report(name: str, view: str, category: str, wanted: tuple[str, ...]) -> None:
    sql = f"SELECT {category}, {', '.join(f'{MEASURE_SQL[m]} AS {m}' for m in wanted)} FROM {view} GROUP BY 1"

    @query(f"report_{name}", view, sql)
    def job(t):
        measures = MEASURES[view]()
        order = [category] if category == "tenure_group" else None
        source = "loans_core" if view == "loans" and category != "purpose" else view
        return M.measure_by(getattr(t, source)(), category, {m: measures[m] for m in wanted}, order)


for _name, (_view, _category, _wanted) in REPORTS.items():
    _report(_name, _view, _category, _wanted)


@query("report_group_by", "loans", """
 SELECT purpose, count(*) FILTER (WHERE default_flag=1)::DOUBLE/count(loan_id) AS default_rate, count(loan_id) AS total_loans,
  sum(loan_amount) AS loan_volume FROM loans GROUP BY 1""")
def report_group_by(t):
    m = M.loan_measures()
    return M.measure_by(t.loans(), "purpose", {k: m[k] for k in ("default_rate", "total_loans", "loan_volume")})


@query("report_matrix", "subscribers", """
 SELECT customer_id, sum(monthly_charges)::DECIMAL(38,2) AS monthly_charges, sum(tenure)::BIGINT AS tenure FROM subscribers GROUP BY 1""")
def report_matrix(t):
    return S.report_matrix(t.subscribers(), ["customer_id"], {"monthly_charges": "decimal(38,2)", "tenure": "bigint"})


@query("report_detail", "loans", "SELECT DISTINCT grade, purpose, loan_amount, interest_rate, loan_status FROM loans")
def report_detail(t):
    return S.report_detail(t.loans(), ["grade", "purpose", "loan_amount", "interest_rate", "loan_status"], ["grade", "purpose"])


@query("report_detail_customers", "subscribers", "SELECT DISTINCT customer_id, contract_type, tenure, monthly_charges, churn_flag FROM subscribers")
def report_detail_customers(t):
    return S.report_detail(t.subscribers(), ["customer_id", "contract_type", "tenure", "monthly_charges", "churn_flag"])


@query("report_detail_runs", "runs", "SELECT DISTINCT task_id, target_table, status, started_at, records_read FROM runs")
def report_detail_runs(t):
    return S.report_detail(t.runs(), ["task_id", "target_table", "status", "started_at", "records_read"])


@query("report_detail_predictions", "predictions", "SELECT DISTINCT task, model_name, prediction_label, prediction_score, created_at FROM predictions")
def report_detail_predictions(t):
    return S.report_detail(t.predictions(), ["task", "model_name", "prediction_label", "prediction_score", "created_at"])


@query("calendar_dim", "", """
 SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day, dayname(d) AS weekday,
  CAST((dayofyear(d)+isodow(date_trunc('year',d))-2)//7+1 AS INTEGER) AS week_of_year,
  CAST(year(d) AS VARCHAR)||' Q'||CAST(quarter(d) AS VARCHAR) AS year_quarter, strftime(d,'%Y-%m') AS year_month, isodow(d)>=6 AS is_weekend, false AS is_holiday
 FROM (SELECT unnest(generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem), INTERVAL 1 DAY)) AS d)""")
def calendar_dim(t):
    ordered = t.raw("orders").agg(F.min("o_orderdate").alias("first"))
    shipped = t.raw("lineitem").agg(F.max("l_shipdate").alias("last"))
    return S.calendar(M.one_row(ordered, shipped))


# ---------------------------------------------------------------- top-k lists


@query("topn_recent", "txns", """
 SELECT transaction_id, transaction_dt, transaction_amt, is_fraud FROM txns ORDER BY transaction_dt DESC, transaction_id DESC LIMIT 2000""")
def topn_recent(t):
    return S.newest(t.txns(), "transaction_dt", "transaction_id", 2000).select("transaction_id", "transaction_dt", "transaction_amt", "is_fraud")


@query("topn_alerts", "stream_txns", """
 SELECT transaction_id, account_id, amount, merchant, transaction_ts FROM stream_txns WHERE is_fraud ORDER BY amount DESC, transaction_id LIMIT 50""")
def topn_alerts(t):
    return S.top_alerts(t.stream_txns(), F.col("is_fraud"), "amount", "transaction_id", 50).select(
        "transaction_id", "account_id", "amount", "merchant", "transaction_ts"
    )


@query("recent_failures", "runs", """
 SELECT run_id, started_at, task_id, target_table, records_failed, error_message FROM runs
 WHERE upper(trim(status)) NOT IN ('SUCCESS','COMPLETED') ORDER BY started_at DESC, run_id LIMIT 15""")
def recent_failures(t):
    return S.recent_failures(t.runs())


@query("retention_call_list", "subscribers", """
 SELECT customer_id, contract_type, tenure, monthly_charges, churn_probability, churn_probability*monthly_charges::DOUBLE*12 AS expected_loss
 FROM subscribers WHERE churn_flag=0 ORDER BY churn_probability*monthly_charges::DOUBLE*12 DESC, customer_id LIMIT 25""")
def retention_call_list(t):
    return S.retention_call_list(t.subscribers())


@query("retention_call_total", "subscribers", """
 SELECT count(*) AS n, round(sum(e),6) AS expected_loss FROM (SELECT churn_probability*monthly_charges::DOUBLE*12 AS e
 FROM subscribers WHERE churn_flag=0 ORDER BY 1 DESC, customer_id LIMIT 25)""")
def retention_call_total(t):
    return S.retention_call_list(t.subscribers()).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("expected_loss"), 6).alias("expected_loss")
    )

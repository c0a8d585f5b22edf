"""Model evaluation, scoring rules and score monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.cleaning import fill_text
from ..functions.validation import CHURN_RULES, CUSTOMER_RULES, DEFAULT_RULES, FRAUD_RULES, validate_rows
from ..operators import evaluation as E
from ..operators import scoring as S
from ..session import work_dir
from ..sources.committed import read_committed
from .cleaning_queries import REQUESTS, requests
from .kpi_queries import TRAINING_SQL, training_table
from .registry import query

STEPS = """WITH g AS (SELECT score, count(*) AS n, sum(y)::BIGINT AS pos FROM scores GROUP BY 1),
 st AS (SELECT *, sum(n) OVER (ORDER BY score DESC)::BIGINT AS cn, sum(pos) OVER (ORDER BY score DESC)::BIGINT AS cp,
  (SELECT count(*) FROM scores) AS nn, (SELECT sum(y) FROM scores)::BIGINT AS pp FROM g)"""


@query("confusion_metrics", "scores", """
 SELECT *, (tp+tn)::DOUBLE/(tp+fp+tn+fn) AS accuracy, tp::DOUBLE/(tp+fp) AS precision, tp::DOUBLE/(tp+fn) AS recall,
  (2*tp)::DOUBLE/(2*tp+fp+fn) AS f1, tn::DOUBLE/(tn+fp) AS specificity, (tp+fn)::DOUBLE/(tp+fp+tn+fn) AS base_rate FROM (
 SELECT count(*) FILTER (WHERE y=1 AND score>=0.5) AS tp, count(*) FILTER (WHERE y=0 AND score>=0.5) AS fp,
  count(*) FILTER (WHERE y=0 AND score<0.5) AS tn, count(*) FILTER (WHERE y=1 AND score<0.5) AS fn FROM scores)""")
def confusion_metrics(t):
    return E.confusion_metrics(t.scores(), "y", "score", 0.5)


@query("roc_auc", "scores", """WITH g AS (SELECT score, sum(y)::HUGEINT AS p, sum(1-y)::HUGEINT AS q FROM scores GROUP BY 1),
 c AS (SELECT *, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0)::HUGEINT AS below FROM g)
 SELECT sum(p*(2*below+q))::DOUBLE/(sum(p)::DOUBLE*sum(q)::DOUBLE*2) AS roc_auc FROM c""")
def roc_auc(t):
    return E.roc_auc(t.scores(), "y", "score")


@query("pr_auc", "scores", f"""{STEPS} SELECT round(sum(pos::DOUBLE/pp*(cp::DOUBLE/cn)),9) AS pr_auc FROM st""")
def pr_auc(t):
    return E.pr_auc(t.scores(), "y", "score").select(F.round("pr_auc", 9).alias("pr_auc"))


@query("ks_statistic", "scores", f"""{STEPS} SELECT greatest(max(cp::DOUBLE/pp-(cn-cp)::DOUBLE/(nn-pp)),0) AS ks FROM st""")
def ks_statistic(t):
    return E.ks_statistic(t.scores(), "y", "score")


@query("evaluate_scores", "scores", f"""{STEPS},
 g2 AS (SELECT score, sum(y)::HUGEINT AS p, sum(1-y)::HUGEINT AS q FROM scores GROUP BY 1),
 c AS (SELECT *, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0)::HUGEINT AS below FROM g2),
 auc AS (SELECT sum(p*(2*below+q))::DOUBLE/(sum(p)::DOUBLE*sum(q)::DOUBLE*2) AS roc_auc FROM c),
 rk AS (SELECT round(sum(pos::DOUBLE/pp*(cp::DOUBLE/cn)),9) AS pr_auc, greatest(max(cp::DOUBLE/pp-(cn-cp)::DOUBLE/(nn-pp)),0) AS ks FROM st),
 cf AS (SELECT *, (tp+tn)::DOUBLE/(tp+fp+tn+fn) AS accuracy, tp::DOUBLE/(tp+fp) AS precision, tp::DOUBLE/(tp+fn) AS recall,
  (2*tp)::DOUBLE/(2*tp+fp+fn) AS f1, tn::DOUBLE/(tn+fp) AS specificity, (tp+fn)::DOUBLE/(tp+fp+tn+fn) AS base_rate FROM (
  SELECT count(*) FILTER (WHERE y=1 AND score>=0.5) AS tp, count(*) FILTER (WHERE y=0 AND score>=0.5) AS fp,
   count(*) FILTER (WHERE y=0 AND score<0.5) AS tn, count(*) FILTER (WHERE y=1 AND score<0.5) AS fn FROM scores)),
 lf AS (SELECT (sum(CASE WHEN r<=greatest(1,floor(n*0.1)) THEN y END)::DOUBLE/count(*) FILTER (WHERE r<=greatest(1,floor(n*0.1))))/(sum(y)::DOUBLE/count(*)) AS lift
  FROM (SELECT y, row_number() OVER (ORDER BY score DESC, md5(CAST(id AS VARCHAR)||'|tie'), id) AS r, count(*) OVER () AS n FROM scores)),
 bl AS (SELECT round(avg((score-y)*(score-y)),9) AS brier, round(avg(-(y*ln(p)+(1-y)*ln(1-p))),9) AS log_loss FROM (SELECT *, least(greatest(score,1e-6),1-1e-6) AS p FROM scores))
 SELECT * FROM auc, rk, cf, lf, bl""")
def evaluate_scores(t):
    out = E.evaluate(t.scores(), "y", "score", "id", 0.5)
    return out.withColumns({c: F.round(c, 9) for c in ("pr_auc", "brier", "log_loss")})


@query("lift_at", "scores", """
 SELECT (sum(CASE WHEN r<=greatest(1,floor(n*0.1)) THEN y END)::DOUBLE/count(*) FILTER (WHERE r<=greatest(1,floor(n*0.1))))
   /(sum(y)::DOUBLE/count(*)) AS lift
 FROM (SELECT y, row_number() OVER (ORDER BY score DESC, md5(CAST(id AS VARCHAR)||'|tie'), id) AS r, count(*) OVER () AS n FROM scores)""")
def lift_at(t):
    return E.lift_at(t.scores(), "y", "score", "id")


@query("brier_logloss", "scores", """
 SELECT round(avg((score-y)*(score-y)),9) AS brier, round(avg(-(y*ln(p)+(1-y)*ln(1-p))),9) AS log_loss
 FROM (SELECT *, least(greatest(score,1e-6),1-1e-6) AS p FROM scores)""")
def brier_logloss(t):
    out = E.brier_logloss(t.scores(), "y", "score")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


CURVE_SQL = f"""{STEPS},
 sp AS (SELECT *, row_number() OVER (ORDER BY score DESC) AS place, lead(n) OVER (ORDER BY score DESC) AS ln, lead(pos) OVER (ORDER BY score DESC) AS lp FROM st),
 corners AS (SELECT *, row_number() OVER (ORDER BY score DESC) AS idx FROM sp WHERE place=1 OR ln IS NULL OR ln<>n OR lp<>pos),
 roc AS (SELECT idx, (cn-cp)::DOUBLE/(nn-pp) AS x, cp::DOUBLE/pp AS y FROM corners UNION ALL SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE),
 pr AS (SELECT (SELECT count(*) FROM st)-place AS idx, cp::DOUBLE/pp AS x, cp::DOUBLE/cn AS y FROM sp UNION ALL SELECT (SELECT count(*) FROM st), 0.0::DOUBLE, 1.0::DOUBLE),
 ks AS (SELECT unnest(range(0,100)) AS k),
 pick AS (SELECT 'roc' AS curve, k, CASE WHEN k=99 THEN (SELECT max(idx) FROM roc) ELSE CAST(floor(k::DOUBLE*((SELECT max(idx) FROM roc)::DOUBLE/99)) AS BIGINT) END AS idx FROM ks
  UNION ALL SELECT 'pr', k, CASE WHEN k=99 THEN (SELECT max(idx) FROM pr) ELSE CAST(floor(k::DOUBLE*((SELECT max(idx) FROM pr)::DOUBLE/99)) AS BIGINT) END FROM ks)
 SELECT curve, CAST(k AS INTEGER) AS position, CAST(round(CAST(x AS DECIMAL(20,10)),4) AS DECIMAL(10,4)) AS x, CAST(round(CAST(y AS DECIMAL(20,10)),4) AS DECIMAL(10,4)) AS y
 FROM (SELECT 'roc' AS c, * FROM roc UNION ALL SELECT 'pr', * FROM pr) p JOIN pick ON pick.curve=p.c AND pick.idx=p.idx"""


@query("roc_pr_curves", "scores", CURVE_SQL)
def roc_pr_curves(t):
    return E.roc_pr_curves(t.scores(), "y", "score")


@query("calibration_curve", "scores", """WITH q AS (SELECT quantile_cont(score,[0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges FROM scores)
 SELECT CAST(len(list_filter(edges, lambda v: v<score)) AS INTEGER) AS bin, count(*) AS n, round(avg(score),9) AS mean_predicted, sum(y)::DOUBLE/count(*) AS fraction_positive
 FROM scores, q GROUP BY 1""")
def calibration_curve(t):
    return E.calibration_curve(t.scores(), "y", "score").withColumn("mean_predicted", F.round("mean_predicted", 9))


@query("threshold_f1", "scores", """
 SELECT threshold, f1 FROM (SELECT g.threshold, coalesce((2*count(*) FILTER (WHERE y=1 AND score>=threshold))::DOUBLE
   /nullif(count(*) FILTER (WHERE score>=threshold)+sum(y),0)::DOUBLE,0) AS f1
  FROM scores, (SELECT (10+2*i)/100.0::DOUBLE AS threshold FROM (SELECT unnest(range(0,41)) AS i)) g GROUP BY 1)
 ORDER BY f1 DESC, threshold LIMIT 1""")
def threshold_f1(t):
    return E.threshold_f1(t.scores(), "y", "score")


@query("threshold_cost", "scores", f"""{STEPS}
 SELECT CASE WHEN pp*500.0::DOUBLE<cost THEN 0.5::DOUBLE ELSE score END AS threshold, least(cost,pp*500.0::DOUBLE) AS cost
 FROM (SELECT score, pp, (pp-cp)::DOUBLE*500+(cn-cp)::DOUBLE*15 AS cost FROM st) ORDER BY 2, score LIMIT 1""")
def threshold_cost(t):
    return E.threshold_cost(t.scores(), "y", "score")


@query("cost_impact", "scores", """
 SELECT expected_cost, baseline_cost, baseline_cost-expected_cost AS savings FROM (
 SELECT count(*) FILTER (WHERE y=1 AND score<0.3)::DOUBLE*500+count(*) FILTER (WHERE y=0 AND score>=0.3)::DOUBLE*15 AS expected_cost,
  sum(y)::DOUBLE*500 AS baseline_cost FROM scores)""")
def cost_impact(t):
    return E.cost_impact(t.scores(), "y", "score", 0.3)


# ---------------------------------------------------------------- rules

CHURN_P = """least(CAST(0.15+CASE WHEN contract_type='Month-to-month' THEN 0.30 ELSE 0 END+CASE WHEN monthly_charges>=80 THEN 0.20 ELSE 0 END
  +CASE WHEN tenure<12 THEN 0.20 ELSE 0 END+CASE WHEN payment_method='Electronic check' THEN 0.10 ELSE 0 END AS DOUBLE),0.95::DOUBLE)"""
DEFAULT_P = """least(CAST(0.10+CASE WHEN fico_score<620 THEN 0.35 ELSE 0 END+CASE WHEN debt_ratio>30 THEN 0.25 ELSE 0 END
  +CASE WHEN upper(grade) IN ('E','F','G') THEN 0.20 ELSE 0 END+CASE WHEN loan_amount>25000 THEN 0.10 ELSE 0 END AS DOUBLE),0.95::DOUBLE)"""
FRAUD_P = """least(CAST(0.03+CASE WHEN transaction_amt>500 THEN 0.30 ELSE 0 END+CASE WHEN lower(device_type) IN ('mobile','unknown') THEN 0.15 ELSE 0 END
  +CASE WHEN lower(email_domain) NOT IN ('gmail.com','yahoo.com','hotmail.com','outlook.com') THEN 0.20 ELSE 0 END
  +CASE WHEN lower(card_type) IN ('discover','unknown') THEN 0.10 ELSE 0 END AS DOUBLE),0.98::DOUBLE)"""


def drivers_sql(pairs, default):
    fired = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in pairs)
    return f"coalesce(nullif(array_to_string(list_filter([{fired}], lambda d: d IS NOT NULL),','),''),'{default}')"


CHURN_D = drivers_sql([("contract_type", "contract_type='Month-to-month'"), ("monthly_charges", "monthly_charges>=80"),
                       ("tenure", "tenure<12"), ("payment_method", "payment_method='Electronic check'")], "tenure,contract_type,monthly_charges")
DEFAULT_D = drivers_sql([("fico_score", "fico_score<620"), ("debt_ratio", "debt_ratio>30"), ("grade", "upper(grade) IN ('E','F','G')"),
                         ("loan_amount", "loan_amount>25000")], "fico_score,debt_ratio,grade")
FRAUD_D = drivers_sql([("transaction_amt", "transaction_amt>500"), ("device_type", "lower(device_type) IN ('mobile','unknown')"),
                       ("email_domain", "lower(email_domain) NOT IN ('gmail.com','yahoo.com','hotmail.com','outlook.com')"),
                       ("card_type", "lower(card_type) IN ('discover','unknown')")], "transaction_amt,device_type,email_domain")


def loan_requests(t):
    return t.loans_core().select(
        "loan_id", F.col("credit_score").alias("fico_score"), F.col("dti").alias("debt_ratio"), "loan_amount", "grade"
    )


def fraud_requests(t):
    return t.txns().select(
        "transaction_id", (F.col("transaction_amt") * 5).alias("transaction_amt"), fill_text("device_type").alias("device_type"),
        "email_domain", F.col("card4").alias("card_type"),
    )


LOAN_REQ = "(SELECT loan_id, credit_score AS fico_score, dti AS debt_ratio, loan_amount, grade FROM loans)"
FRAUD_REQ = "(SELECT transaction_id, transaction_amt*5 AS transaction_amt, coalesce(device_type,'unknown') AS device_type, email_domain, card4 AS card_type FROM txns)"


def _shown(df, id_):
    return df.select(id_, "probability", "prediction", F.array_join("top_drivers", ",").alias("top_drivers"), "model", "fallback")


@query("score_rules_churn", "subscribers", f"""
 SELECT customer_id, {CHURN_P} AS probability, CASE WHEN {CHURN_P}>=0.5 THEN 'Will Churn' ELSE 'Will Stay' END AS prediction,
  {CHURN_D} AS top_drivers, 'heuristic_churn_baseline' AS model, true AS fallback FROM subscribers""")
def score_rules_churn(t):
    return _shown(S.score_rules(t.subscribers(), R.churn_card()), "customer_id")


@query("score_rules_default", "loans", f"""
 SELECT loan_id, {DEFAULT_P} AS probability, CASE WHEN {DEFAULT_P}>=0.5 THEN 'Likely Default' ELSE 'Likely Performing' END AS prediction,
  {DEFAULT_D} AS top_drivers, 'heuristic_default_baseline' AS model, true AS fallback FROM {LOAN_REQ}""")
def score_rules_default(t):
    return _shown(S.score_rules(loan_requests(t), R.default_card()), "loan_id")


@query("score_rules_fraud", "txns", f"""
 SELECT transaction_id, {FRAUD_P} AS probability, CASE WHEN {FRAUD_P}>=0.5 THEN 'Fraud' ELSE 'Legitimate' END AS prediction,
  {FRAUD_D} AS top_drivers, 'heuristic_fraud_baseline' AS model, true AS fallback FROM {FRAUD_REQ}""")
def score_rules_fraud(t):
    return _shown(S.score_rules(fraud_requests(t), R.fraud_card()), "transaction_id")


@query("score_with_fallback", "loans", f"""
 SELECT loan_id, coalesce(m, {DEFAULT_P}) AS probability, CASE WHEN coalesce(m, {DEFAULT_P})>=CASE WHEN m IS NULL THEN 0.5::DOUBLE ELSE 0.52::DOUBLE END
   THEN 'Likely Default' ELSE 'Likely Performing' END AS prediction,
  CASE WHEN m IS NULL THEN 'heuristic_default_baseline' ELSE 'risk_default' END AS model, m IS NULL AS fallback
 FROM (SELECT *, CASE WHEN loan_id%5<>0 THEN CAST((loan_id*7919)%10007 AS DOUBLE)/10007 END AS m FROM {LOAN_REQ})""")
def score_with_fallback(t):
    m = F.when(F.col("loan_id") % 5 != 0, ((F.col("loan_id") * 7919) % 10007).cast("double") / F.lit(10007.0))
    out = S.score_with_fallback(loan_requests(t).withColumn("m", m), R.default_card(), "m", 0.52, "risk_default", "2.0.0")
    return out.select("loan_id", "probability", "prediction", "model", "fallback")


@query("risk_band", "scores", """
 SELECT id, CASE WHEN score>=0.52::DOUBLE*1.5::DOUBLE OR score>=0.8 THEN 'High' WHEN score>=0.52 THEN 'Elevated' ELSE 'Low' END AS band FROM scores""")
def risk_band(t):
    return t.scores().select("id", R.risk_band(F.col("score"), 0.52).alias("band"))


WHATIF = CHURN_P.replace("contract_type='Month-to-month'", "'Two year'='Month-to-month'")


@query("score_what_if", "subscribers", f"""
 SELECT customer_id, {CHURN_P} AS probability_now, {WHATIF} AS probability_if,
  CAST(round(CAST({CHURN_P}-{WHATIF} AS DECIMAL(20,10)),4) AS DOUBLE) AS change FROM subscribers""")
def score_what_if(t):
    out = S.score_what_if(t.subscribers(), R.churn_card(), "contract_type", "Two year")
    return out.select("customer_id", "probability_now", "probability_if", "change")


BATCH = f"""typed AS (SELECT request_id, errors, TRY_CAST(tenure AS INTEGER) AS tenure, TRY_CAST(monthly_charges AS DOUBLE) AS monthly_charges,
   contract_type, payment_method FROM checked),
 scored AS (SELECT request_id, errors, CASE WHEN len(errors)=0 THEN {CHURN_P} END AS probability FROM typed)"""


@query("score_batch", "subscribers", f"""WITH {REQUESTS}, {BATCH}
 SELECT request_id, probability, CASE WHEN probability>=0.5 THEN 'Will Churn' WHEN probability<0.5 THEN 'Will Stay' END AS prediction,
  array_to_string(errors,'; ') AS errors FROM scored""")
def score_batch(t):
    out = S.score_batch(requests(t), R.churn_card(), CHURN_RULES)
    return out.select("request_id", "probability", "prediction", F.array_join("errors", "; ").alias("errors"))


@query("score_batch_summary", "subscribers", f"""WITH {REQUESTS}, {BATCH}
 SELECT count(*) AS total, count(probability) AS success, count(*)-count(probability) AS failed, round(avg(probability),9) AS mean_probability FROM scored""")
def score_batch_summary(t):
    out = S.batch_summary(S.score_batch(requests(t), R.churn_card(), CHURN_RULES))
    return out.withColumn("mean_probability", F.round("mean_probability", 9))


def checks_sql(checks):
    """The list of broken rules: (field, fault, condition) in rule order."""
    faults = ", ".join(f"CASE WHEN {cond} THEN '{field}: {fault}' END" for field, fault, cond in checks)
    return f"list_filter([{faults}], lambda e: e IS NOT NULL) AS errors"


def loan_batch(t):
    """Default requests as text, some of them wrong."""
    k = F.col("loan_id")
    text = lambda c: F.col(c).cast("string")
    return t.loans_core().select(
        k.alias("request_id"),
        F.when(k % 10 == 0, "299").when(k % 10 == 1, "abc").when(k % 10 != 2, text("credit_score")).alias("fico_score"),
        F.when(k % 12 == 3, "-1").otherwise(text("dti")).alias("debt_ratio"),
        F.when(k % 15 == 4, "0").otherwise(text("loan_amount")).alias("loan_amount"),
        F.when(k % 20 == 5, "AB").when(k % 20 == 6, "").otherwise(F.col("grade")).alias("grade"),
        F.when(k % 18 == 7, "51").alias("emp_length"), F.when(k % 21 == 8, F.repeat(F.lit("p"), 101)).alias("purpose"),
    )


LOAN_BATCH = f"""requests AS (SELECT loan_id AS request_id,
  CASE WHEN loan_id%10=0 THEN '299' WHEN loan_id%10=1 THEN 'abc' WHEN loan_id%10<>2 THEN CAST(credit_score AS VARCHAR) END AS fico_score,
  CASE WHEN loan_id%12=3 THEN '-1' ELSE CAST(dti AS VARCHAR) END AS debt_ratio,
  CASE WHEN loan_id%15=4 THEN '0' ELSE CAST(loan_amount AS VARCHAR) END AS loan_amount,
  CASE WHEN loan_id%20=5 THEN 'AB' WHEN loan_id%20=6 THEN '' ELSE grade END AS grade,
  CASE WHEN loan_id%18=7 THEN '51' END AS emp_length, CASE WHEN loan_id%21=8 THEN repeat('p',101) END AS purpose FROM loans),
 checked AS (SELECT request_id, TRY_CAST(fico_score AS INTEGER) AS fico_score, TRY_CAST(debt_ratio AS DOUBLE) AS debt_ratio,
   TRY_CAST(loan_amount AS DOUBLE) AS loan_amount, grade, {checks_sql([
    ("fico_score", "missing", "fico_score IS NULL"), ("fico_score", "not a number", "fico_score IS NOT NULL AND TRY_CAST(fico_score AS INTEGER) IS NULL"),
    ("fico_score", "too small", "TRY_CAST(fico_score AS INTEGER)<300"), ("fico_score", "too large", "TRY_CAST(fico_score AS INTEGER)>900"),
    ("debt_ratio", "missing", "debt_ratio IS NULL"), ("debt_ratio", "too small", "TRY_CAST(debt_ratio AS DOUBLE)<0"),
    ("loan_amount", "missing", "loan_amount IS NULL"), ("loan_amount", "too small", "TRY_CAST(loan_amount AS DOUBLE)<=0"),
    ("grade", "too long", "length(grade)>1"), ("grade", "too short", "length(grade)<1"), ("purpose", "too long", "length(purpose)>100"),
    ("emp_length", "too large", "TRY_CAST(emp_length AS DOUBLE)>50")])} FROM requests),
 scored AS (SELECT request_id, errors, CASE WHEN len(errors)=0 THEN {DEFAULT_P} END AS probability FROM checked)"""


def _batch(t, rows, card, rules):
    out = S.score_batch(rows, card, rules)
    return out.select("request_id", "probability", "prediction", F.array_join("errors", "; ").alias("errors"))


@query("score_batch_default", "loans", f"""WITH {LOAN_BATCH}
 SELECT request_id, probability, CASE WHEN probability>=0.5 THEN 'Likely Default' WHEN probability<0.5 THEN 'Likely Performing' END AS prediction,
  array_to_string(errors,'; ') AS errors FROM scored""")
def score_batch_default(t):
    return _batch(t, loan_batch(t), R.default_card(), DEFAULT_RULES)


def fraud_batch(t):
    """Fraud requests as text, some of them wrong."""
    k = F.col("transaction_id")
    return fraud_requests(t).select(
        k.alias("request_id"),
        F.when(k % 10 == 0, "0").when(k % 10 == 1, "x").when(k % 10 != 2, F.col("transaction_amt").cast("string")).alias("transaction_amt"),
        F.when(k % 14 == 5, F.repeat(F.lit("d"), 51)).otherwise(F.col("device_type")).alias("device_type"),
        F.when(k % 12 == 3, F.repeat(F.lit("m"), 101)).otherwise(F.col("email_domain")).alias("email_domain"), "card_type",
        F.when(k % 9 == 4, "-1").when(k % 9 == 5, "many").alias("txn_cnt_1h"),
    )


FRAUD_BATCH = f"""requests AS (SELECT transaction_id AS request_id,
  CASE WHEN transaction_id%10=0 THEN '0' WHEN transaction_id%10=1 THEN 'x' WHEN transaction_id%10<>2 THEN CAST(transaction_amt AS VARCHAR) END AS transaction_amt,
  CASE WHEN transaction_id%14=5 THEN repeat('d',51) ELSE device_type END AS device_type,
  CASE WHEN transaction_id%12=3 THEN repeat('m',101) ELSE email_domain END AS email_domain, card_type,
  CASE WHEN transaction_id%9=4 THEN '-1' WHEN transaction_id%9=5 THEN 'many' END AS txn_cnt_1h FROM {FRAUD_REQ}),
 checked AS (SELECT request_id, TRY_CAST(transaction_amt AS DOUBLE) AS transaction_amt, device_type, email_domain, card_type, {checks_sql([
    ("transaction_amt", "missing", "transaction_amt IS NULL"),
    ("transaction_amt", "not a number", "transaction_amt IS NOT NULL AND TRY_CAST(transaction_amt AS DOUBLE) IS NULL"),
    ("transaction_amt", "too small", "TRY_CAST(transaction_amt AS DOUBLE)<=0"),
    ("device_type", "too long", "length(device_type)>50"), ("email_domain", "too long", "length(email_domain)>100"),
    ("txn_cnt_1h", "not a number", "txn_cnt_1h IS NOT NULL AND TRY_CAST(txn_cnt_1h AS DOUBLE) IS NULL"),
    ("txn_cnt_1h", "too small", "TRY_CAST(txn_cnt_1h AS DOUBLE)<0")])} FROM requests),
 scored AS (SELECT request_id, errors, CASE WHEN len(errors)=0 THEN {FRAUD_P} END AS probability FROM checked)"""


@query("score_batch_fraud", "txns", f"""WITH {FRAUD_BATCH}
 SELECT request_id, probability, CASE WHEN probability>=0.5 THEN 'Fraud' WHEN probability<0.5 THEN 'Legitimate' END AS prediction,
  array_to_string(errors,'; ') AS errors FROM scored""")
def score_batch_fraud(t):
    return _batch(t, fraud_batch(t), R.fraud_card(), FRAUD_RULES)


@query("score_batch_tasks", "loans txns", f"""
 SELECT 'default' AS task, * FROM (WITH {LOAN_BATCH}
  SELECT count(*) AS total, count(probability) AS success, count(*)-count(probability) AS failed, round(avg(probability),9) AS mean_probability FROM scored)
 UNION ALL SELECT 'fraud', * FROM (WITH {FRAUD_BATCH}
  SELECT count(*), count(probability), count(*)-count(probability), round(avg(probability),9) FROM scored)""")
def score_batch_tasks(t):
    """Totals of a default file and a fraud file."""
    parts = [("default", loan_batch(t), R.default_card(), DEFAULT_RULES), ("fraud", fraud_batch(t), R.fraud_card(), FRAUD_RULES)]
    made = [S.batch_summary(S.score_batch(rows, card, rules)).select(F.lit(task).alias("task"), "*") for task, rows, card, rules in parts]
    return made[0].unionByName(made[1]).withColumn("mean_probability", F.round("mean_probability", 9))


def customer_requests(t):
    """Customer records as text, some of them wrong."""
    k = F.col("customer_id")
    return t.subscribers().select(
        k.alias("request_id"),
        F.when(k % 30 != 5, F.get(F.array(*[F.lit(v) for v in ("lending", "fraud", "churn", "web")]), (k % 4).cast("int"))).alias("source_system"),
        F.when(k % 25 != 7, F.concat(F.lit("C"), k.cast("string"))).alias("source_customer_id"),
        F.when(k % 7 == 0, "121").when(k % 7 == 1, "old").otherwise((k % 80 + 18).cast("string")).alias("age"),
        F.when(k % 11 == 2, "2000000000").otherwise((k * 10).cast("string")).alias("annual_income"),
        F.get(F.array(*[F.lit(v) for v in ("RENT", "MORTGAGE", "OWN", "OTHER", "castle")]), (k % 5).cast("int")).alias("home_ownership"),
        F.when(k % 13 == 0, "-2").otherwise(F.col("tenure").cast("string")).alias("tenure"),
    )


@query("validate_customers", "subscribers", f"""WITH requests AS (SELECT customer_id AS request_id,
  CASE WHEN customer_id%30<>5 THEN ['lending','fraud','churn','web'][customer_id%4+1] END AS source_system,
  CASE WHEN customer_id%25<>7 THEN 'C'||CAST(customer_id AS VARCHAR) END AS source_customer_id,
  CASE WHEN customer_id%7=0 THEN '121' WHEN customer_id%7=1 THEN 'old' ELSE CAST(customer_id%80+18 AS VARCHAR) END AS age,
  CASE WHEN customer_id%11=2 THEN '2000000000' ELSE CAST(customer_id*10 AS VARCHAR) END AS annual_income,
  ['RENT','MORTGAGE','OWN','OTHER','castle'][customer_id%5+1] AS home_ownership,
  CASE WHEN customer_id%13=0 THEN '-2' ELSE CAST(tenure AS VARCHAR) END AS tenure FROM subscribers),
 checked AS (SELECT request_id, {checks_sql([
    ("source_system", "missing", "source_system IS NULL"), ("source_system", "not allowed", "source_system NOT IN ('lending','fraud','churn')"),
    ("source_customer_id", "missing", "source_customer_id IS NULL"),
    ("age", "not a number", "age IS NOT NULL AND TRY_CAST(age AS INTEGER) IS NULL"), ("age", "too small", "TRY_CAST(age AS INTEGER)<0"),
    ("age", "too large", "TRY_CAST(age AS INTEGER)>120"), ("annual_income", "too large", "TRY_CAST(annual_income AS DOUBLE)>1000000000"),
    ("home_ownership", "not allowed", "home_ownership NOT IN ('RENT','MORTGAGE','OWN','OTHER')"),
    ("tenure", "too small", "TRY_CAST(tenure AS INTEGER)<0")])} FROM requests)
 SELECT request_id, array_to_string(errors,'; ') AS errors, len(errors)=0 AS accepted FROM checked""")
def validate_customers(t):
    """Which customer records are accepted, and what is wrong with the others."""
    return validate_rows(customer_requests(t), CUSTOMER_RULES).select(
        "request_id", F.array_join("errors", "; ").alias("errors"), (F.size("errors") == 0).alias("accepted")
    )


@query("score_histogram", "scores", """
 SELECT CAST(least(floor(score*20)+1,20) AS INTEGER) AS bin, count(*) AS n FROM scores GROUP BY 1""")
def score_histogram(t):
    return S.score_histogram(t.scores(), "score")


@query("model_leaderboard", "model_runs", f"""WITH {TRAINING_SQL}
 SELECT algorithm, roc_auc, CAST(row_number() OVER (ORDER BY roc_auc DESC, algorithm) AS INTEGER) AS place,
  row_number() OVER (ORDER BY roc_auc DESC, algorithm)=1 AS selected FROM training""")
def model_leaderboard(t):
    return S.leaderboard(training_table(t).select("algorithm", "roc_auc"), "algorithm", "roc_auc")


@query("log_predictions", "subscribers", f"""
 SELECT 'churn' AS task, 'heuristic_churn_baseline' AS model_name, '0.1.0' AS model_version,
  CASE WHEN {CHURN_P}>=0.5 THEN 'Will Churn' ELSE 'Will Stay' END AS prediction_label, {CHURN_P} AS prediction_score,
  '["'||replace({CHURN_D},',','","')||'"]' AS top_drivers, CAST(customer_id%30 AS INTEGER) AS inference_ms, true AS fallback,
  TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM subscribers""")
def log_predictions(t):
    """Appended in two batches, the second sent twice, and read back: every prediction once."""
    scored = S.score_rules(t.subscribers(), R.churn_card())
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    table = work_dir(t.spark, "prediction-log")
    made = S.prediction_log(scored, "churn", F.col("customer_id") % 30, at)
    even = F.col("inference_ms") % 2 == 0
    for batch, part in ((0, made.where(even)), (1, made.where(~even)), (1, made.where(~even))):
        S.log_predictions(part, table, "nightly", batch)
    return read_committed(t.spark, table, made.schema).drop("run_id", "batch")

"""KPI measures: one dictionary per fact, used for totals and for reports.

A measure is an aggregate expression, so the same dictionary serves a grand
total (one row) and any group-by.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arithmetic import composite_risk, mean, safe_divide, sum_where
from ..functions.cleaning import upper_code

Measures = Mapping[str, Column]


def _n(c: str | None = None) -> Column:
    return F.count(F.lit(1)) if c is None else F.count(c)


def churn_measures() -> dict[str, Column]:
    churned = F.count_if(F.col("churn_flag") == 1)
    customers = _n("customer_id")
    rate = safe_divide(F.sum("churn_flag"), customers)
    monthly, tenure = mean("monthly_charges"), mean("tenure")
    at_risk = churned.cast("double") * monthly * tenure
    return {
        "total_customers": customers,
        "churned_customers": churned,
        "churn_rate": rate,
        "retention_rate": F.lit(1.0) - rate,
        "avg_monthly_charges": monthly,
        "avg_tenure": tenure,
        "customer_lifetime_value": monthly * tenure,
        "revenue_at_risk": at_risk,
        "churn_impact_pct": safe_divide(at_risk, monthly * tenure * customers.cast("double")),
        "total_revenue": F.sum("total_charges").cast("decimal(38,2)"),
    }


def loan_measures() -> dict[str, Column]:
    loans = _n("loan_id")
    defaults = F.count_if(F.col("default_flag") == 1)
    rate = safe_divide(defaults, loans)
    return {
        "total_loans": loans,
        "default_count": defaults,
        "default_rate": rate,
        "approval_rate": F.lit(1.0) - rate,
        "avg_interest_rate": mean("interest_rate"),
        "avg_loan_amount": mean("loan_amount"),
        "loan_volume": F.sum("loan_amount").cast("decimal(38,2)"),
        "risk_exposure": sum_where(F.col("default_flag") == 1, "loan_amount").cast("decimal(38,2)"),
        "avg_dti": mean("dti"),
        "high_risk_loan_rate": F.try_divide(defaults.cast("double"), _n().cast("double")),
    }


def transaction_measures() -> dict[str, Column]:
    fraud = F.count_if(F.col("is_fraud") == 1)
    amount = sum_where(F.col("is_fraud") == 1, "transaction_amt").cast("decimal(38,2)")
    volume = F.sum("transaction_amt").cast("decimal(38,2)")
    return {
        "total_transactions": _n(),
        "fraud_cases": fraud,
        "fraud_rate": safe_divide(F.sum("is_fraud"), _n("transaction_id")),
        "avg_transaction_amount": mean("transaction_amt"),
        "total_fraud_amount": amount,
        "transaction_volume": volume,
        "fraud_loss_pct": safe_divide(amount, volume),
        "fraud_severity": safe_divide(amount, fraud),
        "legit_transactions": _n() - fraud,
    }


def stream_measures() -> dict[str, Column]:
    fraud = F.count_if("is_fraud")
    return {
        "total_stream_transactions": _n(),
        "stream_fraud_cases": fraud,
        "stream_fraud_rate": safe_divide(fraud, _n()),
        "stream_total_amount": F.sum("amount").cast("decimal(38,2)"),
        "stream_avg_amount": mean("amount"),
        "stream_fraud_amount": sum_where(F.col("is_fraud"), "amount").cast("decimal(38,2)"),
    }


# Run states that count as success.
SUCCESS_STATES = ("SUCCESS", "COMPLETED")


def run_seconds() -> Column:
    """Duration to the millisecond."""
    millis = F.expr("(unix_micros(cast(completed_at as timestamp)) - unix_micros(cast(started_at as timestamp))) div 1000")
    return millis


def run_measures() -> dict[str, Column]:
    state = upper_code("status")
    ok, failed = F.count_if(state == "SUCCESS"), F.count_if(state == "FAILED")
    rate = safe_divide(ok, _n())
    seconds = F.try_divide(mean(run_seconds()), F.lit(1000.0))
    return {
        "total_runs": _n(),
        "successful_runs": ok,
        "failed_runs": failed,
        "etl_success_rate": rate,
        "refresh_health_score": rate * 100.0,
        "total_records_processed": F.sum("records_read"),
        "avg_run_duration_seconds": seconds,
        "avg_run_duration_minutes": seconds / 60.0,
    }


# The positive label of each task.
POSITIVE_LABELS = {"churn": "Will Churn", "default": "Likely Default", "fraud": "Fraud"}
NEGATIVE_LABELS = {"churn": "Will Stay", "default": "Likely Performing", "fraud": "Legitimate"}


def prediction_measures() -> dict[str, Column]:
    fallback = F.count_if("fallback")
    rate = safe_divide(fallback, _n("prediction_id"))
    per_task = {f"{t}_predictions": F.count_if(F.col("task") == t) for t in POSITIVE_LABELS}
    return {
        "total_predictions": _n("prediction_id"),
        "avg_confidence": mean("prediction_score"),
        "avg_latency_ms": mean("inference_ms"),
        "fallback_count": fallback,
        "fallback_rate": rate,
        "prediction_success_rate": F.lit(1.0) - rate,
        **per_task,
        "last_prediction_at": F.max("created_at"),
    }


def predicted_rate_measures() -> dict[str, Column]:
    """Share of a task's predictions that carry its positive label."""
    return {
        f"predicted_{t}_rate": safe_divide(
            F.count_if((F.col("task") == t) & (F.col("prediction_label") == label)), F.count_if(F.col("task") == t)
        )
        for t, label in POSITIVE_LABELS.items()
    }


def training_measures() -> dict[str, Column]:
    best = F.max_by("model_name", F.when(F.col("roc_auc").isNotNull(), F.struct("roc_auc", "model_name")))
    return {
        "avg_accuracy": mean("accuracy"),
        "avg_roc_auc": mean("roc_auc"),
        "avg_f1": mean("f1_score"),
        "avg_precision": mean("precision_score"),
        "avg_recall": mean("recall_score"),
        "avg_training_time": mean("training_seconds"),
        "total_models": _n(),
        "best_roc_auc": F.max("roc_auc"),
        "worst_roc_auc": F.min("roc_auc"),
        "best_model": best,
    }


FEATURE_STORE_FIELDS = {
    "latest_risk_score": "customer_risk_score",
    "latest_churn_rate": "churn_rate",
    "latest_default_rate": "default_rate",
    "latest_fraud_rate": "fraud_rate",
    "avg_debt_ratio": "avg_debt_ratio",
}


def feature_store_measures(columns: Sequence[str], latest: bool = False) -> dict[str, Column]:
    """Maximum over all rows, or the value at the latest date."""
    pick = (lambda c: F.max_by(c, "feature_asof_date")) if latest else F.max
    out = {"total_feature_rows": _n("feature_id")}
    out.update({name: pick(c) for name, c in FEATURE_STORE_FIELDS.items() if c in columns})
    return out


def totals(df: DataFrame, measures: Measures) -> DataFrame:
    """All measures as one row."""
    return df.agg(*[c.alias(n) for n, c in measures.items()])


def measure_by(
    df: DataFrame, category: str | Sequence[str], measures: Measures, order: Sequence[Column] | None = None
) -> DataFrame:
    """Measures per category, sorted by the first measure descending unless told otherwise."""
    keys = [category] if isinstance(category, str) else list(category)
    out = df.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])
    return out.orderBy(*(order or [F.col(next(iter(measures))).desc(), *keys]))


def one_row(*frames: DataFrame) -> DataFrame:
    """Several one-row frames side by side, without a join."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def executive_banner(churn: DataFrame, loans: DataFrame, txns: DataFrame, runs: DataFrame) -> DataFrame:
    """The cross-domain headline row."""
    lost = F.col("churn_flag") == 1
    return one_row(
        churn.agg(
            mean("churn_flag").alias("churn_rate"),
            (sum_where(lost, "monthly_charges") * 12).cast("decimal(38,2)").alias("annual_revenue_at_risk"),
            _n().alias("customers"),
        ),
        loans.agg(
            mean("default_flag").alias("default_rate"),
            sum_where(F.col("default_flag") == 1, "loan_amount").cast("decimal(38,2)").alias("defaulted_principal"),
            _n().alias("loans"),
        ),
        txns.agg(
            mean("is_fraud").alias("fraud_rate"),
            sum_where(F.col("is_fraud") == 1, "transaction_amt").cast("decimal(38,2)").alias("fraud_exposure"),
            _n().alias("transactions"),
        ),
        runs.agg(
            mean(F.coalesce(upper_code("status").isin(*SUCCESS_STATES), F.lit(False)).cast("int")).alias("run_success_rate")
        ),
    )


def daily_snapshot(churn: DataFrame, loans: DataFrame, txns: DataFrame, report_date: str) -> DataFrame:
    """Executive KPI row of a reporting date."""
    row = one_row(
        churn.agg(
            _n().alias("total_customers"),
            F.sum("total_charges").cast("decimal(38,2)").alias("revenue"),
            (mean("churn_flag") * 100.0).alias("churn_rate_pct"),
        ),
        loans.agg(
            F.count_if(F.col("default_flag") == 0).alias("loans_approved"),
            F.count_if(F.col("default_flag") == 1).alias("loans_rejected"),
        ),
        txns.agg(F.count_if(F.col("is_fraud") == 1).alias("fraud_cases")),
    )
    return row.withColumn("reporting_date", F.lit(report_date).cast("date"))


def monitoring_by_model(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("task", "model_name", "model_version").agg(
        _n().alias("predictions"),
        mean("prediction_score").alias("average_score"),
        mean("inference_ms").alias("average_inference_ms"),
        F.max("created_at").alias("latest_prediction_at"),
    )


def feature_snapshot(churn: DataFrame, loans: DataFrame, txns: DataFrame, asof: str) -> DataFrame:
    """One dated row of portfolio aggregates and the composite risk score."""

    def share(cond: Column) -> Column:
        return F.round(F.try_divide(F.count_if(cond), _n()).cast("decimal(20,10)"), 4).cast("decimal(10,4)")

    def average(c: str, digits: int) -> Column:
        exact = F.try_divide(F.sum(c).cast("decimal(28,6)"), F.count(c))
        return F.round(exact, digits).cast(f"decimal(18,{digits})")

    row = one_row(
        churn.agg(
            _n().alias("total_customers"),
            average("tenure", 1).alias("avg_tenure"),
            average("monthly_charges", 2).alias("avg_monthly_charges"),
            average("total_charges", 2).alias("avg_total_charges"),
            average("churn_flag", 4).alias("churn_rate"),
            share(F.col("contract_type") == "Month-to-month").alias("month_to_month_pct"),
        ),
        loans.agg(
            _n().alias("total_loans"),
            average("loan_amount", 2).alias("avg_loan_amount"),
            average("interest_rate", 2).alias("avg_interest_rate"),
            average("default_flag", 4).alias("default_rate"),
            average("debt_ratio", 2).alias("avg_debt_ratio"),
            share(F.col("high_risk") == 1).alias("high_risk_pct"),
        ),
        txns.agg(
            _n().alias("total_transactions"),
            F.count_if(F.col("is_fraud") == 1).alias("fraud_count"),
            average("is_fraud", 4).alias("fraud_rate"),
            average("transaction_amt", 2).alias("avg_transaction_amt"),
        ),
    )
    score = composite_risk("fraud_rate", "default_rate", "churn_rate")
    return row.select(
        F.lit(asof).cast("date").alias("feature_asof_date"), "*", F.round(score.cast("decimal(20,10)"), 4).cast("decimal(10,4)").alias("customer_risk_score")
    )

"""Customer feature store: one row per customer and as-of date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arithmetic import mean
from ..sources.writers import replace_partitions
from .joins import customer_360

# Blend weights and the feature window.
FRAUD_WEIGHT, DEFAULT_WEIGHT, CHURN_WEIGHT = 0.4, 0.3, 0.3
WINDOW_DAYS = 90


def loan_features(loans: DataFrame) -> DataFrame:
    return loans.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("loan_count_total"),
        F.count_if(F.col("default_flag") == 1).alias("default_count"),
        mean("loan_amount").alias("avg_loan_amount"),
        mean("dti").alias("dti_latest"),
        mean("credit_score").alias("credit_score_latest"),
        F.max("issue_date").alias("last_loan_date"),
    )


def transaction_features(txns: DataFrame, asof: str | None = None, window_days: int | None = None) -> DataFrame:
    """Counts and spend, over all rows or the days up to the as-of moment."""
    if asof is not None and window_days is not None:
        end = F.lit(asof).cast("timestamp_ntz")
        ts = F.col("transaction_dt")
        txns = txns.where((ts > end - F.expr(f"interval {window_days} days")) & (ts <= end))
    return txns.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("fraud_count_90d"),
        F.count_if(F.col("is_fraud") == 1).alias("fraud_total"),
        mean("transaction_amt").alias("avg_monthly_spend"),
    )


def latest_scores(predictions: DataFrame) -> DataFrame:
    """Latest default and churn score per customer, in one aggregation.

    ``max_by`` combines before the shuffle and yields both tasks as columns, so
    no window and no second join is needed."""
    newest = F.struct("created_at", "prediction_id")

    def score(task: str):
        return F.max_by("prediction_score", F.when(F.col("task") == task, newest))

    return predictions.where(F.col("task").isin("default", "churn")).groupBy("customer_id").agg(
        score("default").alias("default_probability"), score("churn").alias("churn_probability")
    )


def customer_features(
    customers: DataFrame,
    loans: DataFrame,
    txns: DataFrame,
    predictions: DataFrame,
    asof: str,
    window_days: int | None = None,
) -> DataFrame:
    """Features and blended risk score of every customer.

    ``window_days`` limits transactions to the days before the as-of date;
    without it all transactions count."""
    sides = [
        loan_features(loans),
        transaction_features(txns, asof, window_days),
        latest_scores(predictions),
    ]
    risk = (
        F.lit(FRAUD_WEIGHT) * F.col("fraud_total").cast("double") / F.greatest("fraud_count_90d", F.lit(1)).cast("double")
        + F.lit(DEFAULT_WEIGHT) * F.col("default_probability")
        + F.lit(CHURN_WEIGHT) * F.col("churn_probability")
    )
    joined = customer_360(customers, sides, "customer_id", zero=[])
    out = joined.select(
        "customer_id",
        F.lit(asof).cast("date").alias("feature_asof_date"),
        F.round(risk.cast("decimal(20,10)"), 4).cast("double").alias("customer_risk_score"),
        "avg_monthly_spend", "fraud_count_90d", "fraud_total", "loan_count_total", "default_count", "avg_loan_amount",
        "default_probability", "churn_probability", "dti_latest", "credit_score_latest", "last_loan_date",
    )
    return out.fillna(0, subset=[c for c in out.columns if c != "customer_id"])


def upsert_features(features: DataFrame, target: str) -> None:
    """Write one as-of date; a rerun replaces exactly that date."""
    replace_partitions(features, target, "feature_asof_date")

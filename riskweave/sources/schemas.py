"""Declared schemas of the raw files (an inferred schema costs an extra pass)."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt"


def text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Columns of the raw files, read as text and typed when cleaned.
CHURN_FILE = text_schema(
    "customerID", "tenure", "MonthlyCharges", "TotalCharges", "Contract", "PaymentMethod", "PaperlessBilling",
    "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies", "Churn",
)
LOAN_FILE = text_schema(
    "id", "loan_amnt", "int_rate", "annual_inc", "emp_length", "home_ownership", "grade", "purpose", "term",
    "loan_status", "dti", "fico_range_low", "fico_range_high", "issue_d",
)
MESSAGE = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("amount", T.DecimalType(12, 2)),
        T.StructField("merchant", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
AUDIT = "dag_id string, task_id string, source_table string, target_table string, records_read bigint, " \
    "records_written bigint, records_failed bigint, status string, started_at timestamp, completed_at timestamp, " \
    "error_message string"

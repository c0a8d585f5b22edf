"""Raw files to fact tables, and the row-level tools they share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import arithmetic as A
from ..functions import bands as B
from ..functions import cleaning as C

# Raw column names, status sets and codes.
CHURN_TEXT_COLUMNS = {
    "Contract": "contract_type",
    "PaymentMethod": "payment_method",
    "PaperlessBilling": "paperless_billing",
    "MultipleLines": "multiple_lines",
    "InternetService": "internet_service",
    "OnlineSecurity": "online_security",
    "OnlineBackup": "online_backup",
    "DeviceProtection": "device_protection",
    "TechSupport": "tech_support",
    "StreamingTV": "streaming_tv",
    "StreamingMovies": "streaming_movies",
}
LOAN_COLUMNS = (
    "id", "loan_amnt", "int_rate", "annual_inc", "emp_length", "home_ownership", "grade", "purpose", "term",
    "loan_status", "dti", "fico_range_low", "fico_range_high", "issue_d",
)
LATE_STATUSES = {"Late (16-30 days)": "Late", "Late (31-120 days)": "Late"}
DEFAULT_STATUSES = ("Charged Off", "Default")
TRAINING_DEFAULT_STATUSES = (
    "Charged Off",
    "Default",
    "Does not meet the credit policy. Status:Charged Off",
    "Late (31-120 days)",
)
HIGH_RISK_SCORE = 600
SURROGATE_SOURCES = ("churn", "lending", "fraud")


def column_or_null(df: DataFrame, name: str, type_: str = "string") -> Column:
    """A column, or typed nulls where the file lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(type_)


def dedup_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key: the first in ``order``, or any row without one.

    The rank filter is applied inside each map task before the shuffle (window
    group limit), so a key with very many copies is not gathered in one task.
    """
    if not order:
        return df.dropDuplicates(list(keys))
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).where("_rn = 1").drop("_rn")


def first_identity(identity: DataFrame, order: Sequence[str | Column] | None = None) -> DataFrame:
    """One identity row per transaction: the first in ``order``, by default in
    ascending order of its other columns, so that repeats give the same row always."""
    return dedup_keys(identity, ["TransactionID"], order or [c for c in identity.columns if c != "TransactionID"] or ["TransactionID"])


def replace_blanks(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Empty text or null becomes the column's default."""
    return df.withColumns({c: C.blank_to(c, d) for c, d in defaults.items()})


def fill_categories(df: DataFrame, columns: Sequence[str], default: str = C.UNKNOWN) -> DataFrame:
    """Null categories become ``default``; absent columns are created with it."""
    return df.withColumns({c: C.fill_text(column_or_null(df, c), default) for c in columns})


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns in its order: extras dropped, missing ones null."""
    return df.select(
        *[column_or_null(df, f.name, f.dataType.simpleString()).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def assign_surrogate_id(df: DataFrame, source: str, name: str = "customer_id") -> DataFrame:
    """Unique, not dense, row id; no shuffle.  Sources take turns among the
    numbers, so ids of two sources never meet however many rows there are."""
    return df.withColumn(name, F.monotonically_increasing_id() * len(SURROGATE_SOURCES) + SURROGATE_SOURCES.index(source))


def add_lineage(df: DataFrame, source: str, load_date: str) -> DataFrame:
    return df.withColumns({"source_system": F.lit(source), "etl_date": F.lit(load_date)})


def pack_columns(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Fold groups of wide columns into one JSON text each."""
    packed = {c for columns in groups.values() for c in columns}
    keep = [c for c in df.columns if c not in packed]
    return df.select(*keep, *[F.to_json(F.struct(*cols)).alias(name) for name, cols in groups.items()])


def clean_churn(raw: DataFrame) -> DataFrame:
    """Churn fact: one row per customer, typed charges, label, tenure group."""
    tenure = C.to_number("tenure", "int", 0)
    monthly = C.to_number("MonthlyCharges", "decimal(8,2)", 0)
    churned = F.coalesce(F.col("Churn") == "Yes", F.lit(False))
    return dedup_keys(raw, ["customerID"], ["tenure", "TotalCharges", "Churn"]).select(
        F.col("customerID").alias("customer_id"),
        tenure.alias("tenure"),
        monthly.alias("monthly_charges"),
        C.to_number("TotalCharges", "decimal(10,2)", 0).alias("total_charges"),
        *[column_or_null(raw, old).alias(new) for old, new in CHURN_TEXT_COLUMNS.items()],
        F.when(churned, F.lit("Yes")).otherwise(F.lit("No")).alias("churn_label"),
        churned.cast("int").alias("churn_flag"),
        F.when(tenure > 0, F.round(monthly / F.lit(30), 4)).otherwise(F.lit(0)).cast("decimal(10,4)").alias("avg_daily_charge"),
        B.tenure_group(tenure).alias("tenure_group"),
        F.lit("churn").alias("source_system"),
    )


def clean_loans(raw: DataFrame) -> DataFrame:
    """Loan fact.  Rates are percent; the credit score is the mean of the range."""
    amount = C.to_number("loan_amnt", "decimal(12,2)", 0)
    income = C.to_number("annual_inc", "decimal(12,2)", 0)
    rate = C.parse_percent("int_rate", type_="decimal(5,2)")
    score = A.credit_score(C.to_number("fico_range_low"), C.to_number("fico_range_high"))
    status = C.recode("loan_status", LATE_STATUSES)
    return dedup_keys(raw, ["id"], ["loan_amnt", "loan_status"]).select(
        C.to_number("id", "bigint").alias("loan_id_orig"),
        amount.alias("loan_amount"),
        rate.alias("interest_rate"),
        income.alias("annual_income"),
        F.col("emp_length").alias("employment_length"),
        "home_ownership",
        "grade",
        "purpose",
        "term",
        status.alias("loan_status"),
        C.to_number("dti", "decimal(7,2)", 0).alias("dti"),
        score.alias("credit_score"),
        C.parse_month("issue_d").alias("issue_date"),
        C.membership_flag(status, DEFAULT_STATUSES).alias("default_flag"),
        A.ratio_if_positive(amount, income, 4).alias("debt_ratio"),
        (score < HIGH_RISK_SCORE).cast("int").alias("high_risk"),
        B.rate_bucket(rate).alias("interest_rate_bucket"),
        F.lit("lending").alias("source_system"),
    )


def clean_transactions(raw: DataFrame, identity: DataFrame | None = None, log_default: float = 0.0) -> DataFrame:
    """Transaction fact: identity attached, numbers coerced, log amount, time."""
    joined = raw
    if identity is not None:
        joined = raw.join(first_identity(identity), "TransactionID", "left")
    joined = dedup_keys(joined, ["TransactionID"], ["TransactionDT", "TransactionAmt"])
    amount = C.to_number("TransactionAmt", "decimal(12,2)", 0)

    def whole(name: str) -> Column:
        return C.to_number(column_or_null(joined, name), "double").cast("bigint").alias(name)

    def text(name: str, alias: str | None = None) -> Column:
        return column_or_null(joined, name).cast("string").alias(alias or name)

    return joined.select(
        C.to_number("TransactionID", "bigint").alias("transaction_id"),
        amount.alias("transaction_amt"),
        text("ProductCD", "product_cd"),
        whole("card1"), whole("card2"), whole("card3"), text("card4"), whole("card5"), text("card6"),
        whole("addr1"), whole("addr2"),
        C.to_number(column_or_null(joined, "dist1"), "decimal(10,2)", 0).alias("dist1"),
        C.to_number(column_or_null(joined, "dist2"), "decimal(10,2)", 0).alias("dist2"),
        text("DeviceType", "device_type"),
        text("DeviceInfo", "device_info"),
        text("P_emaildomain", "email_domain"),
        C.to_number("isFraud", "int").alias("is_fraud"),
        A.log_amount(amount, log_default).alias("transaction_amt_log"),
        C.offset_timestamp(C.to_number("TransactionDT", "bigint")).alias("transaction_dt"),
        F.lit("fraud").alias("source_system"),
    )

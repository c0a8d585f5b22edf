"""Readers and writers, over files that Spark writes from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import to_number
from ..operators import features as FS
from ..session import work_dir
from ..sources import audited_write, read_csv, read_gzip_csv, read_model_metadata, read_table, replace_partitions, write_table
from ..sources.schemas import CORRUPT, LOAN_FILE
from .cleaning_queries import raw_loans
from .kpi_queries import TRAINING_SQL, training_table
from .registry import query
from .window_queries import FEATURES_SQL, LATEST_P

CUSTOMER_FILE = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()), T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DoubleType()), T.StructField("c_mktsegment", T.StringType()),
])
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def customer_csv(t, **options) -> str:
    path = work_dir(t.spark, "customer-csv")
    t.raw("customer").write.option("header", True).options(**options).csv(path)
    return path


@query("scan_csv", "", CUSTOMER_SQL)
def scan_csv(t):
    return read_csv(t.spark, customer_csv(t), CUSTOMER_FILE)


@query("scan_csv_inferred", "", "SELECT c_custkey::BIGINT AS c_custkey, c_name, c_acctbal FROM customer")
def scan_csv_inferred(t):
    df = read_csv(t.spark, customer_csv(t), columns=["c_custkey", "c_name", "c_acctbal"])
    return df.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("scan_csv_corrupt", "", """
 SELECT count(*) FILTER (WHERE c_custkey%7=0) AS bad_rows, count(*) FILTER (WHERE c_custkey%7<>0) AS good_rows,
  sum(c_custkey) FILTER (WHERE c_custkey%7<>0)::BIGINT AS key_sum FROM customer""")
def scan_csv_corrupt(t):
    """Rows whose number columns hold text are kept with their raw text."""
    path = work_dir(t.spark, "broken-csv")
    k = F.col("c_custkey")
    t.raw("customer").select(
        F.when(k % 7 == 0, F.lit("oops")).otherwise(k.cast("string")).alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    ).write.option("header", True).csv(path)
    df = read_csv(t.spark, path, CUSTOMER_FILE, keep_corrupt=True)
    bad = F.col(CORRUPT).isNotNull()
    return df.agg(
        F.count_if(bad).alias("bad_rows"), F.count_if(~bad).alias("good_rows"), F.sum(F.when(~bad, F.col("c_custkey"))).alias("key_sum")
    )


@query("scan_csv_columns", "loans", "SELECT loan_id AS id, grade, loan_amount FROM loans")
def scan_csv_columns(t):
    path = work_dir(t.spark, "loans-csv")
    raw_loans(t).write.option("header", True).csv(path)
    df = read_csv(t.spark, path, LOAN_FILE, columns=["id", "grade", "loan_amnt"])
    return df.select(to_number("id", "bigint").alias("id"), "grade", to_number("loan_amnt", "decimal(12,2)").alias("loan_amount"))


@query("scan_gzip_csv", "", CUSTOMER_SQL)
def scan_gzip_csv(t):
    return read_gzip_csv(t.spark, customer_csv(t, compression="gzip"), CUSTOMER_FILE)


@query("scan_table", "", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate>=TIMESTAMP '1998-01-01'")
def scan_table(t):
    df = read_table(t.spark, f"{t.dir}/orders.parquet")
    return df.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_custkey", "o_totalprice")


@query("scan_model_metadata", "model_runs", f"""WITH {TRAINING_SQL}
 SELECT model_name, 'default' AS task, algorithm, '2.0.0' AS version, CAST(accuracy AS DECIMAL(6,4)) AS accuracy,
  CAST(precision_score AS DECIMAL(6,4)) AS precision_score, CAST(recall_score AS DECIMAL(6,4)) AS recall_score,
  CAST(f1_score AS DECIMAL(6,4)) AS f1_score, CAST(roc_auc AS DECIMAL(6,4)) AS roc_auc, CAST(0.5 AS DECIMAL(6,4)) AS threshold,
  CAST(training_seconds AS DECIMAL(8,2)) AS training_seconds, '["fico_score","grade"]' AS features, 'default_flag' AS target FROM training""")
def scan_model_metadata(t):
    """Metadata documents written one per model, read back as training records."""
    path = work_dir(t.spark, "metadata")
    docs = training_table(t).select(
        F.col("model_name").alias("name"), "task", "algorithm", "version", F.lit(0.5).alias("threshold"),
        F.struct("accuracy", F.col("precision_score").alias("precision"), F.col("recall_score").alias("recall"),
                 F.col("f1_score").alias("f1"), "roc_auc", "training_seconds").alias("metrics"),
        F.array(F.lit("fico_score"), F.lit("grade")).alias("features"), F.lit("default_flag").alias("target"), F.col("model_name").alias("file"),
    )
    docs.write.partitionBy("file").json(path)
    return read_model_metadata(t.spark, f"{path}/*/*.json")


@query("sink_table", "", "SELECT 'all' AS part, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders")
def sink_table(t):
    """Overwrite twice with the even keys, then append the odd ones."""
    target, orders = work_dir(t.spark, "sink"), t.raw("orders")
    for mode, rest in (("overwrite", 0), ("overwrite", 0), ("append", 1)):
        write_table(orders.where(F.col("o_orderkey") % 2 == rest), target, mode)
    return read_table(t.spark, target).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")).select(F.lit("all").alias("part"), "n", "keys")


@query("sink_daily_partition", "txns", """
 SELECT CAST(transaction_dt AS DATE) AS ds, count(*) AS n, sum(transaction_amt)::DECIMAL(38,2) AS amount FROM txns GROUP BY 1""")
def sink_daily_partition(t):
    """All days, then a rerun of some of them: every day is present once."""
    target = work_dir(t.spark, "daily")
    rows = t.txns().withColumn("ds", F.to_date("transaction_dt"))
    replace_partitions(rows, target, "ds")
    replace_partitions(rows.where(F.dayofmonth("ds") <= 10), target, "ds")
    return read_table(t.spark, target).groupBy("ds").agg(F.count(F.lit(1)).alias("n"), F.sum("transaction_amt").cast("decimal(38,2)").alias("amount"))


@query("run_audit", "", """
 SELECT 'load_orders' AS task_id, 'orders' AS source_table, count(*) AS records_read, count(*) FILTER (WHERE o_orderkey%11<>0) AS records_written,
  count(*) FILTER (WHERE o_orderkey%11=0) AS records_failed, 'SUCCESS' AS status, true AS ordered FROM orders""")
def run_audit(t):
    target, log = work_dir(t.spark, "audited"), work_dir(t.spark, "audit")
    audited_write(t.raw("orders"), target, log, dag="daily", task="load_orders", source="orders", bad=F.col("o_orderkey") % 11 == 0)
    row = read_table(t.spark, log)
    return row.select(
        "task_id", "source_table", "records_read", "records_written", "records_failed", "status",
        (F.col("started_at") <= F.col("completed_at")).alias("ordered"),
    )


@query("feature_store_upsert", "loans txns predictions", "WITH " + LATEST_P.format(where="") + f"""
 SELECT feature_asof_date, count(*) AS n, sum(loan_count_total)::BIGINT AS loans FROM (
  {FEATURES_SQL.format(asof='2024-01-24')} UNION ALL {FEATURES_SQL.format(asof='2024-01-25')}) GROUP BY 1""")
def feature_store_upsert(t):
    """Two dates, the second one written twice: each date is there once."""
    target = work_dir(t.spark, "features")
    customers = t.raw("customer").select(F.col("c_custkey").alias("customer_id"))
    for asof in ("2024-01-24", "2024-01-25", "2024-01-25"):
        FS.upsert_features(FS.customer_features(customers, t.loans_core(), t.txns(), t.predictions(), asof), target)
    out = read_table(t.spark, target)
    return out.groupBy("feature_asof_date").agg(F.count(F.lit(1)).alias("n"), F.sum("loan_count_total").alias("loans"))

"""Risk-domain views over the test tables, in Spark and in SQL.

The test tables are a generic star schema; these projections give them the
shape of a bank's fact tables.  ``Tables`` builds them lazily, ``VIEWS`` holds
the same projections as SQL common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bands import tenure_group

# Category domains of the reports.
CONTRACTS = ("Month-to-month", "One year", "Two year")
INTERNET = ("DSL", "Fiber optic", "No")
HOMES = ("RENT", "MORTGAGE", "OWN", "OTHER")
PAYMENTS = {
    "BUILDING": "Electronic check",
    "MACHINERY": "Mailed check",
    "AUTOMOBILE": "Bank transfer (automatic)",
    "FURNITURE": "Credit card (automatic)",
    "HOUSEHOLD": "Electronic check",
}
# Sample values of our own; some are among those that the scorecards name.
DOMAINS = ("mail.example", "gmail.com", "outlook.com", "post.example", "yahoo.com", "web.example")
NETWORKS = ("visa", "discover", "maestro", "jcb")
PRODUCTS = ("fuel", "gift", "cash", "shop", "trip")
DEVICES = {"click": "mobile", "signup": "mobile", "view": "desktop", "purchase": "desktop"}


def pick(values, index):
    """The index-th of some fixed values."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def from_map(mapping, c):
    """Fixed lookup as an expression; misses are null."""
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out


def yes_no(cond):
    return F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))


class Tables:
    """Lazy access to the raw tables and the domain views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def loans_core(self) -> DataFrame:
        """Loan columns that need no customer attribute: no join, no shuffle."""
        digit = F.substring("o_orderpriority", 1, 1).cast("int")
        score = (F.lit(550) + F.col("o_orderkey") % 300).cast("int")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("loan_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("loan_amount"),
            F.translate(F.substring("o_orderpriority", 1, 1), "12345", "ABCDE").alias("grade"),
            F.col("o_orderstatus").alias("loan_status"),
            (F.col("o_orderstatus") == "F").cast("int").alias("default_flag"),
            F.col("o_orderdate").cast("date").alias("issue_date"),
            (F.lit(5) + digit * 2).cast("decimal(5,2)").alias("interest_rate"),
            score.alias("credit_score"),
            (F.col("o_orderkey") % 45).cast("int").alias("dti"),
            pick(HOMES, F.col("o_custkey") % 4).alias("home_ownership"),
            F.when(F.col("o_orderkey") % 3 == 0, F.lit(" 60 months")).otherwise(F.lit(" 36 months")).alias("term"),
            (score < 600).cast("int").alias("high_risk"),
        )

    def loans(self) -> DataFrame:
        """Loans with the borrower's purpose and income."""
        income = (F.col("c_acctbal").cast("decimal(12,2)") * 10).cast("decimal(14,2)")
        borrower = self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("purpose"), income.alias("annual_income")
        )
        return self.loans_core().join(borrower, "customer_id", "left")

    def subscribers(self) -> DataFrame:
        k = F.col("c_custkey")
        tenure = (k % 73).cast("int")
        monthly = (F.lit(20) + k % 100).cast("decimal(8,2)")
        return self.raw("customer").select(
            k.alias("customer_id"),
            tenure.alias("tenure"),
            monthly.alias("monthly_charges"),
            (tenure * monthly).cast("decimal(10,2)").alias("total_charges"),
            pick(CONTRACTS, k % 3).alias("contract_type"),
            from_map(PAYMENTS, F.col("c_mktsegment")).alias("payment_method"),
            pick(INTERNET, F.col("c_nationkey") % 3).alias("internet_service"),
            yes_no(k % 2 == 0).alias("paperless_billing"),
            yes_no(k % 5 < 2).alias("tech_support"),
            yes_no(k % 7 < 3).alias("online_security"),
            yes_no(k % 11 < 5).alias("streaming_tv"),
            (F.col("c_acctbal") < 2000).cast("int").alias("churn_flag"),
            ((k % 97).cast("double") / F.lit(97.0)).alias("churn_probability"),
            tenure_group(tenure).alias("tenure_group"),
        )

    def txns(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_id").alias("transaction_id"),
            F.col("user_id").alias("customer_id"),
            F.col("user_id").alias("card1"),
            F.col("ts").alias("transaction_dt"),
            F.col("value").cast("decimal(12,2)").alias("transaction_amt"),
            from_map(DEVICES, F.col("event_type")).alias("device_type"),
            ((F.col("event_id") % 29 == 0) | (F.col("value") > 200)).cast("int").alias("is_fraud"),
            pick(DOMAINS, F.col("user_id") % 6).alias("email_domain"),
            pick(NETWORKS, F.col("user_id") % 4).alias("card4"),
            F.when(F.col("event_id") % 2 == 0, F.lit("debit")).otherwise(F.lit("credit")).alias("card6"),
            pick(PRODUCTS, F.col("event_id") % 5).alias("product_cd"),
            "props",
        )

    def ledger_raw(self) -> DataFrame:
        """Card rows with many equal times and repeated keys."""
        return self.raw("lineitem").select(
            F.col("l_suppkey").alias("card1"),
            F.col("l_shipdate").alias("transaction_dt"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("transaction_amt"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_id"),
            F.col("l_partkey").alias("part_id"),
        )

    def identity(self) -> DataFrame:
        """One device record per customer, each stored twice, some absent."""
        base = self.raw("customer").where(F.col("c_custkey") % 3 != 0)
        return base.select(
            F.col("c_custkey").alias("card1"),
            F.explode(F.array(F.lit(1), F.lit(2))).alias("copy_no"),
            F.col("c_mktsegment").alias("device_info"),
            F.col("c_nationkey").alias("addr1"),
        )

    def stream_txns(self) -> DataFrame:
        return self.raw("events").select(
            F.concat(F.lit("t-"), F.col("event_id").cast("string")).alias("transaction_id"),
            F.concat(F.lit("ACC-"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("account_id"),
            F.col("value").cast("decimal(12,2)").alias("amount"),
            F.concat(F.lit("merchant-"), (F.col("event_id") % 22).cast("string")).alias("merchant"),
            F.col("event_type").alias("category"),
            F.concat(F.lit("city-"), (F.col("user_id") % 15).cast("string")).alias("city"),
            ((F.col("event_id") % 29 == 0) | (F.col("value") > 200)).alias("is_fraud"),
            F.col("ts").alias("transaction_ts"),
        )

    def runs(self) -> DataFrame:
        line = self.raw("lineitem").groupBy("l_orderkey").agg(
            F.max("l_shipdate").alias("completed_at"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("records_read"),
        )
        k = F.col("o_orderkey") % 12
        status = (
            F.when(k == 0, F.lit("FAILED"))
            .when(k == 1, F.lit(" failed"))
            .when(k == 2, F.lit("running"))
            .when(k == 3, F.lit("Completed "))
            .when(k == 4, F.lit(" success"))
            .otherwise(F.lit("SUCCESS"))
        )
        bad = F.when(k < 2, F.col("records_read")).otherwise(F.lit(0).cast("bigint"))
        return self.raw("orders").join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
            F.col("o_orderkey").alias("run_id"),
            F.lit("daily_load").alias("dag_id"),
            F.col("o_orderpriority").alias("task_id"),
            F.col("o_orderstatus").alias("target_table"),
            status.alias("status"),
            F.col("o_orderdate").alias("started_at"),
            "completed_at",
            "records_read",
            (F.col("records_read") - bad).alias("records_written"),
            bad.alias("records_failed"),
            F.when(k < 2, F.concat(F.lit("bad rows in "), F.col("o_orderstatus"))).alias("error_message"),
        )

    def scores(self) -> DataFrame:
        k = F.col("o_orderkey")
        y = (F.col("o_orderstatus") == "F").cast("int")
        return self.raw("orders").select(
            k.alias("id"), y.alias("y"),
            (((k * 7919) % 10007 + y * 2500).cast("double") / F.lit(12507.0)).alias("score"),
        )

    def predictions(self) -> DataFrame:
        k, y = F.col("o_orderkey"), F.lit(0.5)
        spread = ((k * 7919) % 10007).cast("double") / F.lit(10007.0)
        fallback = k % 5 == 0
        loans = self.raw("orders").select(
            (k * 3).alias("prediction_id"), F.col("o_custkey").alias("customer_id"), F.lit("default").alias("task"),
            F.when(fallback, F.lit("heuristic_default_baseline")).otherwise(F.lit("risk_default")).alias("model_name"),
            F.when(fallback, F.lit("0.1.0")).otherwise(F.lit("2.0.0")).alias("model_version"),
            F.when(spread >= y, F.lit("Likely Default")).otherwise(F.lit("Likely Performing")).alias("prediction_label"),
            spread.alias("prediction_score"), (k % 40 + 5).cast("int").alias("inference_ms"),
            fallback.alias("fallback"), F.col("o_orderdate").alias("created_at"),
        )
        c = F.col("c_custkey")
        p = (c % 97).cast("double") / F.lit(97.0)
        churn = self.raw("customer").select(
            (c * 3 + 1).alias("prediction_id"), c.alias("customer_id"), F.lit("churn").alias("task"),
            F.lit("risk_churn").alias("model_name"), F.lit("2.0.0").alias("model_version"),
            F.when(p >= y, F.lit("Will Churn")).otherwise(F.lit("Will Stay")).alias("prediction_label"),
            p.alias("prediction_score"), (c % 30 + 3).cast("int").alias("inference_ms"),
            F.lit(False).alias("fallback"), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz").alias("created_at"),
        )
        e = F.col("event_id")
        q = ((e * 31) % 1009).cast("double") / F.lit(1009.0)
        fraud = self.raw("events").select(
            (e * 3 + 2).alias("prediction_id"), F.col("user_id").alias("customer_id"), F.lit("fraud").alias("task"),
            F.lit("risk_fraud").alias("model_name"), F.lit("2.0.0").alias("model_version"),
            F.when(q >= y, F.lit("Fraud")).otherwise(F.lit("Legitimate")).alias("prediction_label"),
            q.alias("prediction_score"), (e % 60 + 2).cast("int").alias("inference_ms"),
            (e % 7 == 0).alias("fallback"), F.col("ts").alias("created_at"),
        )
        return loans.unionByName(churn).unionByName(fraud)

    def model_runs(self) -> DataFrame:
        """One training record per (task, algorithm), derived from the scores by grade."""
        from ..operators.evaluation import threshold_counts

        scored = self.raw("orders").select(
            F.substring("o_orderpriority", 1, 1).alias("algorithm"),
            (F.col("o_orderstatus") == "F").cast("int").alias("y"),
            (((F.col("o_orderkey") * 7919) % 10007 + (F.col("o_orderstatus") == "F").cast("int") * 2500).cast("double")
             / F.lit(12507.0)).alias("score"),
        )
        return threshold_counts(scored, "y", "score", 0.5, by=["algorithm"])

    def snapshots(self) -> DataFrame:
        """Feature-store style rows: one per issue month."""
        from ..functions.arithmetic import mean

        return self.loans_core().groupBy(F.trunc("issue_date", "month").alias("feature_asof_date")).agg(
            mean("default_flag").alias("default_rate"),
            mean("high_risk").alias("customer_risk_score"),
            mean("dti").alias("avg_debt_ratio"),
            F.count(F.lit(1)).alias("feature_id"),
        )


VIEWS = {
    "loans": """
 SELECT o_orderkey AS loan_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(12,2)) AS loan_amount,
  translate(substr(o_orderpriority,1,1),'12345','ABCDE') AS grade, c_mktsegment AS purpose, o_orderstatus AS loan_status,
  CAST(o_orderstatus='F' AS INTEGER) AS default_flag, CAST(o_orderdate AS DATE) AS issue_date,
  CAST(CAST(c_acctbal AS DECIMAL(12,2))*10 AS DECIMAL(14,2)) AS annual_income,
  CAST(5+2*CAST(substr(o_orderpriority,1,1) AS INTEGER) AS DECIMAL(5,2)) AS interest_rate,
  CAST(550+o_orderkey%300 AS INTEGER) AS credit_score, CAST(o_orderkey%45 AS INTEGER) AS dti,
  CASE o_custkey%4 WHEN 0 THEN 'RENT' WHEN 1 THEN 'MORTGAGE' WHEN 2 THEN 'OWN' ELSE 'OTHER' END AS home_ownership,
  CASE WHEN o_orderkey%3=0 THEN ' 60 months' ELSE ' 36 months' END AS term,
  CAST(550+o_orderkey%300<600 AS INTEGER) AS high_risk
 FROM orders LEFT JOIN customer ON o_custkey=c_custkey""",
    "subscribers": """
 SELECT c_custkey AS customer_id, CAST(c_custkey%73 AS INTEGER) AS tenure,
  CAST(20+c_custkey%100 AS DECIMAL(8,2)) AS monthly_charges,
  CAST((c_custkey%73)*(20+c_custkey%100) AS DECIMAL(10,2)) AS total_charges,
  CASE c_custkey%3 WHEN 0 THEN 'Month-to-month' WHEN 1 THEN 'One year' ELSE 'Two year' END AS contract_type,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Electronic check' WHEN 'MACHINERY' THEN 'Mailed check'
   WHEN 'AUTOMOBILE' THEN 'Bank transfer (automatic)' WHEN 'FURNITURE' THEN 'Credit card (automatic)'
   WHEN 'HOUSEHOLD' THEN 'Electronic check' END AS payment_method,
  CASE c_nationkey%3 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' ELSE 'No' END AS internet_service,
  CASE WHEN c_custkey%2=0 THEN 'Yes' ELSE 'No' END AS paperless_billing,
  CASE WHEN c_custkey%5<2 THEN 'Yes' ELSE 'No' END AS tech_support,
  CASE WHEN c_custkey%7<3 THEN 'Yes' ELSE 'No' END AS online_security,
  CASE WHEN c_custkey%11<5 THEN 'Yes' ELSE 'No' END AS streaming_tv,
  CAST(c_acctbal<2000 AS INTEGER) AS churn_flag, CAST(c_custkey%97 AS DOUBLE)/97 AS churn_probability,
  CASE WHEN c_custkey%73<=6 THEN '0-6 months' WHEN c_custkey%73<=12 THEN '6-12 months'
   WHEN c_custkey%73<=24 THEN '12-24 months' WHEN c_custkey%73<=48 THEN '24-48 months' ELSE '48+ months' END AS tenure_group
 FROM customer""",
    "txns": """
 SELECT event_id AS transaction_id, user_id AS customer_id, user_id AS card1, ts AS transaction_dt,
  CAST(value AS DECIMAL(12,2)) AS transaction_amt,
  CASE event_type WHEN 'click' THEN 'mobile' WHEN 'signup' THEN 'mobile' WHEN 'view' THEN 'desktop'
   WHEN 'purchase' THEN 'desktop' END AS device_type,
  CAST(event_id%29=0 OR value>200 AS INTEGER) AS is_fraud,
  CASE user_id%6 WHEN 0 THEN 'mail.example' WHEN 1 THEN 'gmail.com' WHEN 2 THEN 'outlook.com' WHEN 3 THEN 'post.example'
   WHEN 4 THEN 'yahoo.com' ELSE 'web.example' END AS email_domain,
  CASE user_id%4 WHEN 0 THEN 'visa' WHEN 1 THEN 'discover' WHEN 2 THEN 'maestro' ELSE 'jcb' END AS card4,
  CASE WHEN event_id%2=0 THEN 'debit' ELSE 'credit' END AS card6,
  CASE event_id%5 WHEN 0 THEN 'fuel' WHEN 1 THEN 'gift' WHEN 2 THEN 'cash' WHEN 3 THEN 'shop' ELSE 'trip' END AS product_cd, props
 FROM events""",
    "ledger_raw": """
 SELECT l_suppkey AS card1, l_shipdate AS transaction_dt, CAST(l_extendedprice AS DECIMAL(12,2)) AS transaction_amt,
  l_orderkey AS order_id, l_linenumber AS line_id, l_partkey AS part_id FROM lineitem""",
    "ledger": """
 SELECT card1, transaction_dt, transaction_amt, order_id, line_id FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, line_id
   ORDER BY part_id, card1, transaction_dt, transaction_amt) AS rn FROM ledger_raw) WHERE rn=1""",
    "identity": """
 SELECT c_custkey AS card1, copy_no, c_mktsegment AS device_info, c_nationkey AS addr1
 FROM customer, (VALUES (1),(2)) v(copy_no) WHERE c_custkey%3<>0""",
    "stream_txns": """
 SELECT 't-'||CAST(event_id AS VARCHAR) AS transaction_id, 'ACC-'||lpad(CAST(user_id AS VARCHAR),5,'0') AS account_id,
  CAST(value AS DECIMAL(12,2)) AS amount, 'merchant-'||CAST(event_id%22 AS VARCHAR) AS merchant, event_type AS category,
  'city-'||CAST(user_id%15 AS VARCHAR) AS city, (event_id%29=0 OR value>200) AS is_fraud, ts AS transaction_ts
 FROM events""",
    "runs": """
 SELECT o_orderkey AS run_id, 'daily_load' AS dag_id, o_orderpriority AS task_id, o_orderstatus AS target_table,
  CASE o_orderkey%12 WHEN 0 THEN 'FAILED' WHEN 1 THEN ' failed' WHEN 2 THEN 'running' WHEN 3 THEN 'Completed '
   WHEN 4 THEN ' success' ELSE 'SUCCESS' END AS status,
  o_orderdate AS started_at, completed_at, records_read,
  CASE WHEN o_orderkey%12<2 THEN records_read-records_read ELSE records_read END AS records_written,
  CASE WHEN o_orderkey%12<2 THEN records_read ELSE 0 END AS records_failed,
  CASE WHEN o_orderkey%12<2 THEN 'bad rows in '||o_orderstatus END AS error_message
 FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS completed_at,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS records_read FROM lineitem GROUP BY 1) ON o_orderkey=l_orderkey""",
    "scores": """
 SELECT o_orderkey AS id, CAST(o_orderstatus='F' AS INTEGER) AS y,
  CAST((o_orderkey*7919)%10007 + 2500*CAST(o_orderstatus='F' AS INTEGER) AS DOUBLE)/12507 AS score FROM orders""",
    "predictions": """
 SELECT o_orderkey*3 AS prediction_id, o_custkey AS customer_id, 'default' AS task,
  CASE WHEN o_orderkey%5=0 THEN 'heuristic_default_baseline' ELSE 'risk_default' END AS model_name,
  CASE WHEN o_orderkey%5=0 THEN '0.1.0' ELSE '2.0.0' END AS model_version,
  CASE WHEN CAST((o_orderkey*7919)%10007 AS DOUBLE)/10007>=0.5 THEN 'Likely Default' ELSE 'Likely Performing' END AS prediction_label,
  CAST((o_orderkey*7919)%10007 AS DOUBLE)/10007 AS prediction_score, CAST(o_orderkey%40+5 AS INTEGER) AS inference_ms,
  o_orderkey%5=0 AS fallback, o_orderdate AS created_at FROM orders
 UNION ALL SELECT c_custkey*3+1, c_custkey, 'churn', 'risk_churn', '2.0.0',
  CASE WHEN CAST(c_custkey%97 AS DOUBLE)/97>=0.5 THEN 'Will Churn' ELSE 'Will Stay' END,
  CAST(c_custkey%97 AS DOUBLE)/97, CAST(c_custkey%30+3 AS INTEGER), FALSE, TIMESTAMP '2024-01-15 00:00:00' FROM customer
 UNION ALL SELECT event_id*3+2, user_id, 'fraud', 'risk_fraud', '2.0.0',
  CASE WHEN CAST((event_id*31)%1009 AS DOUBLE)/1009>=0.5 THEN 'Fraud' ELSE 'Legitimate' END,
  CAST((event_id*31)%1009 AS DOUBLE)/1009, CAST(event_id%60+2 AS INTEGER), event_id%7=0, ts FROM events""",
    "model_runs": """
 SELECT substr(o_orderpriority,1,1) AS algorithm, CAST(count(*) FILTER (WHERE y=1 AND score>=0.5) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE y=0 AND score>=0.5) AS BIGINT) AS fp, CAST(count(*) FILTER (WHERE y=0 AND score<0.5) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE y=1 AND score<0.5) AS BIGINT) AS fn
 FROM scores JOIN orders ON id=o_orderkey GROUP BY 1""",
    "snapshots": """
 SELECT CAST(date_trunc('month', issue_date) AS DATE) AS feature_asof_date,
  CAST(sum(default_flag) AS DOUBLE)/count(*) AS default_rate, CAST(sum(high_risk) AS DOUBLE)/count(*) AS customer_risk_score,
  CAST(sum(dti) AS DOUBLE)/count(*) AS avg_debt_ratio, count(*) AS feature_id FROM loans GROUP BY 1""",
}
NEEDS = {"ledger": ["ledger_raw"], "model_runs": ["scores"], "snapshots": ["loans"]}


def with_views(body: str, views: str) -> str:
    """Prefix a query with the views it names (and those they need)."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in views.split():
        add(name)
    body = body.strip()
    if not ordered:
        return body
    head = "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    if body[:5].upper() == "WITH ":
        return f"{head},\n{body[5:]}"
    return f"{head}\n{body}"

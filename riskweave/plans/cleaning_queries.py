"""Typing, cleaning, bands, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import arithmetic as A
from ..functions import bands as B
from ..functions import cleaning as C
from ..functions import validation as V
from ..operators import cleaning as K
from ..operators import joins as J
from .domain import from_map
from .registry import query

# The report palette (position -> color).
PALETTE = dict(enumerate((
    "#5DA5DA", "#FAA43A", "#60BD68", "#F17CB0", "#B2912F", "#B276B2", "#DECF3F", "#F15854", "#88BDE6", "#FBB258",
    "#90CD97", "#F6AAC9", "#BFA554", "#BC99C7", "#EDDD46", "#F07E6E", "#265DAB", "#DF5C24", "#059748", "#E5126F",
    "#9D722A", "#7B3A96", "#C7B42E", "#CB2027",
), start=1))


def messy_amounts(t):
    """Amounts as text: padded, blank or not a number."""
    amount = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    k = F.col("o_orderkey") % 10
    text = F.when(k == 0, F.lit("  ")).when(k == 1, F.lit("n/a")).when(k == 2, F.concat(F.lit("  "), amount, F.lit(" "))).otherwise(amount)
    return t.raw("orders").select(F.col("o_orderkey").alias("id"), text.alias("amount_text"))


MESSY = """WITH messy AS (SELECT o_orderkey AS id, CASE o_orderkey%10 WHEN 0 THEN '  ' WHEN 1 THEN 'n/a'
 WHEN 2 THEN '  '||CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)||' '
 ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount_text FROM orders)"""


@query("coerce_numeric", "", f"""{MESSY}
 SELECT id, TRY_CAST(trim(amount_text) AS DOUBLE) AS amount, coalesce(TRY_CAST(trim(amount_text) AS DOUBLE),0) AS amount_or_zero,
  CAST(NULL AS DOUBLE) AS absent FROM messy""")
def coerce_numeric(t):
    df = messy_amounts(t)
    return df.select(
        "id", C.to_number("amount_text").alias("amount"), C.to_number("amount_text", default=0.0).alias("amount_or_zero"),
        C.to_number(K.column_or_null(df, "not_there")).alias("absent"),
    )


@query("parse_percent", "", """
 SELECT o_orderkey AS id, TRY_CAST(replace(txt,'%','') AS DOUBLE) AS rate, TRY_CAST(replace(txt,'%','') AS DOUBLE)*0.01::DOUBLE AS fraction
 FROM (SELECT o_orderkey, CASE WHEN o_orderkey%11=0 THEN 'n.a.%' ELSE CAST(CAST(5+(o_orderkey%2000)/100.0 AS DECIMAL(6,2)) AS VARCHAR)||'%' END AS txt FROM orders)""")
def parse_percent(t):
    value = (F.lit(500) + F.col("o_orderkey") % 2000).cast("decimal(10,0)") / F.lit(100).cast("decimal(3,0)")
    text = F.when(F.col("o_orderkey") % 11 == 0, F.lit("n.a.%")).otherwise(
        F.concat(value.cast("decimal(6,2)").cast("string"), F.lit("%"))
    )
    df = t.raw("orders").select(F.col("o_orderkey").alias("id"), text.alias("txt"))
    return df.select("id", C.parse_percent("txt").alias("rate"), C.parse_percent("txt", 0.01).alias("fraction"))


@query("parse_emp_length", "", """
 SELECT id, CASE WHEN trim(txt) LIKE '<%' THEN 0.0::DOUBLE ELSE TRY_CAST(regexp_extract(trim(txt),'(\\d+)',1) AS DOUBLE) END AS years
 FROM (SELECT o_orderkey AS id, CASE o_orderkey%13 WHEN 0 THEN ' < 1 year' WHEN 11 THEN '10+ years' WHEN 12 THEN 'n/a'
  ELSE CAST(o_orderkey%13 AS VARCHAR)||' years' END AS txt FROM orders)""")
def parse_emp_length(t):
    k = F.col("o_orderkey") % 13
    text = F.when(k == 0, F.lit(" < 1 year")).when(k == 11, F.lit("10+ years")).when(k == 12, F.lit("n/a")).otherwise(
        F.concat(k.cast("string"), F.lit(" years"))
    )
    return t.raw("orders").select(F.col("o_orderkey").alias("id"), C.parse_employment_years(text).alias("years"))


@query("parse_month_date", "", """
 SELECT id, CAST(try_strptime(txt, '%b-%Y') AS DATE) AS issue_date
 FROM (SELECT o_orderkey AS id, CASE WHEN o_orderkey%17=0 THEN 'unknown' ELSE strftime(o_orderdate, '%b-%Y') END AS txt FROM orders)""")
def parse_month_date(t):
    text = F.when(F.col("o_orderkey") % 17 == 0, F.lit("unknown")).otherwise(F.date_format("o_orderdate", "MMM-yyyy"))
    return t.raw("orders").select(F.col("o_orderkey").alias("id"), C.parse_month(text).alias("issue_date"))


@query("epoch_offset_timestamp", "", """
 SELECT event_id AS id, TIMESTAMP '2017-12-01 00:00:00' + to_seconds(event_id*37%8640000) AS ts FROM events""")
def epoch_offset_timestamp(t):
    ts = C.offset_timestamp(F.col("event_id") * 37 % 8640000)
    return t.raw("events").select(F.col("event_id").alias("id"), ts.cast("timestamp_ntz").alias("ts"))


def loan_states(t):
    """Loan statuses as text, some missing."""
    names = {0: "Fully Paid", 1: "Charged Off", 2: "Late (16-30 days)", 3: "Late (31-120 days)", 4: "Default", 5: "Current",
             6: "Does not meet the credit policy. Status:Charged Off"}
    return t.raw("orders").select(F.col("o_orderkey").alias("id"), from_map(names, F.col("o_orderkey") % 8).alias("status"))


STATES = """WITH states AS (SELECT o_orderkey AS id, CASE o_orderkey%8 WHEN 0 THEN 'Fully Paid' WHEN 1 THEN 'Charged Off'
 WHEN 2 THEN 'Late (16-30 days)' WHEN 3 THEN 'Late (31-120 days)' WHEN 4 THEN 'Default' WHEN 5 THEN 'Current'
 WHEN 6 THEN 'Does not meet the credit policy. Status:Charged Off' END AS status FROM orders)"""


@query("flag_membership", "", f"""{STATES}
 SELECT id, CASE WHEN status IN ('Charged Off','Default') THEN 1 ELSE 0 END AS default_flag,
  CASE WHEN status IN ('Charged Off','Default','Does not meet the credit policy. Status:Charged Off','Late (31-120 days)') THEN 1 ELSE 0 END AS training_flag FROM states""")
def flag_membership(t):
    return loan_states(t).select(
        "id", C.membership_flag("status", K.DEFAULT_STATUSES).alias("default_flag"),
        C.membership_flag("status", K.TRAINING_DEFAULT_STATUSES).alias("training_flag"),
    )


@query("consolidate_values", "", f"""{STATES}
 SELECT CASE WHEN status LIKE 'Late%' THEN 'Late' ELSE status END AS status, count(*) AS n FROM states GROUP BY 1""")
def consolidate_values(t):
    return loan_states(t).select(C.recode("status", K.LATE_STATUSES).alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("bucketize_tenure", "", """
 SELECT customer_id, CASE WHEN v IS NULL OR v<=-1 OR v>999 THEN NULL WHEN v<=6 THEN '0-6 months' WHEN v<=12 THEN '6-12 months'
  WHEN v<=24 THEN '12-24 months' WHEN v<=48 THEN '24-48 months' ELSE '48+ months' END AS tenure_group
 FROM (SELECT c_custkey AS customer_id, CASE WHEN c_custkey%50=49 THEN NULL ELSE c_custkey%73 - 2 END AS v FROM customer)""")
def bucketize_tenure(t):
    v = F.when(F.col("c_custkey") % 50 != 49, F.col("c_custkey") % 73 - 2)
    return t.raw("customer").select(F.col("c_custkey").alias("customer_id"), B.tenure_group(v).alias("tenure_group"))


@query("bucketize_rate", "", """
 SELECT id, CASE WHEN r<=-1 OR r>100 THEN NULL WHEN r<=7 THEN 'low' WHEN r<=14 THEN 'medium' ELSE 'high' END AS bucket,
  CASE WHEN r<-1 OR r>=100 THEN NULL WHEN r<7 THEN 'low' WHEN r<14 THEN 'medium' ELSE 'high' END AS bucket_left
 FROM (SELECT o_orderkey AS id, CAST(o_orderkey%110 AS INTEGER)-3 AS r FROM orders)""")
def bucketize_rate(t):
    r = (F.col("o_orderkey") % 110).cast("int") - 3
    return t.raw("orders").select(
        F.col("o_orderkey").alias("id"), B.rate_bucket(r).alias("bucket"),
        B.bucketize(r, B.RATE_EDGES, B.RATE_LABELS, right=False).alias("bucket_left"),
    )


@query("bucketize_dti_fico", "loans", """
 SELECT loan_id, CASE WHEN dti<=-1 OR dti>1000 THEN NULL WHEN dti<=10 THEN '<10' WHEN dti<=20 THEN '10-20' WHEN dti<=30 THEN '20-30' ELSE '30+' END AS dti_bucket,
  CASE WHEN f<=0 OR f>900 THEN NULL WHEN f<=600 THEN '<600' WHEN f<=660 THEN '600-659' WHEN f<=700 THEN '660-699' WHEN f<=740 THEN '700-739' ELSE '740+' END AS fico_band
 FROM (SELECT *, credit_score+CASE WHEN loan_id%40=0 THEN 500 ELSE 0 END AS f FROM loans)""")
def bucketize_dti_fico(t):
    f = F.col("credit_score") + F.when(F.col("loan_id") % 40 == 0, F.lit(500)).otherwise(F.lit(0))
    return t.loans_core().select("loan_id", B.dti_bucket("dti").alias("dti_bucket"), B.fico_band(f).alias("fico_band"))


@query("bucketize_amount", "txns", """
 SELECT transaction_id, CASE WHEN a<=0 THEN NULL WHEN a<=25 THEN '<25' WHEN a<=100 THEN '25-100' WHEN a<=250 THEN '100-250'
  WHEN a<=500 THEN '250-500' WHEN a<=1000 THEN '500-1k' ELSE '1k+' END AS amt_band
 FROM (SELECT transaction_id, transaction_amt*(transaction_id%7-1) AS a FROM txns)""")
def bucketize_amount(t):
    a = F.col("transaction_amt") * (F.col("transaction_id") % 7 - 1)
    return t.txns().select("transaction_id", B.amount_band(a).alias("amt_band"))


@query("bucket_sort_key", "subscribers", """
 SELECT tenure_group, CASE tenure_group WHEN '0-6 months' THEN 1 WHEN '6-12 months' THEN 2 WHEN '12-24 months' THEN 3
  WHEN '24-48 months' THEN 4 WHEN '48+ months' THEN 5 ELSE 99 END AS sort_key, count(*) AS n
 FROM (SELECT CASE WHEN customer_id%31=0 THEN 'other' ELSE tenure_group END AS tenure_group FROM subscribers) GROUP BY 1,2""")
def bucket_sort_key(t):
    group = F.when(F.col("customer_id") % 31 == 0, F.lit("other")).otherwise(F.col("tenure_group"))
    df = t.subscribers().select(group.alias("tenure_group")).groupBy("tenure_group").agg(F.count(F.lit(1)).alias("n"))
    return df.select("tenure_group", B.label_order("tenure_group", B.TENURE_LABELS).alias("sort_key"), "n").orderBy("sort_key")


@query("safe_ratio", "loans", """
 SELECT loan_id, CASE WHEN annual_income>0 THEN loan_amount::DOUBLE/annual_income::DOUBLE ELSE 0.0::DOUBLE END AS debt_ratio,
  CASE WHEN dti>0 THEN loan_amount::DOUBLE/dti::DOUBLE ELSE 0.0::DOUBLE END AS per_point FROM loans""")
def safe_ratio(t):
    return t.loans().select(
        "loan_id", A.ratio_if_positive("loan_amount", "annual_income").alias("debt_ratio"),
        A.ratio_if_positive("loan_amount", "dti").alias("per_point"),
    )


@query("safe_divide", "loans", """
 SELECT loan_id, coalesce(loan_amount::DOUBLE/nullif(dti,0)::DOUBLE,0) AS or_zero, loan_amount::DOUBLE/nullif(dti,0)::DOUBLE AS or_null FROM loans""")
def safe_divide(t):
    return t.loans_core().select(
        "loan_id", A.safe_divide("loan_amount", "dti").alias("or_zero"), A.safe_divide("loan_amount", "dti", None).alias("or_null")
    )


@query("log_amount", "", """
 SELECT id, round(CASE WHEN a>0 THEN 1+log10(a) ELSE 0 END,9) AS log_or_zero, round(CASE WHEN a>0 THEN 1+log10(a) ELSE 1 END,9) AS log_or_one
 FROM (SELECT c_custkey AS id, CAST(c_acctbal AS DECIMAL(12,2))::DOUBLE AS a FROM customer)""")
def log_amount(t):
    a = F.col("c_acctbal").cast("decimal(12,2)")
    return t.raw("customer").select(
        F.col("c_custkey").alias("id"), F.round(A.log_amount(a), 9).alias("log_or_zero"),
        F.round(A.log_amount(a, 1.0), 9).alias("log_or_one"),
    )


@query("coalesce_or_mean", "", """
 SELECT id, CAST(floor(coalesce((coalesce(lo,hi)+coalesce(hi,lo))/2,600)) AS INTEGER) AS credit_score FROM (SELECT o_orderkey AS id,
  CASE WHEN o_orderkey%5<>0 THEN 600+o_orderkey%200 END::DOUBLE AS lo, CASE WHEN o_orderkey%7<>0 THEN 603+o_orderkey%200 END::DOUBLE AS hi FROM orders)""")
def coalesce_or_mean(t):
    k = F.col("o_orderkey")
    lo, hi = F.when(k % 5 != 0, 600 + k % 200), F.when(k % 7 != 0, 603 + k % 200)
    return t.raw("orders").select(k.alias("id"), A.credit_score(lo, hi).alias("credit_score"))


@query("fill_unknown", "txns", """
 SELECT transaction_id, coalesce(device_type,'unknown') AS device_type, 'OTHER' AS home_ownership FROM txns""")
def fill_unknown(t):
    df = K.fill_categories(t.txns().select("transaction_id", "device_type"), ["device_type"])
    return K.fill_categories(df, ["home_ownership"], C.OTHER)


@query("replace_blank_or_null", "", """
 SELECT event_id AS id, coalesce(nullif(device,''),'Unknown') AS device, coalesce(nullif(product,''),'Other') AS product FROM
  (SELECT event_id, CASE WHEN event_id%4=0 THEN '' WHEN event_id%4=1 THEN NULL ELSE event_type END AS device,
   CASE WHEN event_id%3=0 THEN '' ELSE event_type END AS product FROM events)""")
def replace_blank_or_null(t):
    k, e = F.col("event_id"), F.col("event_type")
    df = t.raw("events").select(
        k.alias("id"), F.when(k % 4 == 0, F.lit("")).when(k % 4 != 1, e).alias("device"),
        F.when(k % 3 == 0, F.lit("")).otherwise(e).alias("product"),
    )
    return K.replace_blanks(df, {"device": "Unknown", "product": "Other"})


@query("normalize_text", "runs", """
 SELECT run_id, upper(trim(status)) AS status, lower(task_id) AS task FROM runs""")
def normalize_text(t):
    return t.runs().select("run_id", C.upper_code("status").alias("status"), C.lower_code("task_id").alias("task"))


@query("clean_training_frame", "", """
 SELECT id, CASE WHEN id%9 IN (0,1,2) THEN NULL ELSE x END AS x, CAST(y AS INTEGER) AS y FROM
 (SELECT o_orderkey AS id, CAST(o_totalprice AS DECIMAL(12,2))::DOUBLE AS x, CASE WHEN o_orderstatus='F' THEN 1 WHEN o_orderstatus='O' THEN 0 END AS y FROM orders)
 WHERE y IS NOT NULL""")
def clean_training_frame(t):
    from ..operators.preparation import clean_training_frame as job

    k, s = F.col("o_orderkey") % 9, F.col("o_orderstatus")
    x = F.col("o_totalprice").cast("decimal(12,2)").cast("double")
    messy = F.when(k == 0, F.lit(float("inf"))).when(k == 1, F.lit(float("-inf"))).when(k == 2, F.lit(float("nan"))).otherwise(x)
    y = F.when(s == "F", F.lit(1.0)).when(s == "O", F.lit(0.0))
    return job(t.raw("orders").select(F.col("o_orderkey").alias("id"), messy.alias("x"), y.alias("y")), ["id", "x"], "y")


@query("align_to_schema", "txns", """
 SELECT transaction_amt::DOUBLE AS transaction_amt, CAST(NULL AS DOUBLE) AS dist1, device_type, CAST(NULL AS VARCHAR) AS browser FROM txns""")
def align_to_schema(t):
    wanted = T.StructType([
        T.StructField("transaction_amt", T.DoubleType()), T.StructField("dist1", T.DoubleType()),
        T.StructField("device_type", T.StringType()), T.StructField("browser", T.StringType()),
    ])
    return K.align_to_schema(t.txns(), wanted)


@query("assign_surrogate_id", "", """
 SELECT count(*) AS n, count(*) AS distinct_ids FROM (SELECT c_custkey FROM customer UNION ALL SELECT o_orderkey FROM orders UNION ALL SELECT event_id FROM events)""")
def assign_surrogate_id(t):
    """Ids of three sources together: all different."""
    keys = {"churn": ("customer", "c_custkey"), "lending": ("orders", "o_orderkey"), "fraud": ("events", "event_id")}
    ids = None
    for source, (name, key) in keys.items():
        mine = K.assign_surrogate_id(t.raw(name).select(key), source, "row_id").select("row_id")
        ids = mine if ids is None else ids.unionByName(mine)
    return ids.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("distinct_ids"))


@query("add_lineage", "loans", """
 SELECT loan_id, 'lending' AS source_system, '2001-08-01' AS etl_date FROM loans""")
def add_lineage(t):
    return K.add_lineage(t.loans_core().select("loan_id"), "lending", "2001-08-01")


@query("pack_wide_columns", "", """
 SELECT event_id AS id, '{"event_type":"'||event_type||'","user_id":'||CAST(user_id AS VARCHAR)||'}' AS packed,
  CAST(json_extract_string(props,'$.k') AS INTEGER) AS k FROM events""")
def pack_wide_columns(t):
    df = t.raw("events").select(F.col("event_id").alias("id"), "event_type", "user_id", "props")
    df = df.withColumn("k", F.from_json("props", "map<string,int>")["k"]).drop("props")
    return K.pack_columns(df, {"packed": ["event_type", "user_id"]})


def requests(t):
    """Churn requests as text, some of them wrong."""
    k = F.col("customer_id")
    s = t.subscribers()
    return s.select(
        k.alias("request_id"),
        F.when(k % 10 == 0, F.lit("not_a_number")).when(k % 10 == 1, F.lit("-1")).when(k % 10 != 2, F.col("tenure").cast("string")).alias("tenure"),
        F.when(k % 15 == 3, F.lit("-5.00")).otherwise(F.col("monthly_charges").cast("string")).alias("monthly_charges"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("total_charges").cast("string")).alias("total_charges"),
        F.when(k % 20 == 5, F.repeat(F.lit("x"), 51)).otherwise(F.col("contract_type")).alias("contract_type"),
        "payment_method", "internet_service",
    )


REQUESTS = """ requests AS (SELECT customer_id AS request_id, CASE WHEN customer_id%10=0 THEN 'not_a_number' WHEN customer_id%10=1 THEN '-1'
  WHEN customer_id%10<>2 THEN CAST(tenure AS VARCHAR) END AS tenure,
  CASE WHEN customer_id%15=3 THEN '-5.00' ELSE CAST(monthly_charges AS VARCHAR) END AS monthly_charges,
  CASE WHEN customer_id%4=0 THEN NULL ELSE CAST(total_charges AS VARCHAR) END AS total_charges,
  CASE WHEN customer_id%20=5 THEN repeat('x',51) ELSE contract_type END AS contract_type, payment_method, internet_service FROM subscribers),
 checked AS (SELECT *, list_filter([
   CASE WHEN tenure IS NULL THEN 'tenure: missing' END,
   CASE WHEN tenure IS NOT NULL AND TRY_CAST(tenure AS INTEGER) IS NULL THEN 'tenure: not a number' END,
   CASE WHEN TRY_CAST(tenure AS INTEGER)<0 THEN 'tenure: too small' END,
   CASE WHEN TRY_CAST(monthly_charges AS DOUBLE)<0 THEN 'monthly_charges: too small' END,
   CASE WHEN length(contract_type)>50 THEN 'contract_type: too long' END], lambda e: e IS NOT NULL) AS errors FROM requests)"""


@query("validate_rows", "subscribers", f"""WITH {REQUESTS} SELECT request_id, array_to_string(errors,'; ') AS errors, len(errors)=0 AS accepted FROM checked""")
def validate_rows(t):
    return V.validate_rows(requests(t), V.CHURN_RULES).select(
        "request_id", F.array_join("errors", "; ").alias("errors"), (F.size("errors") == 0).alias("accepted")
    )


@query("default_total_charges", "subscribers", """
 SELECT customer_id, CAST(CASE WHEN total_charges IS NULL OR total_charges=0 OR customer_id%4=0 THEN tenure*monthly_charges ELSE total_charges END AS DECIMAL(19,2)) AS total_charges FROM subscribers""")
def default_total_charges(t):
    given = F.when(F.col("customer_id") % 4 != 0, F.col("total_charges"))
    total = A.default_total(given, F.col("tenure"), F.col("monthly_charges"))
    return t.subscribers().select("customer_id", total.cast("decimal(19,2)").alias("total_charges"))


@query("dedup_keys", "ledger", "SELECT order_id, line_id, card1, transaction_dt, transaction_amt FROM ledger")
def dedup_keys(t):
    order = ["part_id", "card1", "transaction_dt", "transaction_amt"]
    return K.dedup_keys(t.ledger_raw(), ["order_id", "line_id"], order).drop("part_id")


# ---------------------------------------------------------------- raw files to facts


def raw_churn(t):
    k = F.col("customer_id")
    s = t.subscribers()
    rows = s.select(
        F.concat(F.lit("C"), k.cast("string")).alias("customerID"), F.col("tenure").cast("string").alias("tenure"),
        F.col("monthly_charges").cast("string").alias("MonthlyCharges"),
        F.when(k % 9 == 0, F.lit(" ")).otherwise(F.col("total_charges").cast("string")).alias("TotalCharges"),
        F.col("contract_type").alias("Contract"), F.col("payment_method").alias("PaymentMethod"),
        F.col("paperless_billing").alias("PaperlessBilling"), F.col("internet_service").alias("InternetService"),
        F.col("online_security").alias("OnlineSecurity"), F.col("tech_support").alias("TechSupport"),
        F.col("streaming_tv").alias("StreamingTV"),
        F.when(k % 13 == 0, F.lit("unknown")).when(F.col("churn_flag") == 1, F.lit("Yes")).otherwise(F.lit("No")).alias("Churn"),
    )
    return rows.withColumn("copy_no", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy_no")


@query("clean_churn", "subscribers", """
 SELECT 'C'||CAST(customer_id AS VARCHAR) AS customer_id, tenure, monthly_charges,
  CAST(CASE WHEN customer_id%9=0 THEN 0 ELSE total_charges END AS DECIMAL(10,2)) AS total_charges, contract_type, payment_method,
  paperless_billing, CAST(NULL AS VARCHAR) AS multiple_lines, internet_service, online_security, CAST(NULL AS VARCHAR) AS online_backup,
  CAST(NULL AS VARCHAR) AS device_protection, tech_support, streaming_tv, CAST(NULL AS VARCHAR) AS streaming_movies,
  CASE WHEN customer_id%13<>0 AND churn_flag=1 THEN 'Yes' ELSE 'No' END AS churn_label,
  CASE WHEN customer_id%13<>0 AND churn_flag=1 THEN 1 ELSE 0 END AS churn_flag,
  CAST(CASE WHEN tenure>0 THEN CAST((CAST(monthly_charges*100 AS BIGINT)*200+30)//60 AS DECIMAL(18,0))/10000 ELSE 0 END AS DECIMAL(10,4)) AS avg_daily_charge,
  tenure_group, 'churn' AS source_system FROM subscribers""")
def clean_churn(t):
    return K.clean_churn(raw_churn(t))


def raw_loans(t):
    k = F.col("loan_id")
    return t.loans().select(
        k.cast("string").alias("id"), F.col("loan_amount").cast("string").alias("loan_amnt"),
        F.concat(F.lit(" "), F.col("interest_rate").cast("string"), F.lit("%")).alias("int_rate"),
        F.when(k % 12 == 0, F.lit("")).otherwise(F.col("annual_income").cast("string")).alias("annual_inc"),
        F.lit("5 years").alias("emp_length"), "home_ownership", "grade", "purpose", "term",
        from_map({0: "Charged Off", 1: "Default", 2: "Late (16-30 days)", 3: "Late (31-120 days)"}, k % 6).alias("loan_status"),
        F.when(k % 14 == 0, F.lit("x")).otherwise(F.col("dti").cast("string")).alias("dti"),
        F.when(k % 8 != 0, F.col("credit_score").cast("string")).alias("fico_range_low"),
        F.when(k % 16 != 0, (F.col("credit_score") + 4).cast("string")).alias("fico_range_high"),
        F.when(k % 19 == 0, F.lit("?")).otherwise(F.date_format("issue_date", "MMM-yyyy")).alias("issue_d"),
    )


@query("clean_loans", "loans", """
 SELECT loan_id AS loan_id_orig, loan_amount, interest_rate, inc AS annual_income, '5 years' AS employment_length, home_ownership, grade,
  purpose, term, CASE loan_id%6 WHEN 0 THEN 'Charged Off' WHEN 1 THEN 'Default' WHEN 2 THEN 'Late' WHEN 3 THEN 'Late' END AS loan_status,
  CAST(CASE WHEN loan_id%14=0 THEN 0 ELSE dti END AS DECIMAL(7,2)) AS dti, score AS credit_score,
  CASE WHEN loan_id%19<>0 THEN CAST(date_trunc('month', issue_date) AS DATE) END AS issue_date,
  CASE WHEN loan_id%6 IN (0,1) THEN 1 ELSE 0 END AS default_flag,
  CASE WHEN inc>0 THEN round(CAST(loan_amount::DOUBLE/inc::DOUBLE AS DECIMAL(30,12)),4)::DOUBLE ELSE 0.0::DOUBLE END AS debt_ratio,
  CASE WHEN score<600 THEN 1 ELSE 0 END AS high_risk,
  CASE WHEN interest_rate<=7 THEN 'low' WHEN interest_rate<=14 THEN 'medium' ELSE 'high' END AS interest_rate_bucket, 'lending' AS source_system
 FROM (SELECT *, CAST(CASE WHEN loan_id%12=0 THEN 0 ELSE annual_income END AS DECIMAL(12,2)) AS inc,
  CAST(CASE WHEN loan_id%16=0 THEN 600 WHEN loan_id%8=0 THEN credit_score+4 ELSE credit_score+2 END AS INTEGER) AS score FROM loans)""")
def clean_loans(t):
    return K.clean_loans(raw_loans(t))


def raw_transactions(t):
    k = F.col("transaction_id")
    return t.txns().select(
        k.alias("TransactionID"), (k * 61).alias("TransactionDT"),
        F.when(k % 18 == 0, F.lit("bad")).otherwise(F.col("transaction_amt").cast("string")).alias("TransactionAmt"),
        F.col("product_cd").alias("ProductCD"), "card1", "card4", "card6", F.col("email_domain").alias("P_emaildomain"),
        F.when(k % 5 == 0, F.lit("12.5")).alias("dist1"), F.col("is_fraud").alias("isFraud"),
    )


def raw_identity(t):
    k = F.col("event_id")
    rows = t.raw("events").where(k % 3 != 0).select(
        k.alias("TransactionID"), F.col("event_type").alias("DeviceType"), F.explode(F.array(F.lit("w"), F.lit("v"))).alias("letter")
    )
    return rows.withColumn("DeviceInfo", F.concat("letter", (F.col("TransactionID") % 4).cast("string"))).drop("letter")


@query("clean_transactions", "txns", """
 SELECT transaction_id, amt AS transaction_amt, product_cd, card1, CAST(NULL AS BIGINT) AS card2, CAST(NULL AS BIGINT) AS card3, card4,
  CAST(NULL AS BIGINT) AS card5, card6, CAST(NULL AS BIGINT) AS addr1, CAST(NULL AS BIGINT) AS addr2,
  CAST(CASE WHEN transaction_id%5=0 THEN 12.5 ELSE 0 END AS DECIMAL(10,2)) AS dist1, CAST(0 AS DECIMAL(10,2)) AS dist2,
  CASE WHEN transaction_id%3<>0 THEN event_type END AS device_type,
  CASE WHEN transaction_id%3<>0 THEN 'v'||CAST(transaction_id%4 AS VARCHAR) END AS device_info, email_domain, is_fraud,
  round(CASE WHEN amt>0 THEN 1+log10(amt::DOUBLE) ELSE 0 END,9) AS transaction_amt_log,
  TIMESTAMP '2017-12-01 00:00:00' + to_seconds(transaction_id*61) AS transaction_dt, 'fraud' AS source_system
 FROM (SELECT t.*, e.event_type, CAST(CASE WHEN t.transaction_id%18=0 THEN 0 ELSE t.transaction_amt END AS DECIMAL(12,2)) AS amt
  FROM txns t JOIN events e ON e.event_id=t.transaction_id)""")
def clean_transactions(t):
    out = K.clean_transactions(raw_transactions(t), raw_identity(t))
    return out.withColumns({
        "transaction_amt_log": F.round("transaction_amt_log", 9), "transaction_dt": F.col("transaction_dt").cast("timestamp_ntz"),
    })


# ---------------------------------------------------------------- joins


@query("join_identity", "txns identity", """
 SELECT transaction_id, t.card1, device_info, addr1 FROM txns t
 LEFT JOIN (SELECT card1, min(device_info) AS device_info, min(addr1) AS addr1 FROM identity GROUP BY 1) i ON t.card1=i.card1""")
def join_identity(t):
    rows = t.txns().select("transaction_id", "card1")
    return J.attach_identity(rows, t.identity(), "card1", ["copy_no"]).drop("copy_no")


@query("insert_if_absent", "ledger_raw", """
 SELECT order_id, line_id, card1, transaction_amt FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_id
   ORDER BY part_id, card1, transaction_dt, transaction_amt) AS rn FROM ledger_raw WHERE card1%2=0) b
 WHERE rn=1 AND NOT EXISTS (SELECT 1 FROM ledger_raw x WHERE x.card1%2=1 AND x.order_id=b.order_id AND x.line_id=b.line_id)""")
def insert_if_absent(t):
    rows = t.ledger_raw()
    order = ["part_id", "card1", "transaction_dt", "transaction_amt"]
    out = J.insert_if_absent(rows.where("card1 % 2 = 0"), rows.where("card1 % 2 = 1"), ["order_id", "line_id"], order)
    return out.select("order_id", "line_id", "card1", "transaction_amt")


@query("semi_join_known", "loans txns", "SELECT loan_id, customer_id FROM loans WHERE customer_id IN (SELECT customer_id FROM txns)")
def semi_join_known(t):
    return J.keep_known(t.loans_core().select("loan_id", "customer_id"), t.txns(), "customer_id")


COLOR_SQL = "CASE (r-1)%24+1 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in PALETTE.items()) + " ELSE '#000000' END"


@query("lookup_dimension", "", f"""
 SELECT name, CAST(r AS INTEGER) AS rank, {COLOR_SQL} AS color FROM (SELECT name, dense_rank() OVER (ORDER BY name) AS r FROM
  (SELECT DISTINCT p_name AS name FROM part))""")
def lookup_dimension(t):
    return J.lookup_by_rank(t.raw("part").select(F.col("p_name").alias("name")), "name", PALETTE, "#000000", "color")


@query("dense_rank_category", "loans", """
 SELECT purpose, CAST(dense_rank() OVER (ORDER BY purpose) AS INTEGER) AS rank FROM (SELECT DISTINCT purpose FROM loans)""")
def dense_rank_category(t):
    return J.dense_rank_category(t.loans(), "purpose")


# ---------------------------------------------------------------- sampling and counting


@query("sample_rows", "", """
 SELECT o_orderkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)||'|42'), o_orderkey LIMIT 1000""")
def sample_rows(t):
    from ..operators.preparation import sample_rows as job

    return job(t.raw("orders").select("o_orderkey"), "o_orderkey", 1000)


@query("sample_rows_fraction", "", """
 SELECT * FROM orders WHERE CAST('0x'||substr(md5(CAST(o_orderkey AS VARCHAR)||'|42'),1,12) AS BIGINT)<1000*281474976710656//(SELECT count(*) FROM orders)""")
def sample_rows_fraction(t):
    from ..operators.preparation import sample_fraction

    return sample_fraction(t.raw("orders"), "o_orderkey", 1000)


@query("row_count_reconcile", "", """
 SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer
 UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def row_count_reconcile(t):
    from ..sources import reconcile_counts

    return reconcile_counts({n: t.raw(n) for n in ("orders", "customer", "events", "lineitem")})

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions import bands as B
from riskweave.functions import cleaning as C
from riskweave.functions import rules as R
from riskweave.functions import validation as V
from riskweave.operators import cleaning as K
from riskweave.operators import preparation as P

CHURN_ROWS = [
    ("C1", 12, 100.0, "1200.0", "Month-to-month", "Electronic check", "Fiber optic", "No", "No", "Yes", "No", "Yes"),
    ("C2", 3, 60.0, "180.0", "Two year", "Mailed check", "DSL", "Yes", "Yes", "No", "Yes", "No"),
]
CHURN_COLUMNS = "customerID tenure MonthlyCharges TotalCharges Contract PaymentMethod InternetService OnlineSecurity TechSupport PaperlessBilling StreamingTV Churn".split()


def churn(spark):
    return spark.createDataFrame(CHURN_ROWS, CHURN_COLUMNS)


def loans(spark):
    return spark.createDataFrame(
        [
            (1, 650, 654, 18.5, 12000, "B", "debt_consolidation", "Fully Paid", 75000, "10+ years", 12000, 35.0, 0, 0, 12, "MORTGAGE", "Source Verified"),
            (2, 700, 704, 25.0, 25000, "C", "credit_card", "Charged Off", 48000, "< 1 year", 8000, 48.2, 2, 1, 8, "RENT", "Not Verified"),
            (3, 620, 624, 32.0, 8000, "E", "small_business", "Current", 42000, "5 years", 15000, 60.1, 1, 0, 6, "RENT", "Verified"),
            (4, 680, 684, 15.0, 30000, "A", "other", "Fully Paid", 110000, "3 years", 5000, 12.0, 0, 0, 15, "OWN", "Source Verified"),
        ],
        "id int, fico_range_low int, fico_range_high int, dti double, loan_amnt int, grade string, purpose string, loan_status string, annual_inc int, "
        "emp_length string, revol_bal int, revol_util double, delinq_2yrs int, pub_rec int, open_acc int, home_ownership string, verification_status string",
    )


def test_churn_frame_follows_the_contract(spark):
    out = P.normalize_churn_frame(churn(spark))
    assert out.columns == [*P.CHURN.features, "churn_flag"]
    assert [r["churn_flag"] for r in out.orderBy(F.col("tenure").desc()).collect()] == [1, 0]


def test_churn_frame_fills_absent_columns(spark):
    out = P.normalize_churn_frame(churn(spark).drop("OnlineSecurity", "TechSupport", "PaperlessBilling", "StreamingTV"))
    for c in ("online_security", "tech_support", "paperless_billing", "streaming_tv"):
        assert {r[0] for r in out.select(c).collect()} == {"unknown"}


def test_empty_churn_frame_stays_empty(spark):
    assert P.normalize_churn_frame(churn(spark).limit(0)).count() == 0


def test_loan_frame(spark):
    out = P.normalize_loans_frame(loans(spark)).orderBy("fico_score").collect()
    assert [r["fico_score"] for r in out] == [622.0, 652.0, 682.0, 702.0]
    assert {r["fico_score"]: r["emp_length"] for r in out} == {652.0: 10.0, 702.0: 0.0, 622.0: 5.0, 682.0: 3.0}
    assert {r["fico_score"]: r["default_flag"] for r in out} == {652.0: 0, 702.0: 1, 622.0: 0, 682.0: 0}


def test_loan_frame_absent_columns(spark):
    row = P.normalize_loans_frame(loans(spark).drop("revol_bal", "verification_status")).first()
    assert row["revol_bal"] is None and row["verification_status"] == "OTHER"


def test_numbers_with_spaces_and_bad_text(spark):
    df = spark.createDataFrame([("  50.0  ",), (" ",), ("x",), (None,), ("NaN",)], "v string")
    assert [r[0] for r in df.select(C.to_number("v")).collect()] == [50.0, None, None, None, None]
    assert [r[0] for r in df.select(C.to_number("v", default=0.0)).collect()] == [50.0, 0.0, 0.0, 0.0, 0.0]


def test_month_and_percent(spark):
    df = spark.createDataFrame([("Dec-2015", "13.56%"), ("bad", "x%")], "m string, p string")
    assert [tuple(r) for r in df.select(C.parse_month("m"), C.parse_percent("p")).collect()] == [(date(2015, 12, 1), 13.56), (None, None)]


def test_bands_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(600,), (601,), (900,), (901,), (0,), (None,)], "v int")
    assert [r[0] for r in df.select(B.fico_band("v")).collect()] == ["<600", "600-659", "740+", None, None, None]


def test_clean_churn_drops_copies(spark):
    out = K.clean_churn(churn(spark).unionByName(churn(spark)))
    got = {r["customer_id"]: r for r in out.collect()}
    assert len(got) == 2 and out.count() == 2
    assert got["C1"]["avg_daily_charge"] == Decimal("3.3333") and got["C1"]["tenure_group"] == "6-12 months"
    assert got["C2"]["churn_label"] == "No" and got["C2"]["multiple_lines"] is None


def test_clean_loans(spark):
    raw = loans(spark).withColumn("int_rate", F.lit("13.99%")).withColumn("issue_d", F.lit("Jan-2018")).withColumn("term", F.lit(" 36 months"))
    raw = raw.withColumn("loan_status", F.when(F.col("id") == 3, F.lit("Late (31-120 days)")).otherwise(F.col("loan_status")))
    got = {r["loan_id_orig"]: r for r in K.clean_loans(raw).collect()}
    assert got[1]["credit_score"] == 652 and got[1]["interest_rate_bucket"] == "medium" and got[1]["debt_ratio"] == 0.16
    assert got[3]["loan_status"] == "Late" and got[3]["default_flag"] == 0 and got[2]["default_flag"] == 1
    assert got[1]["issue_date"] == date(2018, 1, 1)


def test_clean_transactions(spark):
    raw = spark.createDataFrame([(1, 100, "50.0", "W", 101, 0), (1, 100, "50.0", "W", 101, 0), (2, 86400, "0", "C", 102, 1)],
                                "TransactionID int, TransactionDT int, TransactionAmt string, ProductCD string, card1 int, isFraud int")
    identity = spark.createDataFrame([(1, "mobile"), (1, "mobile")], "TransactionID int, DeviceType string")
    got = {r["transaction_id"]: r for r in K.clean_transactions(raw, identity).collect()}
    assert len(got) == 2 and got[1]["device_type"] == "mobile" and got[2]["device_type"] is None
    assert got[2]["transaction_amt_log"] == 0.0 and got[1]["dist1"] == 0
    assert got[2]["transaction_dt"] == datetime(2017, 12, 2)


def test_align_ignores_extra_and_adds_missing(spark):
    schema = T.StructType([T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType())])
    out = K.align_to_schema(spark.createDataFrame([(1, 2)], "a int, b int"), schema)
    assert out.columns == ["b", "c"] and tuple(out.first()) == (2.0, None)


def test_validation(spark):
    df = spark.createDataFrame(
        [(1, "6", "110"), (2, None, None), (3, "not_a_number", "5"), (4, "-1", "5"), (5, "6", "x")],
        "id int, tenure string, monthly_charges string",
    )
    good, bad = V.split_valid(df, V.CHURN_RULES)
    assert [r["id"] for r in good.collect()] == [1]
    errors = {r["id"]: r["errors"] for r in bad.collect()}
    assert errors[2] == ["tenure: missing", "monthly_charges: missing"]
    assert errors[3] == ["tenure: not a number"] and errors[4] == ["tenure: too small"] and errors[5] == ["monthly_charges: not a number"]


def test_validation_of_an_empty_record(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert V.validate_rows(df, V.CHURN_RULES).first()["errors"] == ["tenure: missing", "monthly_charges: missing"]


def test_customer_domain_rules(spark):
    df = spark.createDataFrame([("lending", "a", "RENT"), ("bank", "b", "CAVE")], "source_system string, source_customer_id string, home_ownership string")
    assert [len(r["errors"]) for r in V.validate_rows(df, V.CUSTOMER_RULES).collect()] == [0, 2]


def test_churn_card(spark):
    from riskweave.operators.scoring import score_rules

    df = spark.createDataFrame([(6, 110.0, "Month-to-month", "Electronic check"), (40, 20.0, "Two year", "Mailed check")],
                               "tenure int, monthly_charges double, contract_type string, payment_method string")
    a, b = score_rules(df, R.churn_card()).collect()
    assert a["probability"] == 0.95 and a["prediction"] == "Will Churn" and a["fallback"]
    assert a["top_drivers"] == ["contract_type", "monthly_charges", "tenure", "payment_method"]
    assert b["probability"] == 0.15 and b["top_drivers"] == ["tenure", "contract_type", "monthly_charges"]


def test_training_frame(spark):
    df = spark.createDataFrame([(1, float("inf"), 1.0), (2, float("nan"), 0.0), (3, 2.0, None)], "id int, x double, y double")
    got = P.clean_training_frame(df, ["id", "x"], "y").collect()
    assert [(r["id"], r["x"], r["y"]) for r in got] == [(1, None, 1), (2, None, 0)]


def test_packed_columns_read_back(spark):
    df = spark.createDataFrame([(1, "T", None, 2.5)], "id int, M1 string, M2 string, V1 double")
    out = K.pack_columns(df, {"m": ["M1", "M2"], "v": ["V1"]})
    assert out.columns == ["id", "m", "v"] and out.first()["m"] == '{"M1":"T"}'

"""Row rules for scoring requests: rejected rows carry the rules they broke."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """What a field must satisfy.  ``low_open`` excludes the lower bound itself."""

    field: str
    type_: str = "string"
    required: bool = False
    low: float | None = None
    low_open: bool = False
    high: float | None = None
    max_length: int | None = None
    min_length: int | None = None
    pattern: str | None = None

    def checks(self, present: bool) -> list[Column]:
        if not present:
            return [F.when(F.lit(self.required), F.lit(f"{self.field}: missing"))]
        raw = F.col(self.field).cast("string")
        typed = raw.try_cast(self.type_)
        out = []
        if self.required:
            out.append(F.when(raw.isNull(), F.lit(f"{self.field}: missing")))
        if self.type_ != "string":
            out.append(F.when(raw.isNotNull() & typed.isNull(), F.lit(f"{self.field}: not a number")))
        if self.low is not None:
            bad = typed <= self.low if self.low_open else typed < self.low
            out.append(F.when(bad, F.lit(f"{self.field}: too small")))
        if self.high is not None:
            out.append(F.when(typed > self.high, F.lit(f"{self.field}: too large")))
        if self.max_length is not None:
            out.append(F.when(F.length(raw) > self.max_length, F.lit(f"{self.field}: too long")))
        if self.min_length is not None:
            out.append(F.when(F.length(raw) < self.min_length, F.lit(f"{self.field}: too short")))
        if self.pattern is not None:
            out.append(F.when(~raw.rlike(self.pattern), F.lit(f"{self.field}: not allowed")))
        return out


def _text(*names: str, length: int = 50) -> tuple[Rule, ...]:
    return tuple(Rule(n, max_length=length) for n in names)


# Accepted ranges of the three scoring requests.
CHURN_RULES = (
    Rule("tenure", "int", required=True, low=0),
    Rule("monthly_charges", "double", required=True, low=0),
    Rule("total_charges", "double", low=0),
    *_text("contract_type", "payment_method", "internet_service", "online_security", "tech_support",
           "paperless_billing", "streaming_tv"),
)
DEFAULT_RULES = (
    Rule("fico_score", "int", required=True, low=300, high=900),
    Rule("debt_ratio", "double", required=True, low=0),
    Rule("loan_amount", "double", required=True, low=0, low_open=True),
    Rule("grade", min_length=1, max_length=1),
    Rule("purpose", max_length=100),
    Rule("annual_inc", "double", low=0),
    Rule("emp_length", "double", low=0, high=50),
    Rule("revol_bal", "double", low=0),
    Rule("revol_util", "double", low=0),
    Rule("delinq_2yrs", "int", low=0, high=50),
    Rule("pub_rec", "int", low=0, high=50),
    Rule("open_acc", "int", low=0, high=100),
    *_text("home_ownership", "verification_status"),
)
FRAUD_RULES = (
    Rule("transaction_amt", "double", required=True, low=0, low_open=True),
    *_text("device_type", "card_type", "browser"),
    Rule("email_domain", max_length=100),
    Rule("txn_cnt_1h", "double", low=0),
    Rule("txn_cnt_24h", "double", low=0),
    Rule("txn_amt_sum_24h", "double", low=0),
    Rule("txn_amt_std_24h", "double", low=0),
)
CUSTOMER_RULES = (
    Rule("source_system", required=True, pattern="^(lending|fraud|churn)$"),
    Rule("source_customer_id", required=True),
    Rule("age", "int", low=0, high=120),
    Rule("annual_income", "double", low=0, high=1e9),
    Rule("home_ownership", pattern="^(RENT|MORTGAGE|OWN|OTHER)$"),
    Rule("tenure", "int", low=0),
)


def validate_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``errors``: the broken rules in rule order, empty for a good row."""
    checks = [c for r in rules for c in r.checks(r.field in df.columns)]
    return df.withColumn("errors", F.filter(F.array(*checks), lambda e: e.isNotNull()))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their errors)."""
    checked = validate_rows(df, rules)
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)

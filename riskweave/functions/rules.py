"""Point-based fallback scores, used where no fitted model is available."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scorecard:
    """A base, points per fired condition and a cap; fired conditions are drivers."""

    task: str
    model: str
    base: str
    cap: str
    positive: str
    negative: str
    default_drivers: tuple[str, ...]
    points: Sequence[tuple[str, str, Column]]
    version: str = "0.1.0"

    def probability(self) -> Column:
        total = F.lit(Decimal(self.base))
        for _, points, fired in self.points:
            total = total + F.when(fired, F.lit(Decimal(points))).otherwise(F.lit(Decimal("0.00")))
        return F.least(total.cast("double"), F.lit(float(self.cap)))

    def drivers(self) -> Column:
        fired = F.filter(
            F.array(*[F.when(cond, F.lit(name)) for name, _, cond in self.points]), lambda d: d.isNotNull()
        )
        return F.when(F.size(fired) > 0, fired).otherwise(F.array(*[F.lit(d) for d in self.default_drivers]))

    def label(self, probability: Column, threshold: float | Column = 0.5) -> Column:
        return F.when(probability >= threshold, F.lit(self.positive)).otherwise(F.lit(self.negative))


# Points, caps, labels and category sets of the three scorecards.
USUAL_DOMAINS = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com")


def churn_card() -> Scorecard:
    return Scorecard(
        "churn", "heuristic_churn_baseline", "0.15", "0.95", "Will Churn", "Will Stay",
        ("tenure", "contract_type", "monthly_charges"),
        (
            ("contract_type", "0.30", F.col("contract_type") == "Month-to-month"),
            ("monthly_charges", "0.20", F.col("monthly_charges") >= 80),
            ("tenure", "0.20", F.col("tenure") < 12),
            ("payment_method", "0.10", F.col("payment_method") == "Electronic check"),
        ),
    )


def default_card() -> Scorecard:
    return Scorecard(
        "default", "heuristic_default_baseline", "0.10", "0.95", "Likely Default", "Likely Performing",
        ("fico_score", "debt_ratio", "grade"),
        (
            ("fico_score", "0.35", F.col("fico_score") < 620),
            ("debt_ratio", "0.25", F.col("debt_ratio") > 30),
            ("grade", "0.20", F.upper("grade").isin("E", "F", "G")),
            ("loan_amount", "0.10", F.col("loan_amount") > 25000),
        ),
    )


def fraud_card() -> Scorecard:
    return Scorecard(
        "fraud", "heuristic_fraud_baseline", "0.03", "0.98", "Fraud", "Legitimate",
        ("transaction_amt", "device_type", "email_domain"),
        (
            ("transaction_amt", "0.30", F.col("transaction_amt") > 500),
            ("device_type", "0.15", F.lower("device_type").isin("mobile", "unknown")),
            ("email_domain", "0.20", ~F.lower("email_domain").isin(*USUAL_DOMAINS)),
            ("card_type", "0.10", F.lower("card_type").isin("discover", "unknown")),
        ),
    )


def risk_band(probability: Column, threshold: float | Column) -> Column:
    """High, Elevated or Low, relative to the decision threshold."""
    limit = F.lit(threshold) if isinstance(threshold, float) else threshold
    high = (probability >= F.greatest(limit, F.lit(0.5)) * 1.5) | (probability >= 0.8)
    return F.when(high, F.lit("High")).when(probability >= limit, F.lit("Elevated")).otherwise(F.lit("Low"))

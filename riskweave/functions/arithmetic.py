"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import as_col


def ratio_if_positive(a: Column | str, b: Column | str, digits: int | None = None) -> Column:
    """``a / b`` where b > 0, else 0."""
    a, b = as_col(a), as_col(b)
    out = F.when(b > 0, F.try_divide(a.cast("double"), b.cast("double"))).otherwise(F.lit(0.0))
    return out if digits is None else F.round(out, digits)


def safe_divide(a: Column | str, b: Column | str, default: float | None = 0.0) -> Column:
    """``a / b`` as double; ``default`` (or null) where b is zero or an input is null."""
    out = F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))
    return out if default is None else F.coalesce(out, F.lit(default))


def mean(c: Column | str) -> Column:
    """Aggregate mean as one exact sum and one double division."""
    c = as_col(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def rate(flag: Column | str) -> Column:
    """Share of rows whose 0/1 flag is 1."""
    return mean(flag)


def sum_where(cond: Column, value: Column | str) -> Column:
    """Sum of a value over the rows of a condition; 0 when there are none."""
    value = as_col(value)
    return F.coalesce(F.sum(F.when(cond, value)), F.lit(0))


def log_amount(c: Column | str, default: float = 0.0) -> Column:
    """``1 + log10(x)`` for positive amounts."""
    x = as_col(c).cast("double")
    return F.when(x > 0, F.lit(1.0) + F.log10(x)).otherwise(F.lit(default))


def midpoint(low: Column | str, high: Column | str) -> Column:
    """Row-wise mean of two columns that ignores a missing side."""
    low, high = as_col(low).cast("double"), as_col(high).cast("double")
    return (F.coalesce(low, high) + F.coalesce(high, low)) / F.lit(2.0)


def credit_score(low: Column | str, high: Column | str, default: int = 600) -> Column:
    return F.coalesce(midpoint(low, high), F.lit(float(default))).cast("int")


def default_total(total: Column | str, tenure: Column | str, monthly: Column | str) -> Column:
    """A zero or missing lifetime total becomes tenure x monthly charge."""
    total = as_col(total)
    return F.when((total.isNull()) | (total == 0), as_col(tenure) * as_col(monthly)).otherwise(total)


def composite_risk(fraud: Column | str, default: Column | str, churn: Column | str) -> Column:
    """Weighted blend of three rates; a missing rate counts as 0."""
    # Blend weights.
    parts = ((fraud, 0.40), (default, 0.30), (churn, 0.30))
    terms = [F.lit(w) * F.coalesce(as_col(c).cast("double"), F.lit(0.0)) for c, w in parts]
    return terms[0] + terms[1] + terms[2]

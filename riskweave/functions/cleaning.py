"""Parsing and typing of raw text columns.

ANSI mode raises on a bad cast, so every parser uses the ``try_`` family and
turns bad text into null.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinels and formats of the raw files.
UNKNOWN = "unknown"
OTHER = "OTHER"
MONTH_FORMAT = "MMM-yyyy"
TRANSACTION_EPOCH = "2017-12-01 00:00:00"
TRANSACTION_EPOCH_SECONDS = 1512086400  # the epoch above, in UTC seconds


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str, type_: str = "double", default=None) -> Column:
    """Text to number; blanks and bad text become null (or ``default``)."""
    number = F.trim(as_col(c).cast("string")).try_cast(type_)
    if type_ == "double":
        number = F.when(~F.isnan(number), number)
    return number if default is None else F.coalesce(number, F.lit(default).cast(type_))


def parse_percent(c: Column | str, scale: float = 1.0, type_: str = "double") -> Column:
    """``"13.5%"`` to 13.5; ``scale=0.01`` gives the fraction instead."""
    number = F.trim(F.regexp_replace(as_col(c).cast("string"), "%", "")).try_cast(type_)
    return number if scale == 1.0 else number * F.lit(scale)


def parse_employment_years(c: Column | str) -> Column:
    """``"< 1 year"`` is 0, otherwise the first run of digits, else null."""
    text = F.trim(as_col(c).cast("string"))
    digits = F.regexp_extract(text, r"(\d+)", 1).try_cast("double")
    return F.when(text.startswith("<"), F.lit(0.0)).otherwise(digits)


def parse_month(c: Column | str) -> Column:
    """``"Dec-2015"`` to the first day of that month."""
    return F.try_to_timestamp(as_col(c), F.lit(MONTH_FORMAT)).cast("date")


def offset_timestamp(seconds: Column | str, epoch_seconds: int = TRANSACTION_EPOCH_SECONDS) -> Column:
    """Seconds after a fixed epoch, as a timestamp."""
    return F.timestamp_seconds(as_col(seconds) + F.lit(epoch_seconds))


def membership_flag(c: Column | str, values: Iterable[str]) -> Column:
    """1 when the value belongs to the set, 0 otherwise; null counts as 0."""
    return F.coalesce(as_col(c).isin(*values).cast("int"), F.lit(0))


def recode(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, keep the others."""
    col = as_col(c)
    out = None
    for old, new in mapping.items():
        out = F.when(col == old, F.lit(new)) if out is None else out.when(col == old, F.lit(new))
    return col if out is None else out.otherwise(col)


def fill_text(c: Column | str, default: str = UNKNOWN) -> Column:
    return F.coalesce(as_col(c).cast("string"), F.lit(default))


def blank_to(c: Column | str, default: str) -> Column:
    """Null or empty text becomes ``default``."""
    return F.coalesce(F.nullif(as_col(c), F.lit("")), F.lit(default))


def upper_code(c: Column | str) -> Column:
    return F.upper(F.trim(as_col(c)))


def lower_code(c: Column | str) -> Column:
    return F.lower(as_col(c))


def finite(c: Column | str) -> Column:
    """NaN and infinities become null."""
    col = as_col(c)
    limit = F.lit(float("inf"))
    return F.when(~F.isnan(col) & (col != limit) & (col != -limit), col)

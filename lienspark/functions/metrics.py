"""Risk ratios and spreads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def loan_to_value(amount: Column, value: Column) -> Column:
    """Loan as a fraction of the property value; NULL where the value is 0."""
    return F.try_divide(amount, value)


def debt_to_income(text: Column) -> Column:
    """Fraction from the first run of digits: ``30%-<36%`` is 0.30, ``NA`` NULL."""
    digits = F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit(""))
    return digits.cast("double") / 100


def rate_spread(rate: Column, benchmark: Column) -> Column:
    return rate - benchmark


def rounded_spread(rate: Column, benchmark: Column) -> Column:
    return F.round(rate - benchmark, 2)


def share(part: Column, whole: Column) -> Column:
    """``part`` over ``whole`` as a double, NULL over nothing."""
    return part.cast("double") / F.nullif(whole, F.lit(0))

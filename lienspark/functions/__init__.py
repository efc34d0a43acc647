"""Column expressions."""

from lienspark.functions.casts import text_to_double, text_to_integer
from lienspark.functions.metrics import (
    debt_to_income,
    loan_to_value,
    rate_spread,
    rounded_spread,
    share,
)
from lienspark.functions.segments import cost_category, risk_segment

__all__ = [
    "cost_category",
    "debt_to_income",
    "loan_to_value",
    "rate_spread",
    "risk_segment",
    "rounded_spread",
    "share",
    "text_to_double",
    "text_to_integer",
]

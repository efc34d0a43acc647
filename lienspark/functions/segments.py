"""Row rules of the fact.

Neither rule replaces NULL inputs: a comparison with NULL is not true, so the
row falls through to the next branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounds of the segments.
HIGH_LTV = 0.8
MEDIUM_LTV = 0.6
HIGH_DTI = 43


def risk_segment(ltv: Column, dti: Column, dti_scale: float = 1) -> Column:
    """High, Medium or Low.

    The data holds debt-to-income as a fraction while the bound is a percentage.
    ``dti_scale=1`` compares them as they are; ``dti_scale=100`` compares
    percent with percent.
    """
    if dti_scale != 1:
        dti = dti * dti_scale
    return (
        F.when((ltv > HIGH_LTV) | (dti > HIGH_DTI), "High")
        .when(ltv.between(MEDIUM_LTV, HIGH_LTV) & (dti <= HIGH_DTI), "Medium")
        .otherwise("Low")
    )


def cost_category(spread: Column) -> Column:
    return F.when(spread > 0, "High Cost").otherwise("Market/Subsidized")

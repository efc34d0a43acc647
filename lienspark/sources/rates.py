"""Interest rate series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalise_rates(
    series: DataFrame, date_column: str = "index", value_column: str = "value"
) -> DataFrame:
    """Any date/value series as ``observation_date``, ``fed_rate``.

    A missing observation may arrive as NaN, which would make the mean of its
    whole year NaN; it becomes NULL and is left out of the mean.
    """
    rate = F.col(value_column).cast("double")
    return series.select(
        F.col(date_column).cast("timestamp").alias("observation_date"),
        F.nanvl(rate, F.lit(None).cast("double")).alias("fed_rate"),
    )

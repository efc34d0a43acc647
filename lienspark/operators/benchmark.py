"""The yearly market benchmark and its join with loans.

Both joins aggregate the series themselves, so what they broadcast holds one
row per calendar year and cannot grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def yearly_benchmark(rates: DataFrame) -> DataFrame:
    """Mean rate of each calendar year."""
    return rates.groupBy(F.year("observation_date").alias("yr")).agg(
        F.avg("fed_rate").alias("mkt_benchmark")
    )


def yearly_benchmark_rounded(rates: DataFrame) -> DataFrame:
    """Mean rate of each year to two decimals, keyed like the loans."""
    return rates.groupBy(F.year("observation_date").alias("activity_year")).agg(
        F.round(F.avg("fed_rate"), 2).alias("avg_fed_rate")
    )


def join_benchmark(loans: DataFrame, rates: DataFrame) -> DataFrame:
    """Each loan with the benchmark of its year; ``yr`` stays in the result."""
    yearly = F.broadcast(yearly_benchmark(rates))
    return loans.join(yearly, loans["activity_year"] == yearly["yr"], "left")


def join_benchmark_rounded(loans: DataFrame, rates: DataFrame) -> DataFrame:
    """Each loan with the rounded benchmark, one ``activity_year`` in the result."""
    yearly = F.broadcast(yearly_benchmark_rounded(rates))
    return loans.join(yearly, "activity_year", "left")

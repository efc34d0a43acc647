"""Ratios, benchmark and spread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.functions import debt_to_income, loan_to_value, rate_spread
from lienspark.operators.benchmark import join_benchmark
from lienspark.sinks.lake import publish_year
from lienspark.sources.lake import read_loans, read_rates


def add_ratios(loans: DataFrame) -> DataFrame:
    """Loan-to-value and debt-to-income, both as fractions."""
    return loans.withColumns(
        {
            "loan_to_value_ratio": loan_to_value(F.col("loan_amount"), F.col("property_value")),
            "debt_to_income_numeric": debt_to_income(F.col("debt_to_income_ratio")),
        }
    )


def add_spread(loans: DataFrame) -> DataFrame:
    return loans.withColumn(
        "interest_rate_spread", rate_spread(F.col("interest_rate"), F.col("mkt_benchmark"))
    )


def enrich(loans: DataFrame, rates: DataFrame) -> DataFrame:
    """Loans with ratios, the benchmark of their year and the spread over it.

    Loans are read once and not shuffled: the benchmark is broadcast.
    """
    return add_spread(join_benchmark(add_ratios(loans), rates))


def enrich_year(
    spark: SparkSession, loans_root: str, rates_path: str, target_root: str, year: int
) -> DataFrame:
    """Enrich one year's folder into another one; returns the write report.

    The input is partitioned by state already, so the output is written in the
    tasks that read it, each of which holds files of few states.
    """
    loans = read_loans(spark, f"{loans_root}/{year}")
    return publish_year(
        enrich(loans, read_rates(spark, rates_path)), target_root, year, gather=False
    )

"""The exploration queries, on the other 20 columns of the register."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lienspark.functions import rounded_spread
from lienspark.operators.benchmark import join_benchmark_rounded, yearly_benchmark_rounded
from lienspark.operators.shaping import cast_money, originated_number, select_explore_columns

# Debt-to-income classes from 45 percent up, as the register writes them.
HIGH_DTI_CLASSES = ["45", "46", "47", "48", "49", "50%-60%", ">60%"]


def explore_loans(register: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Originated loans of a register read with inferred types."""
    return originated_number(cast_money(select_explore_columns(register, keep)))


def top_states(loans: DataFrame, n: int = 10) -> DataFrame:
    """States with most loans, with mean size and rate; equal counts by code."""
    return (
        loans.groupBy("state_code")
        .agg(
            F.count("*").alias("total_loans"),
            F.round(F.avg("loan_amount"), 2).alias("avg_loan_size"),
            F.round(F.avg("interest_rate"), 2).alias("avg_interest_rate"),
        )
        .orderBy(F.desc("total_loans"), F.asc_nulls_last("state_code"))
        .limit(n)
    )


def high_rate_high_dti(loans: DataFrame) -> DataFrame:
    """Loans above 6 percent in the high debt-to-income classes."""
    return loans.where(
        (F.col("interest_rate") > 6.0) & F.col("debt_to_income_ratio").isin(HIGH_DTI_CLASSES)
    )


def largest_first(loans: DataFrame, *tie_breaks: str) -> DataFrame:
    """Sorted by amount, then by the tie-breaks and all other columns.

    Amounts are rounded in the register, so few of them hold most loans; the
    further keys let equal amounts fall into several tasks.
    """
    others = [name for name in loans.columns if name not in ("loan_amount", *tie_breaks)]
    return loans.orderBy(F.desc_nulls_last("loan_amount"), *tie_breaks, *others)


def newest_rates(rates: DataFrame) -> DataFrame:
    """The rate series by year and date, both descending."""
    dated = rates.withColumn("activity_year", F.year("observation_date"))
    return dated.orderBy(F.desc("activity_year"), F.desc("observation_date"))


def newest_benchmarks(rates: DataFrame) -> DataFrame:
    """The rounded yearly benchmark, newest year first."""
    return yearly_benchmark_rounded(rates).orderBy(F.desc("activity_year"))


def unmatched(loans: DataFrame) -> DataFrame:
    """Loans whose year has no benchmark."""
    return loans.where(F.col("avg_fed_rate").isNull())


def matched_spread(loans: DataFrame) -> DataFrame:
    """Loans with a benchmark, and the spread to two decimals."""
    return loans.dropna(subset=["avg_fed_rate"]).withColumn(
        "interest_rate_spread", rounded_spread(F.col("interest_rate"), F.col("avg_fed_rate"))
    )


def explore(
    register: DataFrame,
    rates: DataFrame,
    keep: Sequence[str] = (),
    view: str | None = None,
) -> dict[str, DataFrame]:
    """Every frame of the exploration; ``view`` names the loans for SQL of one's own."""
    loans = explore_loans(register, keep)
    if view:
        loans.createOrReplaceTempView(view)
    joined = join_benchmark_rounded(loans, rates)
    return {
        "loans": loans,
        "n_loans": loans.agg(F.count("*").alias("n_loans")),
        "top_states": top_states(loans),
        "high_rate_high_dti": largest_first(
            high_rate_high_dti(loans).select(
                *keep, "lei", "loan_amount", "income", "debt_to_income_ratio", "interest_rate"
            ),
            *keep,
        ),
        "newest_rates": newest_rates(rates),
        "newest_benchmarks": newest_benchmarks(rates),
        "n_unmatched": unmatched(joined).agg(F.count("*").alias("n_unmatched")),
        "unmatched": unmatched(joined).select(*keep, "activity_year", "lei"),
        "spread": matched_spread(joined).select(
            *keep, "activity_year", "lei", "interest_rate", "avg_fed_rate", "interest_rate_spread"
        ),
    }

"""Grouped results over the fact and over the summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lienspark.functions import share

SUMMARY_KEYS = ["data_year", "state_code", "state_name", "risk_segment", "loan_purpose_name"]


def risk_summary(fact: DataFrame) -> DataFrame:
    """Counts, sums and means per year, state, segment and purpose.

    The segment is a key, so ``high_risk_ratio`` is 1 in the High rows and 0 in
    the others; ``high_risk_by_state`` gives the share within a state.
    """
    high = F.count_if(F.col("risk_segment") == "High")
    return fact.groupBy(*SUMMARY_KEYS).agg(
        F.count("*").alias("loan_count"),
        F.sum("loan_amount").alias("total_loan_amount"),
        F.sum("interest_rate").alias("sum_interest_rate"),
        F.avg("interest_rate_spread").alias("avg_rate_spread"),
        share(high, F.count("*")).alias("high_risk_ratio"),
    )


def summary_by_code(segmented: DataFrame) -> DataFrame:
    """The summary's parts per year, codes and segment: sums and counts to add up."""
    return segmented.groupBy("data_year", "state_code", "loan_purpose", "risk_segment").agg(
        F.count("*").alias("loan_count"),
        F.sum("loan_amount").alias("total_loan_amount"),
        F.sum("interest_rate").alias("sum_interest_rate"),
        F.sum("interest_rate_spread").alias("sum_spread"),
        F.count("interest_rate_spread").alias("n_spreads"),
    )


def merged_summary(parts: DataFrame) -> DataFrame:
    """The summary from described parts; codes of one name fall together."""
    loans = F.sum("loan_count")
    high = F.coalesce(F.sum(F.when(F.col("risk_segment") == "High", F.col("loan_count"))), F.lit(0))
    return parts.groupBy(*SUMMARY_KEYS).agg(
        loans.alias("loan_count"),
        F.sum("total_loan_amount").alias("total_loan_amount"),
        F.sum("sum_interest_rate").alias("sum_interest_rate"),
        (F.sum("sum_spread") / F.nullif(F.sum("n_spreads"), F.lit(0))).alias("avg_rate_spread"),
        share(high, loans).alias("high_risk_ratio"),
    )


def heatmap(summary: DataFrame, year: int) -> DataFrame:
    """Loans per state of one year, all states."""
    return (
        summary.where(F.col("data_year") == year)
        .groupBy("state_code")
        .agg(F.sum("loan_count").alias("loan_count"))
    )


def kpis(summary: DataFrame) -> DataFrame:
    """One row of headline figures; zeros where there are no loans.

    The rate divides the sum of the known rates by all loans, so loans without
    a rate lower it.
    """
    high = F.sum(F.when(F.col("risk_segment") == "High", F.col("loan_count")))
    return kpis_of(summary, high)


def kpis_of(rows: DataFrame, high: Column) -> DataFrame:
    """The headline figures of rows with sums, given the aggregate of high-risk loans."""
    loans = F.coalesce(F.sum("loan_count"), F.lit(0))
    rates = F.sum("sum_interest_rate")
    return rows.agg(
        loans.alias("total_loans"),
        (F.coalesce(F.sum("total_loan_amount"), F.lit(0.0)) / 1e6).alias(
            "portfolio_value_millions"
        ),
        F.coalesce(share(rates, loans), F.lit(0.0)).alias("avg_market_rate"),
        F.coalesce(share(high, loans) * 100, F.lit(0.0)).alias("high_risk_pct"),
    )


def risk_hierarchy(summary: DataFrame) -> DataFrame:
    """Loans per segment, and per purpose within it.

    ``is_total`` tells the segment's own row from a loan without a purpose.
    """
    return (
        summary.rollup("risk_segment", "loan_purpose_name")
        .agg(
            F.sum("loan_count").alias("loan_count"),
            F.grouping("loan_purpose_name").cast("int").alias("is_total"),
            F.grouping("risk_segment").alias("is_grand_total"),
        )
        .where(F.col("is_grand_total") == 0)
        .drop("is_grand_total")
    )


def purpose_breakdown(summary: DataFrame) -> DataFrame:
    """Loans per purpose and segment, of loans with a known purpose."""
    return (
        summary.where(F.col("loan_purpose_name").isNotNull())
        .groupBy("loan_purpose_name", "risk_segment")
        .agg(F.sum("loan_count").alias("loan_count"))
    )


def years(summary: DataFrame) -> DataFrame:
    """Years on offer, newest first."""
    return summary.select("data_year").distinct().orderBy(F.desc("data_year"))


def state_names(summary: DataFrame) -> DataFrame:
    """Named states on offer, sorted."""
    return (
        summary.where(F.col("state_name").isNotNull())
        .select("state_name")
        .distinct()
        .orderBy("state_name")
    )

"""Questions the documentation asks of the fact though no code answers them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lienspark.functions import share
from lienspark.operators.sampling import SAMPLE_ROWS, random_rows


def high_risk_by_state(fact: DataFrame) -> DataFrame:
    """States by their share of High loans, highest first."""
    high = F.count_if(F.col("risk_segment") == "High")
    return (
        fact.groupBy("state_code", "state_name")
        .agg(F.count("*").alias("loan_count"), share(high, F.count("*")).alias("high_risk_share"))
        .orderBy(F.desc("high_risk_share"), F.asc_nulls_last("state_code"))
    )


def ltv_beside_benchmark(fact: DataFrame) -> DataFrame:
    """Mean loan-to-value of each year beside its benchmark."""
    return fact.groupBy("data_year").agg(
        F.avg("loan_to_value_ratio").alias("avg_ltv"),
        F.avg("mkt_benchmark").alias("mkt_benchmark"),
    )


def segment_shares(fact: DataFrame) -> DataFrame:
    """Each segment's share of its state. The window runs over counts, not loans."""
    counts = fact.groupBy("state_code", "risk_segment").agg(F.count("*").alias("loan_count"))
    in_state = F.sum("loan_count").over(Window.partitionBy("state_code"))
    return counts.withColumn("segment_share", share(F.col("loan_count"), in_state))


def ratio_kpis(fact: DataFrame) -> DataFrame:
    """Mean loan-to-value and debt-to-income."""
    return fact.agg(
        F.avg("loan_to_value_ratio").alias("avg_ltv"),
        F.avg("debt_to_income_numeric").alias("avg_dti"),
    )


def segment_distribution(fact: DataFrame) -> DataFrame:
    return fact.groupBy("risk_segment").agg(F.count("*").alias("loan_count"))


def loan_type_breakdown(fact: DataFrame) -> DataFrame:
    return fact.groupBy("loan_type_name").agg(F.count("*").alias("loan_count"))


def ltv_dti_sample(
    fact: DataFrame,
    n: int = SAMPLE_ROWS,
    seed: int | None = None,
    reproducible: bool = False,
) -> DataFrame:
    """Random loans with both ratios and the segment."""
    known = fact.where(
        F.col("loan_to_value_ratio").isNotNull() & F.col("debt_to_income_numeric").isNotNull()
    )
    return random_rows(known, n, seed=seed, reproducible=reproducible).select(
        "id", "loan_to_value_ratio", "debt_to_income_numeric", "risk_segment"
    )


def by_segment_and_type(
    fact: DataFrame, segments: Sequence[str], loan_types: Sequence[str]
) -> DataFrame:
    """Loans of the chosen segments and types; the summary has no loan type."""
    return fact.where(
        F.col("risk_segment").isin(list(segments)) & F.col("loan_type_name").isin(list(loan_types))
    )


def in_states(fact: DataFrame, states: DataFrame, year: int, names: Sequence[str]) -> DataFrame:
    """Loans of one year in the named states; a name may have several codes.

    ``states`` is the lookup. The warehouse is partitioned by code; with a lookup
    read from a table or files, its codes of the names become a partition filter
    when the query runs, so only those states' folders are read.
    """
    codes = states.where(F.col("state_name").isin(list(names))).select("state_code")
    return fact.where(F.col("data_year") == year).join(codes, "state_code", "left_semi")

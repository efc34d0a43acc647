"""Choosing, casting and filling columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lienspark.functions import text_to_double, text_to_integer
from lienspark.schemas import (
    CODE_COLUMNS,
    EXPLORE_COLUMNS,
    LOAD_COLUMNS,
    REGISTER_COLUMNS,
    REGISTER_TYPES,
    SAMPLE_COLUMNS,
    STAGING_COLUMNS,
)


def select_loan_columns(register: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 20 register columns, after any further ones to ``keep``."""
    return register.select(*keep, *REGISTER_COLUMNS)


def select_explore_columns(register: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The other 20 columns, used by the exploration queries."""
    return register.select(*keep, *EXPLORE_COLUMNS)


def originated_text(register: DataFrame) -> DataFrame:
    """Loans that were made, told by the text code before any cast."""
    return register.where(F.col("action_taken") == "1")


def originated_number(register: DataFrame) -> DataFrame:
    """Loans that were made, where the code is already a number."""
    return register.where(F.col("action_taken") == 1)


def cast_loans(register: DataFrame) -> DataFrame:
    """Register types for the register's columns; others pass through."""

    def typed(name: str) -> Column:
        target = REGISTER_TYPES.get(name, "string")
        if target == "string":
            return F.col(name)
        if target == "double":
            return text_to_double(name).alias(name)
        return text_to_integer(name, target).alias(name)

    return register.select(*(typed(name) for name in register.columns))


def cast_money(register: DataFrame) -> DataFrame:
    """Doubles for the four money columns of the exploration set."""
    money = ["loan_amount", "interest_rate", "property_value", "income"]
    return register.withColumns({name: text_to_double(name) for name in money})


def stamp_year(loans: DataFrame, year: int) -> DataFrame:
    """The run's year as ``data_year``, whatever the file says."""
    return loans.withColumn("data_year", F.lit(year).cast("int"))


def available(loans: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The load columns a frame has, in load order."""
    present = loans.columns
    return loans.select(*keep, *(name for name in LOAD_COLUMNS if name in present))


def zero_codes(loans: DataFrame) -> DataFrame:
    """Missing codes and years as 0, whole numbers."""
    present = loans.columns
    return loans.withColumns(
        {
            name: F.expr(f"CAST(coalesce({name}, 0) AS int)")
            for name in CODE_COLUMNS
            if name in present
        }
    )


def zero_income(loans: DataFrame) -> DataFrame:
    """Missing income as 0, cut to a whole number."""
    if "income" not in loans.columns:
        return loans
    return loans.withColumn("income", F.expr("CAST(coalesce(income, 0) AS bigint)"))


def upper_names(loans: DataFrame) -> DataFrame:
    return loans.toDF(*(name.upper() for name in loans.columns))


def staging_view(warehouse: DataFrame, year: int | None = None) -> DataFrame:
    """The columns the models read, of all years or of one."""
    if year is not None:
        warehouse = warehouse.where(F.col("data_year") == year)
    return warehouse.select(
        *STAGING_COLUMNS, F.current_timestamp().alias("dbt_updated_at")
    )


def select_sample_columns(fact: DataFrame) -> DataFrame:
    return fact.select(*SAMPLE_COLUMNS)

"""Register text to state-partitioned Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lienspark.operators.shaping import cast_loans, originated_text, select_loan_columns
from lienspark.sinks.lake import publish_year, write_by_state
from lienspark.sources.register import read_register


def clean_loans(register: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Originated loans of a register, 20 columns, typed.

    The filter compares text and comes before the casts, so the scan can apply
    it while it parses.
    """
    return cast_loans(originated_text(select_loan_columns(register, keep)))


def ingest_loans(
    spark: SparkSession, source: str, target: str, year: int | None = None
) -> DataFrame:
    """Read the text at ``source``, write it below ``target`` by state.

    With a year the folder ``<target>/<year>`` is replaced. Returns the report of
    the write: columns, rows and files.
    """
    loans = clean_loans(read_register(spark, source))
    if year is None:
        return write_by_state(loans, target)
    return publish_year(loans, target, year)

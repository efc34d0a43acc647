"""Parquet folders written by the earlier steps."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.settings import session_conf


def read_loans(spark: SparkSession, path: str) -> DataFrame:
    """Loans partitioned by state; the state stays text whatever it looks like."""
    with session_conf(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        return spark.read.parquet(path)


read_staging = read_loans


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def input_present(spark: SparkSession, source: str | DataFrame, year: int | None = None) -> bool:
    """Whether there is anything to do: a folder with rows, or rows of ``year``.

    Given a frame with ``data_year``, the year is a partition filter, and the
    first row found ends the search.
    """
    if isinstance(source, str):
        try:
            source = read_loans(spark, source)
        except AnalysisException:
            return False
    if year is not None:
        source = source.where(F.col("data_year") == year)
    return not source.isEmpty()

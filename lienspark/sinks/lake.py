"""Parquet folders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lienspark.operators.layout import GATHER_SETTINGS, cluster_by, gather_by
from lienspark.schemas import PARTITION_KEYS
from lienspark.settings import OPEN_FILES_SETTINGS, WIDE_ROW_SETTINGS, session_conf
from lienspark.sinks.folders import replace_folder


def write_by_state(loans: DataFrame, path: str, gather: bool = True) -> DataFrame:
    """Replace ``path`` by one folder per state; returns a one-row report.

    Rows in any order need one shuffle, or every task would write a small file
    for every state. Loans read from a folder that is already partitioned by
    state come in tasks of few states each: ``gather=False`` writes them as they
    are, without a shuffle. A task writes its states side by side, unsorted, so it
    holds the open files' buffers and not its rows. A write that fails leaves the
    old folder in place.
    """
    spark = loans.sparkSession
    report = Observation(f"write-{uuid.uuid4().hex}")
    rows = gather_by(loans, "state_code") if gather else loans
    rows = rows.observe(report, F.count(F.lit(1)).alias("rows_loaded"))
    with session_conf(spark, GATHER_SETTINGS | OPEN_FILES_SETTINGS | WIDE_ROW_SETTINGS):
        replace_folder(spark, path, rows.write.partitionBy("state_code").parquet)
    return spark.range(1).select(
        F.lit(len(loans.columns)).alias("n_columns"),
        F.lit(report.get["rows_loaded"]).cast("bigint").alias("rows_loaded"),
        F.lit(count_files(spark, path)).cast("bigint").alias("n_files"),
    )


def publish_year(loans: DataFrame, root: str, year: int, gather: bool = True) -> DataFrame:
    """Replace everything below ``<root>/<year>/``."""
    return write_by_state(loans, f"{root}/{year}", gather=gather)


def write_rates(rates: DataFrame, path: str) -> None:
    """The rate series with microsecond timestamps."""
    microseconds = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}
    with session_conf(rates.sparkSession, microseconds):
        rates.write.mode("overwrite").parquet(path)


def write_clustered(loans: DataFrame, path: str, files: int | None = None) -> None:
    """Files of one year and few states each, so a filter on them skips most of them."""
    with session_conf(loans.sparkSession, GATHER_SETTINGS | WIDE_ROW_SETTINGS):
        clustered = cluster_by(loans, *PARTITION_KEYS, files=files)
        replace_folder(loans.sparkSession, path, clustered.write.parquet)


def count_files(spark: SparkSession, path: str) -> int:
    """Parquet files below a path: listed, and asked for their status, but not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .count()
    )

"""Folders whose files can be left out by ranges of several columns.

The files follow a curve through the columns, and a table beside them holds every
file's least and greatest value of each. A reader asks that table first, so files
outside its ranges are neither listed nor opened.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.operators.layout import GATHER_SETTINGS, curve_by
from lienspark.settings import WIDE_ROW_SETTINGS, session_conf
from lienspark.sinks.folders import replace_folder

CURVE_COLUMNS = ("loan_to_value_ratio", "interest_rate_spread")
YEAR = "data_year"
RANGES = "_ranges"

Bounds = Mapping[str, tuple[float | None, float | None]]


def write_curved(
    loans: DataFrame, path: str, columns: Sequence[str] = CURVE_COLUMNS, files: int | None = None
) -> None:
    """Replace ``path`` by files of one year and narrow ranges of all ``columns``."""
    spark = loans.sparkSession

    def write(place: str) -> None:
        curve_by(loans, YEAR, columns, files).write.parquet(place)
        file_ranges(spark, place, columns).coalesce(1).write.parquet(f"{place}/{RANGES}")

    with session_conf(spark, GATHER_SETTINGS | WIDE_ROW_SETTINGS):
        replace_folder(spark, path, write)


def file_ranges(spark: SparkSession, path: str, columns: Sequence[str] = CURVE_COLUMNS) -> DataFrame:
    """Rows, year, and least and greatest value of each column, of every file."""
    ends = [f(name).alias(f"{end}_{name}") for name in columns for end, f in (("least", F.min), ("greatest", F.max))]
    rows = spark.read.parquet(path)
    return rows.groupBy(F.col("_metadata.file_name").alias("file"), YEAR).agg(F.count("*").alias("n_rows"), *ends)


def _within(value: Column, low: float | None, high: float | None) -> list[Column]:
    return [value >= low] * (low is not None) + [value <= high] * (high is not None)


def read_curved(spark: SparkSession, path: str, bounds: Bounds, year: int | None = None) -> DataFrame:
    """The rows whose columns lie within their bounds, both included; None is no bound.

    Only files whose ranges meet all bounds are opened. A null is within no bounds.
    """
    known = spark.read.parquet(f"{path}/{RANGES}")
    schema = spark.read.parquet(path).schema
    meets, inside = [F.lit(True)], [F.lit(True)]
    if year is not None:
        meets.append(F.col(YEAR).eqNullSafe(F.lit(year)))
        inside.append(F.col(YEAR) == year)
    for name, (low, high) in bounds.items():
        meets += _within(F.col(f"greatest_{name}"), low, None) + _within(F.col(f"least_{name}"), None, high)
        inside += _within(F.col(name), low, high)
    for condition in meets:
        known = known.where(condition)
    files = [f"{path}/{row.file}" for row in known.select("file").distinct().collect()]
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for condition in inside:
        rows = rows.where(condition)
    return rows

"""Data tests. Each returns the failures; no rows means the test passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHOWN_FAILURES = 5
# More intervals of ids than this are not looked at one after the other.
MOST_INTERVALS = 100_000


class DataTestFailure(Exception):
    """A data test found rows, so nothing that depends on them may be built."""


def unique_failures(rows: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not values."""
    return (
        rows.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def unique_failures_in_files(rows: DataFrame, column: str) -> DataFrame:
    """As ``unique_failures`` of a whole number, over rows read from Parquet files.

    Where a number minus its row's place in the file is the same, numbers are the
    distinct ones of an interval. Ids that were numbered in the order of rows make
    few such intervals, which are found without moving an id; only files whose
    intervals touch others are grouped. Numbers in any other order would make very
    many, and are all grouped as usual: a first pass tells how many there are.
    """
    spark = rows.sparkSession
    file = F.col("_metadata.file_path").alias("_file")
    shift = (F.col(column) - F.col("_metadata.row_index")).alias("_shift")
    placed = rows.where(F.col(column).isNotNull()).select(F.col(column), file, shift)
    per_file = placed.groupBy("_file").agg(F.approx_count_distinct("_shift").alias("n"))
    if (per_file.agg(F.sum("n")).first()[0] or 0) > MOST_INTERVALS:
        return unique_failures(rows, column)
    intervals = placed.groupBy("_file", "_shift").agg(F.min(column).alias("low"), F.max(column).alias("high"))
    line = Window.orderBy("low", "high", "_file")
    before = F.max("high").over(line.rowsBetween(Window.unboundedPreceding, -1))
    touching = intervals.withColumns({"before": before, "after": F.lead("low").over(line)})
    files = touching.where("low <= before OR high >= after").select("_file").distinct().collect()
    if not files:
        return spark.createDataFrame([], unique_failures(rows, column).schema)
    known = F.broadcast(spark.createDataFrame(files, "_file string"))
    return unique_failures(placed.join(known, "_file", "left_semi"), column)


def not_null_failures(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns holding NULLs and how many, all counted in one pass."""
    counts = rows.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    return (
        counts.unpivot([], list(columns), "column_name", "n_rows").where(F.col("n_rows") > 0)
    )


def accepted_values_failures(
    rows: DataFrame, accepted: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Values outside the accepted ones per column, in one pass; NULL passes.

    Rows without a failure are filtered out before anything is made of them, so
    clean data shuffles nothing.
    """
    outside = {name: ~F.col(name).isin(list(values)) for name, values in accepted.items()}
    failing = (
        F.when(
            fails,
            F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value")),
        )
        for name, fails in outside.items()
    )
    return (
        rows.where(reduce(or_, outside.values()))
        .select(F.inline(F.array_compact(F.array(*failing))))
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n_rows"))
    )


def require_none(failures: DataFrame, test: str) -> None:
    """Raise with a few of the failures, if there are any."""
    shown = failures.take(SHOWN_FAILURES)
    if shown:
        raise DataTestFailure(f"{test}: {[row.asDict() for row in shown]}")

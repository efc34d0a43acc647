"""Row ids that are unique over the whole table, from where a row is written."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lienspark.settings import fresh_path

# An id is year | number of the row in its year, from 1.
YEAR_SHIFT = 48
# Above so many files the offsets are joined like any other table.
BROADCAST_FILES = 100_000

_FILE, _ROW = "_id_file", "_id_row"


def year_start(year: int) -> int:
    """First id of a year. A year is always replaced whole, so its range is free."""
    return year << YEAR_SHIFT


def _placed(rows: DataFrame) -> DataFrame:
    return rows.select(
        "*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW)
    )


def _whole_files(placed: DataFrame) -> Mapping[str, int] | None:
    """Rows of each file; None unless every row of every file is there once.

    Reads no column. Sum and parity of the places tell apart files that are whole
    from rows that were filtered or multiplied after they were read.
    """
    files = placed.groupBy(_FILE).agg(
        F.count("*").alias("n"),
        F.max(_ROW).alias("last"),
        F.sum(_ROW).alias("places"),
        F.bit_xor(_ROW).alias("parity"),
    )
    counts = {}
    for file in files.collect():
        last = file.n - 1
        parity = (last, 1, file.n, 0)[last % 4]
        if (file["last"], file.places, file.parity) != (last, last * file.n // 2, parity):
            return None
        counts[file[_FILE]] = file.n
    return counts


def add_surrogate_id(rows: DataFrame, start: int, name: str = "id") -> DataFrame:
    """Ids ``start + 1``, ``start + 2`` and so on, without a gap, as a bigint.

    The rows of each Parquet file are counted, the counts summed in order of the
    files' paths, and a row's id is its file's sum and its place in the file. Where
    a row is read, by which task and how often, does not matter, so a task that runs
    again gives the same ids, and no number of rows or tasks is too large. What the
    driver holds is a number for each file, of which it holds the listing anyway.

    Rows that are not those of whole Parquet files, as they come from a join, a
    filter or memory, are written to the shared folder first.
    """
    spark = rows.sparkSession
    try:
        placed = _placed(rows)
        counts = _whole_files(placed)
    except AnalysisException:
        counts = None
    if counts is None:
        path = fresh_path(spark, "numbered")
        rows.write.parquet(path)
        placed = _placed(spark.read.schema(rows.schema).parquet(path))
        counts = _whole_files(placed)
    offsets, total = [], start
    for file in sorted(counts):
        offsets.append((file, total))
        total += counts[file]
    known = spark.createDataFrame(offsets, f"{_FILE} string, _id_before bigint")
    if len(offsets) <= BROADCAST_FILES:
        known = F.broadcast(known)
    number = F.col("_id_before") + F.col(_ROW) + 1
    joined = placed.join(known, _FILE).withColumn(name, number.cast("bigint"))
    return joined.drop(_FILE, _ROW, "_id_before")

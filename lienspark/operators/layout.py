"""How rows are spread over tasks before a write."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lienspark.settings import fresh_path

# Rows of a file of a clustered layout, where their number is not given.
FILE_ROWS = 4_000_000
# Of what is known of keys, so many rows are broadcast at most.
BROADCAST_ROWS = 1_000_000
# Bits of a place on the curve, shared by its columns.
CURVE_BITS = 14
NO_BIN = -(1 << 40)

# For the session around the action that runs a gathered frame.
GATHER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def gather_by(rows: DataFrame, *columns: str) -> DataFrame:
    """Bring equal keys together, in tasks of about equal size.

    The rebalance hint lets adaptive execution cut a key that is too large for
    one task into many, and put small keys together, so neither a state with a
    third of the loans nor a tiny one is a problem.
    """
    return rows.hint("rebalance", *columns)


def _written(rows: DataFrame, name: str) -> DataFrame:
    path = fresh_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _known(rows: DataFrame, few: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``few`` joined by keys that may be null; broadcast up to a bound of its rows."""
    if few.count() <= BROADCAST_ROWS:
        few = F.broadcast(few)
    renamed = few.withColumnsRenamed({key: f"_{key}" for key in keys})
    same = reduce(and_, (F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys))
    return rows.join(renamed, same).drop(*(f"_{key}" for key in keys))


def file_numbers(rows: DataFrame, whole: str, *keys: str, files: int | None = None) -> tuple[DataFrame, int]:
    """Rows with ``_file``, a number below the second result, by the order of the keys.

    Every file holds rows of one value of ``whole`` and of neighbouring ``keys``. The
    rows of each value are counted, and the order of all rows is cut into files of
    about equal size: small neighbours share a file, and a key that spans several is
    spread over them by a hash of its rows. As all is counted and nothing sampled,
    the same rows come to the same files on every run, however they are partitioned.
    """
    spark = rows.sparkSession
    counts = _written(rows.groupBy(whole, *keys).agg(F.count("*").alias("_n")), "counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    per_file = max(1, -(-total // files) if files else FILE_ROWS)
    values = counts.groupBy(whole).agg(F.sum("_n").alias("_all"))
    values = values.withColumn("_files", F.ceil(F.col("_all") / per_file))
    # One row for each value of ``whole``, of which there are few.
    first, shared = 0, []
    for row in values.orderBy(F.asc_nulls_first(whole)).collect():
        shared.append((row[whole], row["_all"], row["_files"], first))
        first += row["_files"]
    kind = counts.schema[whole].dataType.simpleString()
    known = spark.createDataFrame(shared, f"`{whole}` {kind}, _all long, _files long, _first long")
    line = Window.partitionBy(whole).orderBy(*(F.asc_nulls_first(key) for key in keys))
    before = F.sum("_n").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    laid = _known(counts.withColumn("_before", before), known, [whole])
    fraction = F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 52)) / F.lit(float(1 << 52))
    place = F.col("_before") + fraction * F.col("_n")
    number = F.least(F.floor(place * F.col("_files") / F.col("_all")), F.col("_files") - 1)
    placed = _known(rows, laid, [whole, *keys]).withColumn("_file", (F.col("_first") + number).cast("int"))
    return placed.drop("_n", "_before", "_all", "_files", "_first"), first


def cluster_by(rows: DataFrame, whole: str, *keys: str, files: int | None = None) -> DataFrame:
    """Rows in files of one value of ``whole`` and neighbouring ``keys``, ordered by them.

    The minimum and maximum a file keeps of the keys leave out all other files. A
    file by itself is one task; ``files`` is about their number, by default as many
    as take ``FILE_ROWS`` each. The keys' columns are read once before the write.
    """
    placed, n = file_numbers(rows, whole, *keys, files=files)
    dealt = placed.repartitionById(max(1, n), F.col("_file"))
    return dealt.drop("_file").sortWithinPartitions(whole, *keys)


def _bin(column: str) -> Column:
    """A whole number that grows with the column; null is the least.

    Numbers of one bin differ by about one percent, or by a thousandth near 0.
    """
    value = F.col(column).cast("double")
    steps = F.floor(F.signum(value) * F.log2(1 + F.abs(value) * 1024) * 64)
    return F.when(value.isNotNull() & ~F.isnan(value), steps).otherwise(F.lit(NO_BIN)).cast("long")


def curve_place(rows: DataFrame, whole: str, columns: Sequence[str], name: str) -> DataFrame:
    """Rows with their place on a curve that winds through all ``columns`` at once.

    Each column's values are ranked among the rows of the same ``whole``, by counts
    of their bins, and the ranks' bits are interleaved. Rows that are close on the
    curve are close in every column, so files that follow it have narrow ranges of
    each. Text is no column for it.
    """
    bits = CURVE_BITS // len(columns)
    bins = {f"_bin{i}": _bin(column) for i, column in enumerate(columns)}
    binned = rows.withColumns(bins)
    named = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.col(b).alias("bin")) for i, b in enumerate(bins))))
    counts = binned.select(whole, named.alias("c")).groupBy(whole, "c.i", "c.bin").agg(F.count("*").alias("n"))
    line = Window.partitionBy(whole, "i")
    before = F.sum("n").over(line.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    rank = F.floor(before * (1 << bits) / F.sum("n").over(line)).cast("int")
    ranks = _written(counts.select(whole, "i", "bin", rank.alias("rank")), "ranks")
    place = F.lit(0)
    for i, own in enumerate(bins):
        few = ranks.where(F.col("i") == i).select(whole, F.col("bin").alias(own), F.col("rank").alias(f"_rank{i}"))
        binned = _known(binned, few, [whole, own])
        for bit in range(bits):
            one = F.shiftright(F.col(f"_rank{i}"), bit).bitwiseAND(F.lit(1))
            place = place.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - i))
    return binned.withColumn(name, place).drop(*bins, *(f"_rank{i}" for i in range(len(columns))))


def curve_by(rows: DataFrame, whole: str, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows in files of one value of ``whole`` and narrow ranges of all ``columns``."""
    placed = curve_place(rows, whole, columns, "_curve")
    return cluster_by(placed, whole, "_curve", files=files).drop("_curve")

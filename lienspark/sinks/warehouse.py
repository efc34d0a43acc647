"""The warehouse table: one folder per year and, below it, per state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.operators.layout import GATHER_SETTINGS
from lienspark.schemas import PARTITION_KEYS, WAREHOUSE_TYPES
from lienspark.settings import WIDE_ROW_SETTINGS
from lienspark.sinks import generations

TABLE_BLOOM_COLUMN = "lei"


def create_loan_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Create the loan table if it is not there; years loaded to ``location`` show.

    Instead of indexes, Parquet keeps minimum and maximum of every column per
    row group, and a bloom filter for the lender id. The filter is left out of a
    file whose column is written as a dictionary, so the lender's is not.
    """
    options = {
        f"parquet.bloom.filter.enabled#{TABLE_BLOOM_COLUMN}": "true",
        f"parquet.enable.dictionary#{TABLE_BLOOM_COLUMN}": "false",
    }
    inner = [key for key in PARTITION_KEYS if key != generations.YEAR]
    generations.create(spark, table, WAREHOUSE_TYPES, inner, options, location)


def _rows_of(spark: SparkSession, table: str, year: int) -> int:
    """Rows of a year: only file footers are read."""
    return spark.table(table).where(F.col("data_year") == year).count()


def replace_year(
    loans: DataFrame, table: str, year: int, batch_rows: int | None = None
) -> DataFrame:
    """Make ``loans`` the only rows of ``year``; other years stay.

    The new rows are written beside the old ones and take their place in one step
    when all tasks are done, states that vanish and states that come alike. Each
    task writes its rows as they come; ``batch_rows`` starts a new file after as
    many, whose bloom filter is as large as that many lenders need and not the whole
    megabyte it may take. Returns one row: ``rows_removed`` and ``rows_loaded``.
    """
    spark = loans.sparkSession
    year = int(year)
    values = loans.select(
        *(
            F.col(name).cast(kind) if name in loans.columns else F.lit(None).cast(kind).alias(name)
            for name, kind in WAREHOUSE_TYPES.items()
            if name != generations.YEAR
        )
    )
    removed = _rows_of(spark, table, year)
    batches = {"spark.sql.files.maxRecordsPerFile": str(batch_rows or 0)}
    if batch_rows:
        batches[f"parquet.bloom.filter.expected.ndv#{TABLE_BLOOM_COLUMN}"] = str(batch_rows)
    generations.replace(values, table, year, batches | GATHER_SETTINGS | WIDE_ROW_SETTINGS)
    return spark.range(1).select(
        F.lit(removed).cast("bigint").alias("rows_removed"),
        F.lit(_rows_of(spark, table, year)).cast("bigint").alias("rows_loaded"),
    )


def written_files(spark: SparkSession, table: str, year: int) -> DataFrame:
    """Rows of every file, or batch, of a year: ``state_code file n_rows``, from the footers."""
    rows = generations.current_rows(spark, table).where(F.col("data_year") == year)
    return rows.groupBy("state_code", F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("n_rows")
    )


def partition_keys(loans: DataFrame) -> DataFrame:
    """State codes that get a partition of their own."""
    return loans.where(F.col("state_code").isNotNull()).select("state_code").distinct()

"""The yearly loan register: delimited text with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_register(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, named by the header.

    Spark reads one line to learn the names and no data. ``enforceSchema=False``
    makes every further file prove that its header agrees, so a file with its
    columns in another order fails instead of filling the wrong columns.
    """
    return (
        spark.read.option("sep", "|")
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_register_inferred(spark: SparkSession, path: str) -> DataFrame:
    """The register with types guessed from the data, which reads it twice."""
    return (
        spark.read.option("sep", "|")
        .option("header", True)
        .option("inferSchema", True)
        .csv(path)
    )

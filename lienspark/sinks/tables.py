"""Catalog tables that are replaced whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lienspark.sinks.folders import delete_folder, folders_like


def place_of_table(spark: SparkSession, table: str) -> str:
    """The folder a catalog table's files are in now."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(row.data_type for row in rows if row.col_name == "Location")


def publish_table(
    rows: DataFrame, table: str, test: Callable[[DataFrame], None] | None = None
) -> None:
    """Make ``rows`` the contents of ``database.table``.

    They are written to a new folder of the database and tested there; only then
    the table's location is changed, in one step. A write or test that fails leaves
    the table as it was. The folder before the last change is kept, because other
    sessions may still read the files they have listed; older ones are deleted.
    """
    spark = rows.sparkSession
    database, name = table.split(".")
    root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    place = f"{root}/{name}-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(place)
        if test:
            test(spark.read.schema(rows.schema).parquet(place))
    except BaseException:
        delete_folder(spark, place)
        raise
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{place}'")
        return
    before = place_of_table(spark, table)
    if spark.table(table).dtypes == rows.dtypes:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{place}'")
    kept = {place.rsplit("/", 1)[1], before.rsplit("/", 1)[1]}
    for folder in folders_like(spark, f"{root}/{name}-*"):
        if folder.rsplit("/", 1)[1] not in kept:
            delete_folder(spark, folder)

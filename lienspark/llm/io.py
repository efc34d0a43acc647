"""Writing a step's rows to the shared folder, and reading them again."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lienspark.settings import fresh_path


def written(frame: DataFrame, name: str) -> DataFrame:
    """The rows after a round trip through Parquet in the shared folder.

    Cuts the lineage: a lost executor costs no more than a read.
    """
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def batches_of(rows: pa.Table | list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    table = rows if isinstance(rows, pa.Table) else pa.Table.from_pylist(rows, schema)
    yield from table.to_batches()


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: one aggregated number."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first().n
    return total or 0

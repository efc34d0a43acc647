"""Session settings needed around single actions, and the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The JVM runs a method above this many bytes of code interpreted. A wide row can
# make Spark generate one; with this as its limit Spark generates smaller parts.
COMPILED_METHOD_BYTES = "8000"
WIDE_ROW_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": COMPILED_METHOD_BYTES}

# A task of a partitioned write keeps a file open for each of its partitions, so its
# rows need no sort, which would hold all of them in memory. Only rows of partitions
# beyond this number are sorted.
OPEN_FILES = "100"
OPEN_FILES_SETTINGS = {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES}

_local_folders: dict[str, str] = {}


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set SQL options and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    A local session without that setting gets a fresh folder below ``/tmp``; a
    cluster session without it is refused, because a machine-local folder would
    lose data with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_folders[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder nothing has been written to."""
    return f"{shared_folder(spark)}/lienspark/{uuid.uuid4().hex}/{name}"

"""Folders that are replaced whole, by Hadoop's file system calls."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def make_folder(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.mkdirs(place(path))


def create_file(spark: SparkSession, path: str) -> None:
    """An empty file that was not there before."""
    files, place = _file_system(spark, path)
    files.create(place(path), False).close()


def folders_like(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern of the file system."""
    files, place = _file_system(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(place(pattern)) or []]


def delete_folder(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place(path), True)


def replace_folder(spark: SparkSession, target: str, write: Callable[[str], None]) -> None:
    """Have ``write`` fill a new folder beside ``target``, then put it in its place.

    While it writes, and if it fails, ``target`` is as it was. The exchange is two
    renames; the old folder is deleted last, and put back if the second one fails.
    On an object store a rename copies, file by file.
    """
    files, place = _file_system(spark, target)
    mark = uuid.uuid4().hex
    new, old = f"{target}.new-{mark}", f"{target}.old-{mark}"
    try:
        write(new)
    except BaseException:
        files.delete(place(new), True)
        raise
    had = files.exists(place(target))
    if had and not files.rename(place(target), place(old)):
        raise OSError(f"cannot move {target}")
    files.mkdirs(place(target).getParent())
    if not files.rename(place(new), place(target)):
        if had:
            files.rename(place(old), place(target))
        raise OSError(f"cannot move {new} to {target}")
    if had:
        files.delete(place(old), True)

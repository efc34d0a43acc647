"""Tables of years, of which one year or all are replaced in one step.

The rows lie in a table ``<name>_rows``, partitioned by the generation they were
loaded with, then by year and further columns. ``<name>`` is a view of the
generations in force. A load writes a new generation beside the others and then

1. marks it as committed by an empty file below ``<location>/_generations``, and
2. has the view name it, by one change in the catalog.

Readers go by the view, so they see the old rows of a year or the new ones, with
the states that vanished and those that came, and a reader that has listed the old
files can still read them: a generation is deleted by the second load after the one
that took its place. A load that fails before the mark leaves nothing behind; if it
stops between mark and view, the old year shows until ``show_current`` or the next
load. The marks alone tell what is in force, so a new catalog finds it too. Loads
into one table are meant to come one after the other.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import suppress
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from lienspark.settings import OPEN_FILES_SETTINGS, session_conf
from lienspark.sinks.folders import create_file, delete_folder, folders_like, make_folder

GENERATION, YEAR, ALL = "generation", "data_year", "all"
MARKS = "_generations"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_LOCATION = "lienspark.location"
_NAME = re.compile(r"(\d{8})-(\d+|all)-[0-9a-f]{32}")


def _scope(generation: str) -> int | str:
    """The year a generation replaces, or ``all``."""
    scope = _NAME.fullmatch(generation)[2]
    return scope if scope == ALL else int(scope)


def rows_table(table: str) -> str:
    return f"{table}_rows"


def place_of(spark: SparkSession, table: str) -> str:
    """The folder that holds all generations."""
    return spark.sql(f"SHOW TBLPROPERTIES {table}('{_LOCATION}')").first()["value"]


def committed(spark: SparkSession, location: str) -> list[str]:
    """Marked generations, oldest first."""
    names = (path.rsplit("/", 1)[1] for path in folders_like(spark, f"{location}/{MARKS}/*"))
    return sorted(name for name in names if _NAME.fullmatch(name))


def _written(spark: SparkSession, location: str) -> set[str]:
    """Generations with a folder, marked or left by a load that was cut off."""
    return {path.rsplit("=", 1)[1] for path in folders_like(spark, f"{location}/{GENERATION}=*")}


def in_force(generations: Sequence[str]) -> list[str]:
    """Of committed generations, those no later one has replaced whole."""
    kept: list[str] = []
    for generation in generations:
        scope = _scope(generation)
        kept = [] if scope == ALL else [old for old in kept if _scope(old) != scope]
        kept.append(generation)
    return kept


def _condition(generations: Sequence[str]) -> str:
    """Which partitions are in force, as a condition on the partition columns alone."""
    generations = in_force(generations)
    later = [str(_scope(g)) for g in generations if _scope(g) != ALL]
    parts = []
    for generation in generations:
        part = f"{GENERATION} = '{generation}'"
        if _scope(generation) == ALL and later:
            part = f"({part} AND {YEAR} NOT IN ({', '.join(later)}))"
        parts.append(part)
    return " OR ".join(parts) or "false"


def _columns(spark: SparkSession, table: str) -> list[str]:
    return [name for name in spark.table(rows_table(table)).columns if name != GENERATION]


def _view_text(spark: SparkSession, table: str, generations: Sequence[str]) -> str:
    columns = ", ".join(f"`{name}`" for name in _columns(spark, table))
    return f"SELECT {columns} FROM {rows_table(table)} WHERE {_condition(generations)}"


def show_current(spark: SparkSession, table: str) -> None:
    """Have the view name the generations that are in force."""
    generations = committed(spark, place_of(spark, table))
    spark.sql(f"ALTER VIEW {table} AS {_view_text(spark, table, generations)}")


def current_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of the generations in force, with the files' metadata columns."""
    condition = _condition(committed(spark, place_of(spark, table)))
    return spark.table(rows_table(table)).where(condition).drop(GENERATION)


def _default_place(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    root = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{root.rstrip('/')}/{name}_rows"


def create(
    spark: SparkSession,
    table: str,
    types: Mapping[str, str],
    inner_keys: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    location: str | None = None,
) -> None:
    """Create the table if it is not there; committed years at ``location`` show.

    ``types`` has the year's column; ``inner_keys`` are partitions below the year.
    """
    if spark.catalog.tableExists(table):
        return
    location = (location or _default_place(spark, table)).rstrip("/")
    make_folder(spark, f"{location}/{MARKS}")
    keys = (GENERATION, YEAR, *inner_keys)
    columns = ", ".join(f"`{name}` {kind}" for name, kind in {**types, GENERATION: "string"}.items())
    settings = ", ".join(f"'{name}' '{value}'" for name, value in (options or {}).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {rows_table(table)} ({columns}) USING parquet "
        f"{f'OPTIONS ({settings})' if settings else ''} "
        f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{location}'"
    )
    generations = committed(spark, location)
    if generations:
        spark.sql(f"ALTER TABLE {rows_table(table)} RECOVER PARTITIONS")
    spark.sql(
        f"CREATE VIEW {table} TBLPROPERTIES ('{_LOCATION}' = '{location}') "
        f"AS {_view_text(spark, table, generations)}"
    )


def replace(
    rows: DataFrame,
    table: str,
    year: int | None = None,
    settings: Mapping[str, str] | None = None,
    test: Callable[[DataFrame], None] | None = None,
) -> None:
    """Make ``rows`` the only rows of ``year``, or without a year of the whole table.

    With a year the rows need no year's column. Each task writes its rows as they
    come. ``test`` gets the written rows before they are committed.
    """
    spark = rows.sparkSession
    location = place_of(spark, table)
    before = committed(spark, location)
    for left in _written(spark, location) - {*before}:
        _drop(spark, table, location, left)
    number = 1 + max((int(name.split("-")[0]) for name in before), default=0)
    scope = ALL if year is None else int(year)
    generation = f"{number:08d}-{scope}-{uuid.uuid4().hex}"
    names = [name for name in _columns(spark, table) if year is None or name != YEAR]
    partitions = [c.name for c in spark.catalog.listColumns(rows_table(table)) if c.isPartition]
    own = [f"{GENERATION} = '{generation}'", YEAR if year is None else f"{YEAR} = {scope}"]
    keys = [*own, *(name for name in partitions if name not in (GENERATION, YEAR))]
    chosen = ", ".join(f"`{name}`" for name in names)
    try:
        with session_conf(spark, OPEN_FILES_SETTINGS | (settings or {})):
            spark.sql(
                f"INSERT INTO {rows_table(table)} PARTITION ({', '.join(keys)}) "
                f"SELECT {chosen} FROM {{rows}}",
                rows=rows,
            )
        if test:
            test(spark.table(rows_table(table)).where(f"{GENERATION} = '{generation}'").drop(GENERATION))
    except BaseException:
        _drop(spark, table, location, generation)
        raise
    create_file(spark, f"{location}/{MARKS}/{generation}")
    show_current(spark, table)
    now = committed(spark, location)
    kept = {*in_force(before), *in_force(now)}
    for old in now:
        if old not in kept:
            _drop(spark, table, location, old)


def _partitions(spark: SparkSession, table: str, generation: str) -> list[str]:
    """Conditions that name the partitions of a generation, for the catalog."""
    specs = []
    for row in spark.sql(f"SHOW PARTITIONS {rows_table(table)}").collect():
        values = [part.split("=", 1) for part in row.partition.split("/")]
        if unquote(values[0][1]) == generation:
            quoted = (
                f"{key} = NULL"
                if value == NULL_PARTITION
                else f"{key} = '" + re.sub(r"(['\\])", r"\\\1", unquote(value)) + "'"
                for key, value in values
            )
            specs.append(f"PARTITION ({', '.join(quoted)})")
    return specs


def _drop(spark: SparkSession, table: str, location: str, generation: str) -> None:
    """Take a generation out of the catalog, then its files, then its mark."""
    specs = _partitions(spark, table, generation)
    if specs:
        spark.sql(f"ALTER TABLE {rows_table(table)} DROP IF EXISTS {', '.join(specs)}")
    delete_folder(spark, f"{location}/{GENERATION}={generation}")
    with suppress(FileNotFoundError):
        delete_folder(spark, f"{location}/{MARKS}/{generation}")

"""Lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup is broadcast only up to this many rows; a longer one is joined like
# any other table.
BROADCAST_ROWS = 10_000

CODE_SCHEMA = "id int, description string"
STATE_SCHEMA = "state_code string, state_name string"
SEED_SCHEMAS = {
    "loan_type": CODE_SCHEMA,
    "loan_purpose": CODE_SCHEMA,
    "occupancy_type": CODE_SCHEMA,
    "lien_status": CODE_SCHEMA,
    "state_mapping": STATE_SCHEMA,
}

# The public register's code descriptions and the postal codes of
# states and territories.
SEED_ROWS = {
    "loan_type": [
        (1, "Conventional"),
        (2, "FHA-insured"),
        (3, "VA-guaranteed"),
        (4, "USDA-RHS or FSA-guaranteed"),
    ],
    "loan_purpose": [
        (1, "Home purchase"),
        (2, "Home improvement"),
        (31, "Refinancing"),
        (32, "Cash-out refinancing"),
        (4, "Other purpose"),
        (5, "Not applicable"),
    ],
    "occupancy_type": [
        (1, "Principal residence"),
        (2, "Second residence"),
        (3, "Investment property"),
    ],
    "lien_status": [
        (1, "Secured by a first lien"),
        (2, "Secured by a subordinate lien"),
    ],
    "state_mapping": [
        ("AL", "Alabama"),
        ("AK", "Alaska"),
        ("AZ", "Arizona"),
        ("AR", "Arkansas"),
        ("CA", "California"),
        ("CO", "Colorado"),
        ("CT", "Connecticut"),
        ("DE", "Delaware"),
        ("DC", "District of Columbia"),
        ("FL", "Florida"),
        ("GA", "Georgia"),
        ("HI", "Hawaii"),
        ("ID", "Idaho"),
        ("IL", "Illinois"),
        ("IN", "Indiana"),
        ("IA", "Iowa"),
        ("KS", "Kansas"),
        ("KY", "Kentucky"),
        ("LA", "Louisiana"),
        ("ME", "Maine"),
        ("MD", "Maryland"),
        ("MA", "Massachusetts"),
        ("MI", "Michigan"),
        ("MN", "Minnesota"),
        ("MS", "Mississippi"),
        ("MO", "Missouri"),
        ("MT", "Montana"),
        ("NE", "Nebraska"),
        ("NV", "Nevada"),
        ("NH", "New Hampshire"),
        ("NJ", "New Jersey"),
        ("NM", "New Mexico"),
        ("NY", "New York"),
        ("NC", "North Carolina"),
        ("ND", "North Dakota"),
        ("OH", "Ohio"),
        ("OK", "Oklahoma"),
        ("OR", "Oregon"),
        ("PA", "Pennsylvania"),
        ("RI", "Rhode Island"),
        ("SC", "South Carolina"),
        ("SD", "South Dakota"),
        ("TN", "Tennessee"),
        ("TX", "Texas"),
        ("UT", "Utah"),
        ("VT", "Vermont"),
        ("VA", "Virginia"),
        ("WA", "Washington"),
        ("WV", "West Virginia"),
        ("WI", "Wisconsin"),
        ("WY", "Wyoming"),
        ("AS", "American Samoa"),
        ("GU", "Guam"),
        ("MP", "Northern Mariana Islands"),
        ("PR", "Puerto Rico"),
        ("VI", "Virgin Islands"),
    ],
}


def builtin_seeds(spark: SparkSession) -> dict[str, DataFrame]:
    """The five lookups by name, marked for broadcast: 56 rows at the most."""
    return {
        name: F.broadcast(_local(spark, name, rows)) for name, rows in SEED_ROWS.items()
    }


def read_seeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five lookups from ``<folder>/<name>.csv``.

    Each file is checked before use: a key that occurs twice would multiply
    loans and is refused, and only a table within ``BROADCAST_ROWS`` is marked
    for broadcast.
    """
    seeds = {}
    for name, schema in SEED_SCHEMAS.items():
        seed = (
            spark.read.option("header", True)
            .option("enforceSchema", False)
            .schema(schema)
            .csv(f"{folder}/{name}.csv")
        )
        key = seed.columns[0]
        size = seed.agg(
            F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys")
        ).first()
        if size.n_rows != size.n_keys:
            raise ValueError(f"lookup {name}: {key} repeats or is missing")
        seeds[name] = F.broadcast(seed) if size.n_rows <= BROADCAST_ROWS else seed
    return seeds


def _local(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    """Rows as literals in the plan, so that no Python worker is started."""
    first, second = (field.split() for field in SEED_SCHEMAS[name].split(", "))
    quoted = ", ".join(
        f"({key!r}, '{text}')" if isinstance(key, int) else f"('{key}', '{text}')"
        for key, text in rows
    )
    return spark.sql(
        f"SELECT CAST({first[0]} AS {first[1]}) AS {first[0]}, {second[0]} "
        f"FROM VALUES {quoted} AS seed({first[0]}, {second[0]})"
    )

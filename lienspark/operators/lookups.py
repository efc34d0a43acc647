"""Descriptions for the coded columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# lookup name -> (column of the loan, name of the description in the result)
LOOKUPS = {
    "loan_type": ("loan_type", "loan_type_name"),
    "loan_purpose": ("loan_purpose", "loan_purpose_name"),
    "occupancy_type": ("occupancy_type", "occupancy_type_name"),
    "lien_status": ("lien_status", "lien_status_name"),
    "state_mapping": ("state_code", "state_name"),
}


def describe(
    loans: DataFrame, seeds: dict[str, DataFrame], names: Iterable[str] = tuple(LOOKUPS)
) -> DataFrame:
    """Left-join the named lookups; a code without an entry gets a NULL name.

    The seeds carry their own broadcast mark, so the loans are not shuffled.
    """
    keys = []
    for name in names:
        code, description = LOOKUPS[name]
        keys.append(f"{name}__key")
        renamed = seeds[name].toDF(keys[-1], description)
        loans = loans.join(renamed, F.expr(f"{code} = {keys[-1]}"), "left")
    return loans.drop(*keys)

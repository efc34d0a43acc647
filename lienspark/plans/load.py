"""One year of staging into the warehouse table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lienspark.operators.layout import gather_by
from lienspark.operators.quality import DataTestFailure, not_null_failures, require_none
from lienspark.operators.shaping import (
    available,
    stamp_year,
    upper_names,
    zero_codes,
    zero_income,
)
from lienspark.operators.surrogate import add_surrogate_id, year_start
from lienspark.sinks.warehouse import create_loan_table, replace_year


def shape_for_load(
    staging: DataFrame, year: int, income_to_zero: bool = True, upper: bool = False
) -> DataFrame:
    """Stamped, cut to the load columns and filled, as one backend or the other.

    ``income_to_zero`` and lower-case names are the local database's way; without
    both it is the cloud database's.
    """
    loans = zero_codes(available(stamp_year(staging, year)))
    if income_to_zero:
        loans = zero_income(loans)
    return upper_names(loans) if upper else loans


def load_year(
    staging: DataFrame,
    table: str,
    year: int,
    income_to_zero: bool = True,
    gather: bool = False,
    location: str | None = None,
    batch_rows: int | None = None,
    require_state: bool | None = None,
) -> DataFrame:
    """Replace ``year`` in the warehouse table with the rows of ``staging``.

    Returns one row: ``rows_removed`` and ``rows_loaded``. The local database does
    not take a loan without a state, so unless ``require_state`` is False its way
    of loading stops at one before the table is touched.

    ``staging`` should be read from a written folder, so that a load that fails
    can be run again. Such a folder is partitioned by state and needs no shuffle;
    ``gather=True`` is for rows in any other order. Ids are numbered by the places
    of the rows in the folder's files, so a load of the same folder gives the same.
    """
    if require_state is None:
        require_state = income_to_zero
    if require_state:
        if "state_code" not in staging.columns:
            raise DataTestFailure("state not null: the staging has no state_code")
        require_none(not_null_failures(staging, ["state_code"]), "state not null")
    create_loan_table(staging.sparkSession, table, location)
    loans = shape_for_load(staging, year, income_to_zero)
    loans = add_surrogate_id(loans, year_start(year)).withColumn(
        "loaded_at", F.current_timestamp()
    )
    if gather:
        loans = gather_by(loans, "state_code")
    return replace_year(loans, table, year, batch_rows)

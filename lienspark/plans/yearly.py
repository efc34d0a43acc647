"""One year from register text to marts."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from lienspark.operators.sampling import SAMPLE_ROWS
from lienspark.plans.enrich import enrich_year
from lienspark.plans.ingest import ingest_loans
from lienspark.plans.load import load_year
from lienspark.plans.marts import build_marts
from lienspark.sources.lake import input_present, read_staging

logger = logging.getLogger(__name__)


def run_year(
    spark: SparkSession,
    year: int,
    register: str,
    rates: str,
    lake: str,
    table: str,
    location: str | None = None,
    seeds: dict[str, DataFrame] | None = None,
    base: str = "loans",
    n_sample: int = SAMPLE_ROWS,
    seed: int | None = None,
    marts_root: str | None = None,
    income_to_zero: bool = True,
    batch_rows: int | None = None,
    style: str = "prefixed",
    dti_scale: float = 1,
    reproducible: bool = False,
    only_year: bool = False,
) -> dict[str, str] | None:
    """Ingest, enrich, load and build the marts; a step that fails ends the run.

    ``income_to_zero`` and ``batch_rows`` are those of the load, the others those
    of the marts, which with ``only_year`` read no other year's loans. Returns the models' names, or None where a step finds no input.
    Every step reads what the one before it has written, so a run can be repeated.
    """
    raw, staging = f"{lake}/raw", f"{lake}/staging"
    ingest_loans(spark, register, raw, year)
    if not input_present(spark, f"{raw}/{year}"):
        logger.warning("no originated loans for %s, stopping before enrichment", year)
        return None
    enrich_year(spark, raw, rates, staging, year)
    if not input_present(spark, f"{staging}/{year}"):
        logger.warning("no staged loans for %s, stopping before the load", year)
        return None
    report = load_year(
        read_staging(spark, f"{staging}/{year}"),
        table,
        year,
        income_to_zero=income_to_zero,
        location=location,
        batch_rows=batch_rows,
    ).first()
    logger.info(
        "%s: %d rows removed, %d loaded", year, report.rows_removed, report.rows_loaded
    )
    return build_marts(
        spark,
        table,
        seeds,
        base,
        style=style,
        year=year if only_year else None,
        n_sample=n_sample,
        seed=seed,
        dti_scale=dti_scale,
        root=marts_root,
        reproducible=reproducible,
    )

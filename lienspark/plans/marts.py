"""Staging view, fact, summary and sample, with the tests between them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.functions import cost_category, risk_segment
from lienspark.functions.segments import HIGH_DTI, HIGH_LTV, MEDIUM_LTV
from lienspark.operators.layout import GATHER_SETTINGS, gather_by
from lienspark.operators.lookups import LOOKUPS, describe
from lienspark.operators.quality import (
    accepted_values_failures,
    not_null_failures,
    require_none,
    unique_failures,
    unique_failures_in_files,
)
from lienspark.operators.sampling import (
    SAMPLE_ROWS,
    merged_rows,
    random_rows,
    random_rows_by,
    sample_quality,
)
from lienspark.operators.shaping import select_sample_columns, staging_view
from lienspark.operators.summary import merged_summary, summary_by_code
from lienspark.operators.surrogate import year_start
from lienspark.schemas import (
    COST_CATEGORIES,
    FACT_COLUMNS,
    RISK_SEGMENTS,
    STAGING_COLUMNS,
    layer_name,
)
from lienspark.settings import WIDE_ROW_SETTINGS
from lienspark.sinks import generations
from lienspark.sinks.tables import publish_table
from lienspark.sources.seeds import builtin_seeds

# All that the summary and the sample show of the lookups.
SUMMARY_LOOKUPS = ("loan_purpose", "state_mapping")

SEGMENT_VALUES = {"risk_segment": RISK_SEGMENTS}
FACT_VALUES = {"risk_segment": RISK_SEGMENTS, "cost_category": COST_CATEGORIES}
SOURCE_KEYS = ["data_year", "state_code"]


def segmented(staging: DataFrame, dti_scale: float = 1) -> DataFrame:
    """Staging with segment and cost category, before any lookup."""
    return staging.withColumns(
        {
            "risk_segment": risk_segment(
                F.col("loan_to_value_ratio"), F.col("debt_to_income_numeric"), dti_scale
            ),
            "cost_category": cost_category(F.col("interest_rate_spread")),
        }
    )


def loan_fact(
    staging: DataFrame,
    seeds: dict[str, DataFrame],
    dti_scale: float = 1,
    lookups: Sequence[str] = tuple(LOOKUPS),
) -> DataFrame:
    """The fact: staging with descriptions, segment and cost category.

    A left join with a unique key neither adds nor removes rows, so a reader that
    needs only some of the descriptions can name their ``lookups``.
    """
    left_out = {text for name, (_, text) in LOOKUPS.items() if name not in lookups}
    return segmented(describe(staging, seeds, lookups), dti_scale).select(
        *(name for name in FACT_COLUMNS if name not in left_out),
        F.current_timestamp().alias("mart_updated_at"),
    )


def staging_sql(table: str, year: int | None = None) -> str:
    """The staging view as text, over a catalog table."""
    where = "" if year is None else f" WHERE data_year = {int(year)}"
    columns = ", ".join(STAGING_COLUMNS)
    return f"SELECT {columns}, current_timestamp() AS dbt_updated_at FROM {table}{where}"


def fact_sql(staging: str, lookups: dict[str, str], dti_scale: float = 1) -> str:
    """The fact as text, over the staging view and the lookup tables by name."""
    ltv, dti = "s.loan_to_value_ratio", "s.debt_to_income_numeric"
    if dti_scale != 1:
        dti = f"{dti} * {dti_scale}D"
    made = {
        "risk_segment": (
            f"CASE WHEN {ltv} > {HIGH_LTV}D OR {dti} > {HIGH_DTI} THEN 'High' "
            f"WHEN {ltv} BETWEEN {MEDIUM_LTV}D AND {HIGH_LTV}D AND {dti} <= {HIGH_DTI} "
            "THEN 'Medium' ELSE 'Low' END"
        ),
        "cost_category": (
            "CASE WHEN s.interest_rate_spread > 0 THEN 'High Cost' "
            "ELSE 'Market/Subsidized' END"
        ),
    }
    joins = ""
    for name, (code, text) in LOOKUPS.items():
        made[text] = f"{name}.{text}"
        joins += (
            f" LEFT JOIN (SELECT * FROM {lookups[name]}) AS {name}(code, {text}) "
            f"ON s.{code} = {name}.code"
        )
    columns = ", ".join(
        f"{made[column]} AS {column}" if column in made else f"s.{column}"
        for column in FACT_COLUMNS
    )
    return f"SELECT {columns}, current_timestamp() AS mart_updated_at FROM {staging} s{joins}"


def summarise(loans: DataFrame, seeds: dict[str, DataFrame]) -> DataFrame:
    """The risk summary of segmented loans.

    Loans are grouped by code first, so the lookups meet a few groups and not
    every loan.
    """
    return merged_summary(describe(summary_by_code(loans), seeds, SUMMARY_LOOKUPS))


def sample_of(
    loans: DataFrame,
    seeds: dict[str, DataFrame],
    n: int = SAMPLE_ROWS,
    seed: int | None = None,
    reproducible: bool = False,
) -> DataFrame:
    """The loan sample of segmented loans, described after it is drawn."""
    chosen = random_rows(sample_quality(loans), n, seed=seed, reproducible=reproducible)
    return select_sample_columns(describe(chosen, seeds, SUMMARY_LOOKUPS))


def loan_sample(
    fact: DataFrame,
    n: int = SAMPLE_ROWS,
    seed: int | None = None,
    reproducible: bool = False,
) -> DataFrame:
    """Up to ``n`` random loans fit for plotting."""
    chosen = random_rows(sample_quality(fact), n, seed=seed, reproducible=reproducible)
    return select_sample_columns(chosen)


def _require_unique_keys(seeds: dict[str, DataFrame]) -> None:
    """All lookups' keys in one job; the message names the first that repeats."""
    keys = [
        rows.select(F.lit(name).alias("lookup"), F.col(rows.columns[0]).cast("string").alias("key"))
        for name, rows in seeds.items()
    ]
    together = reduce(DataFrame.unionAll, keys).where(F.col("key").isNotNull())
    repeated = together.groupBy("lookup", "key").agg(F.count("*").alias("n_rows"))
    failing = {row.lookup for row in repeated.where(F.col("n_rows") > 1).collect()}
    for name, rows in seeds.items():
        if name in failing:
            require_none(unique_failures(rows, rows.columns[0]), f"unique {name}")


def _require_sound(source: DataFrame, loans: DataFrame, year: int | None) -> bool:
    """Null and value tests of source and fact, counted in one pass.

    Only a failing test reads the loans again, to say what fails. Returns whether
    all ids are of the range of ``year``, so that no other year can have them.
    """
    tests: list[tuple[str, F.Column, Callable[[], DataFrame]]] = [
        (
            "source not null",
            F.greatest(*(F.count_if(F.col(name).isNull()) for name in SOURCE_KEYS)),
            lambda: not_null_failures(source, SOURCE_KEYS),
        ),
        (
            "fact not null",
            F.count_if(F.col("id").isNull()),
            lambda: not_null_failures(loans, ["id"]),
        ),
        (
            "fact accepted values",
            F.greatest(
                *(F.count_if(~F.col(name).isin(values)) for name, values in FACT_VALUES.items())
            ),
            lambda: accepted_values_failures(loans, FACT_VALUES),
        ),
    ]
    start, end = (year_start(year), year_start(year + 1)) if year is not None else (0, 0)
    inside = F.count_if(~F.col("id").between(start + 1, end)) == 0
    *counts, own_ids = loans.agg(*(count for _, count, _ in tests), inside).first()
    for (test, _, failures), count in zip(tests, counts, strict=True):
        if count:
            require_none(failures(), test)
    return own_ids


def _repeated_ids(spark: SparkSession, table: str, year: int | None) -> DataFrame:
    """Ids that occur more than once, in a year or in the whole table."""
    loaded = spark.catalog.tableExists(generations.rows_table(table))
    rows = generations.current_rows(spark, table) if loaded else spark.table(table)
    if year is not None:
        rows = rows.where(F.col("data_year") == year)
    return unique_failures_in_files(rows, "id") if loaded else unique_failures(rows, "id")


# What summary and sample are made of, by year; a year's rows are replaced alone.
SUMMARY_PARTS = {
    "state_code": "string",
    "loan_purpose": "int",
    "risk_segment": "string",
    "loan_count": "bigint",
    "total_loan_amount": "double",
    "sum_interest_rate": "double",
    "sum_spread": "double",
    "n_spreads": "bigint",
    "data_year": "int",
}
SAMPLE_PARTS = {
    "id": "bigint",
    "draw": "string",
    "state_code": "string",
    "income": "bigint",
    "interest_rate_spread": "double",
    "risk_segment": "string",
    "loan_amount": "double",
    "loan_purpose": "int",
    "data_year": "int",
}


def _refresh(
    rows: DataFrame,
    table: str,
    types: dict[str, str],
    year: int | None,
    test: Callable[[DataFrame], None],
) -> DataFrame:
    """Replace a year of stored parts, or all, once tested; returns those of every year.

    They are gathered by their first column, so a few make one file, and a sample as
    large as the table as many tasks as it needs.
    """
    spark = rows.sparkSession
    generations.create(spark, table, types)
    typed = rows.select(*(F.col(name).cast(kind) for name, kind in types.items()))
    gathered = gather_by(typed, next(iter(types)))
    generations.replace(gathered, table, year, GATHER_SETTINGS | WIDE_ROW_SETTINGS, test)
    return spark.table(table)


def build_marts(
    spark: SparkSession,
    table: str,
    seeds: dict[str, DataFrame] | None = None,
    base: str = "loans",
    style: str = "prefixed",
    year: int | None = None,
    n_sample: int = SAMPLE_ROWS,
    seed: int | None = None,
    dti_scale: float = 1,
    root: str | None = None,
    reproducible: bool = False,
) -> dict[str, str]:
    """Build every model over the warehouse table, in order of dependence.

    Each step is tested before anything that reads it is built; a failing test
    raises. Lookups, summary and sample become tables in the layers' databases;
    staging and fact are views of the catalog over tables, so other sessions can
    ask them. What summary and sample are made of is written anew and tested before
    it takes the place of the old. ``root`` places the databases in a folder of their
    own instead of the session's warehouse. Returns the name of each model.

    With a ``year`` only its loans are read and tested; the other years stay as
    their last build left them. For that, sums and counts by code, and the first
    ``n_sample`` loans of the sample's order, are stored by year, and summary and
    sample are merged from those of all years. The tables are named in the result.
    """
    seeds = seeds or builtin_seeds(spark)
    stg, lookup, prod = (layer_name(base, layer, style) for layer in ("stg", "lookup", "prod"))
    for database in (stg, lookup, prod):
        place = f"LOCATION '{root}/{database}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} {place}")
    names = {
        "stg_loans": f"{stg}.stg_loans",
        "fct_loan_risk": f"{prod}.fct_loan_risk",
        "prd_risk_summary": f"{prod}.prd_risk_summary",
        "prd_loan_sample": f"{prod}.prd_loan_sample",
        "summary_parts": f"{prod}.risk_summary_by_code",
        "sample_parts": f"{prod}.loan_sample_by_year",
    }

    _require_unique_keys(seeds)
    names |= {name: f"{lookup}.{name}" for name in seeds}
    with ThreadPoolExecutor(len(seeds)) as together:
        list(together.map(lambda name: publish_table(seeds[name], names[name]), seeds))

    source = spark.table(table)
    if year is not None:
        source = source.where(F.col("data_year") == year)
    loans = segmented(staging_view(source), dti_scale)
    own_ids = _require_sound(source, loans, year)
    require_none(_repeated_ids(spark, table, year if own_ids else None), "fact unique id")
    spark.sql(f"CREATE OR REPLACE VIEW {names['stg_loans']} AS {staging_sql(table)}")
    fact = fact_sql(names["stg_loans"], {name: names[name] for name in seeds}, dti_scale)
    spark.sql(f"CREATE OR REPLACE VIEW {names['fct_loan_risk']} AS {fact}")

    def summary_tests(summary: DataFrame) -> None:
        require_none(not_null_failures(summary, ["data_year"]), "summary not null")
        require_none(accepted_values_failures(summary, SEGMENT_VALUES), "summary accepted values")

    def sample_tests(sample: DataFrame) -> None:
        known = ["income", "interest_rate_spread"]
        require_none(not_null_failures(sample, known), "sample not null")

    by_code = _refresh(summary_by_code(loans), names["summary_parts"], SUMMARY_PARTS, year, summary_tests)
    summary = merged_summary(describe(by_code, seeds, SUMMARY_LOOKUPS))
    publish_table(summary, names["prd_risk_summary"])
    drawn = random_rows_by(sample_quality(loans), "data_year", n_sample, "id", seed, reproducible)
    by_year = _refresh(drawn, names["sample_parts"], SAMPLE_PARTS, year, sample_tests)
    sample = describe(merged_rows(by_year, n_sample), seeds, SUMMARY_LOOKUPS)
    publish_table(select_sample_columns(sample), names["prd_loan_sample"])
    return names

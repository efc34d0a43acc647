"""Queries for single steps: casts, filters, functions, joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lienspark.functions import (
    cost_category,
    debt_to_income,
    loan_to_value,
    risk_segment,
    share,
)
from lienspark.operators.benchmark import (
    join_benchmark,
    join_benchmark_rounded,
    yearly_benchmark,
    yearly_benchmark_rounded,
)
from lienspark.operators.lookups import LOOKUPS, describe
from lienspark.operators.sampling import sample_quality
from lienspark.operators.shaping import (
    available,
    cast_loans,
    cast_money,
    originated_number,
    originated_text,
    select_explore_columns,
    select_loan_columns,
    select_sample_columns,
    staging_view,
    stamp_year,
    upper_names,
    zero_codes,
    zero_income,
)
from lienspark.operators.summary import heatmap, risk_summary
from lienspark.plans.dashboard import selected
from lienspark.plans.enrich import add_ratios
from lienspark.plans.explore import (
    high_rate_high_dti,
    matched_spread,
    unmatched,
)
from lienspark.plans.marts import loan_sample
from lienspark.schemas import (
    EXPLORE_COLUMNS,
    LOAD_COLUMNS,
    REGISTER_COLUMNS,
    REGISTER_TYPES,
    SAMPLE_COLUMNS,
    STAGING_COLUMNS,
)
from lienspark.sources.rates import normalise_rates
from lienspark.sources.seeds import builtin_seeds
from lienspark_checks import fixtures
from lienspark_checks.oracle import COST, after, segment
from lienspark_checks.registry import registered

STATES = ["California", "Texas", "Florida", "New York", "Colorado"]
STATE_LIST = ", ".join(f"'{name}'" for name in STATES)
YEAR = 1997


def with_date(rates: DataFrame) -> DataFrame:
    """The month as a date, which reads the same in every time zone."""
    return rates.withColumn("observation_date", F.col("observation_date").cast("date"))


def explore_input(spark, sf_dir) -> DataFrame:
    """The exploration set with the code already a number, as inference gives it."""
    wide = select_explore_columns(fixtures.register(spark, sf_dir), keep=["k"])
    numbers = {name: F.col(name).try_cast("int") for name in ("activity_year", "action_taken")}
    return originated_number(cast_money(wide.withColumns(numbers)))


EXPLORE_SQL = (
    "SELECT k, "
    + ", ".join(
        f"CAST({name} AS INTEGER) AS {name}"
        if name in ("activity_year", "action_taken")
        else f"TRY_CAST({name} AS DOUBLE) AS {name}"
        if name in ("loan_amount", "interest_rate", "property_value", "income")
        else name
        for name in EXPLORE_COLUMNS
    )
    + " FROM register WHERE CAST(action_taken AS INTEGER) = 1"
)
EXPLORE_JOINED_SQL = (
    f"SELECT e.*, avg_fed_rate FROM ({EXPLORE_SQL}) e "
    "LEFT JOIN yearly2 ON e.activity_year = yearly2.activity_year"
)


def explore_joined(spark, sf_dir) -> DataFrame:
    return join_benchmark_rounded(explore_input(spark, sf_dir), fixtures.rates(spark, sf_dir))


# Sources that need no file of their own


@registered(
    "src7_normalise_rates",
    after("SELECT CAST(observation_date AS DATE) AS observation_date, fed_rate FROM rates"),
)
def src7(spark, sf_dir):
    series = fixtures.rates(spark, sf_dir).toDF("index", "value")
    return with_date(normalise_rates(series))


# Columns and casts


@registered(
    "prj1_select_loan_columns",
    after(f"SELECT k, {', '.join(REGISTER_COLUMNS)} FROM register"),
)
def prj1(spark, sf_dir):
    return select_loan_columns(fixtures.register(spark, sf_dir), keep=["k"])


@registered(
    "prj2_select_explore_columns",
    after(f"SELECT k, {', '.join(EXPLORE_COLUMNS)} FROM register"),
)
def prj2(spark, sf_dir):
    return select_explore_columns(fixtures.register(spark, sf_dir), keep=["k"])


@registered(
    "prj3_cast_loans",
    after(
        "SELECT k, "
        + ", ".join(
            name
            if kind == "string"
            else f"TRY_CAST({name} AS DOUBLE) AS {name}"
            if kind == "double"
            else f"TRY_CAST(trunc(TRY_CAST({name} AS DOUBLE)) AS "
            f"{'INTEGER' if kind == 'int' else 'SMALLINT'}) AS {name}"
            for name, kind in REGISTER_TYPES.items()
        )
        + " FROM register"
    ),
)
def prj3(spark, sf_dir):
    return cast_loans(select_loan_columns(fixtures.register(spark, sf_dir), keep=["k"]))


@registered(
    "prj4_cast_money",
    after(
        "SELECT k, TRY_CAST(loan_amount AS DOUBLE) AS loan_amount, "
        "TRY_CAST(interest_rate AS DOUBLE) AS interest_rate, "
        "TRY_CAST(property_value AS DOUBLE) AS property_value, "
        "TRY_CAST(income AS DOUBLE) AS income FROM register"
    ),
)
def prj4(spark, sf_dir):
    return cast_money(fixtures.register(spark, sf_dir)).select(
        "k", "loan_amount", "interest_rate", "property_value", "income"
    )


@registered(
    "prj5_stamp_year",
    after("SELECT k, activity_year, CAST(2024 AS INTEGER) AS data_year FROM loans"),
)
def prj5(spark, sf_dir):
    return stamp_year(fixtures.originated(spark, sf_dir), 2024).select(
        "k", "activity_year", "data_year"
    )


@registered(
    "prj6_available_columns",
    after(
        "SELECT k, "
        + ", ".join(name for name in LOAD_COLUMNS if name in REGISTER_COLUMNS)
        + " FROM loans"
    ),
)
def prj6(spark, sf_dir):
    return available(fixtures.originated(spark, sf_dir), keep=["k"])


@registered(
    "prj7_zero_codes",
    after(
        "SELECT k, CAST(coalesce(loan_type, 0) AS INTEGER) AS loan_type, "
        "CAST(coalesce(loan_purpose, 0) AS INTEGER) AS loan_purpose, "
        "CAST(coalesce(occupancy_type, 0) AS INTEGER) AS occupancy_type, "
        "CAST(coalesce(lien_status, 0) AS INTEGER) AS lien_status, "
        "CAST(coalesce(activity_year, 0) AS INTEGER) AS activity_year FROM loans"
    ),
)
def prj7(spark, sf_dir):
    return zero_codes(fixtures.originated(spark, sf_dir)).select(
        "k", "loan_type", "loan_purpose", "occupancy_type", "lien_status", "activity_year"
    )


@registered(
    "prj8_zero_income",
    after("SELECT k, CAST(coalesce(income, 0) AS BIGINT) AS income FROM loans"),
)
def prj8(spark, sf_dir):
    return zero_income(fixtures.originated(spark, sf_dir)).select("k", "income")


@registered(
    "prj9_upper_names",
    after(
        "SELECT k AS K, "
        + ", ".join(
            f"{name} AS {name.upper()}" for name in LOAD_COLUMNS if name in REGISTER_COLUMNS
        )
        + " FROM loans"
    ),
)
def prj9(spark, sf_dir):
    return upper_names(available(fixtures.originated(spark, sf_dir), keep=["k"]))


ROUNDED = ("mkt_benchmark", "interest_rate_spread")


def rounded(frame: DataFrame) -> DataFrame:
    """Means to six decimals, since the order of a sum is not fixed."""
    return frame.withColumns({c: F.round(c, 6) for c in ROUNDED if c in frame.columns})


def rounded_sql(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in ROUNDED else c for c in columns)


@registered(
    "prj10_staging_view", after(f"SELECT {rounded_sql(STAGING_COLUMNS)} FROM staged")
)
def prj10(spark, sf_dir):
    return rounded(staging_view(fixtures.staged(spark, sf_dir)).drop("dbt_updated_at"))


@registered(
    "prj11_ratios_without_helper",
    after(
        f"SELECT k, {', '.join(REGISTER_COLUMNS)}, loan_to_value_ratio, "
        "debt_to_income_numeric FROM enriched"
    ),
)
def prj11(spark, sf_dir):
    return add_ratios(fixtures.originated(spark, sf_dir))


@registered(
    "prj13_sample_columns",
    after(f"SELECT id, {rounded_sql(SAMPLE_COLUMNS)} FROM fact"),
)
def prj13(spark, sf_dir):
    fact = fixtures.fact(spark, sf_dir)
    return rounded(fact.select("id", *select_sample_columns(fact).columns))


# Filters


@registered(
    "flt1_originated_text",
    after("SELECT k, action_taken FROM register WHERE action_taken = '1'"),
)
def flt1(spark, sf_dir):
    return originated_text(fixtures.register(spark, sf_dir)).select("k", "action_taken")


@registered("flt2_originated_number", after(EXPLORE_SQL))
def flt2(spark, sf_dir):
    return explore_input(spark, sf_dir)


@registered("flt3_sample_quality", after("SELECT id, income FROM quality"))
def flt3(spark, sf_dir):
    return sample_quality(fixtures.summary_fact(spark, sf_dir)).select("id", "income")


HIGH_DTI_SQL = (
    "interest_rate > 6.0 AND debt_to_income_ratio IN "
    "('45', '46', '47', '48', '49', '50%-60%', '>60%')"
)


@registered(
    "flt4_high_rate_high_dti",
    after(
        "SELECT k, lei, loan_amount, income, debt_to_income_ratio, interest_rate "
        f"FROM ({EXPLORE_SQL}) WHERE {HIGH_DTI_SQL}"
    ),
)
def flt4(spark, sf_dir):
    return high_rate_high_dti(explore_input(spark, sf_dir)).select(
        "k", "lei", "loan_amount", "income", "debt_to_income_ratio", "interest_rate"
    )


@registered(
    "flt5_dashboard_selection",
    after(
        "SELECT data_year, state_code, state_name, risk_segment, loan_purpose_name, loan_count "
        f"FROM summary WHERE data_year = {YEAR} AND state_name IN ({STATE_LIST})"
    ),
)
def flt5(spark, sf_dir):
    summary = risk_summary(fixtures.summary_fact(spark, sf_dir))
    return selected(summary, YEAR, STATES).select(
        "data_year", "state_code", "state_name", "risk_segment", "loan_purpose_name", "loan_count"
    )


@registered(
    "flt5_dashboard_selection_sample",
    after(
        f"SELECT {rounded_sql(SAMPLE_COLUMNS)} FROM sample "
        f"WHERE data_year = {YEAR} AND state_name IN ({STATE_LIST})"
    ),
)
def flt5_sample(spark, sf_dir):
    sample = loan_sample(fixtures.summary_fact(spark, sf_dir), reproducible=True)
    return rounded(selected(sample, YEAR, STATES))


@registered(
    "flt7_named_states", after("SELECT id, state_name FROM fact WHERE state_name IS NOT NULL")
)
def flt7(spark, sf_dir):
    return (
        fixtures.fact(spark, sf_dir)
        .where(F.col("state_name").isNotNull())
        .select("id", "state_name")
    )


@registered(
    "flt8_drop_unmatched",
    after(f"SELECT k, avg_fed_rate FROM ({EXPLORE_JOINED_SQL}) WHERE avg_fed_rate IS NOT NULL"),
)
def flt8(spark, sf_dir):
    return matched_spread(explore_joined(spark, sf_dir)).select("k", "avg_fed_rate")


@registered(
    "flt9_unmatched",
    after(f"SELECT k, activity_year, lei FROM ({EXPLORE_JOINED_SQL}) WHERE avg_fed_rate IS NULL"),
)
def flt9(spark, sf_dir):
    return unmatched(explore_joined(spark, sf_dir)).select("k", "activity_year", "lei")


@registered(
    "flt10_heatmap_year",
    after(
        "SELECT state_code, CAST(sum(loan_count) AS BIGINT) AS loan_count FROM summary "
        f"WHERE data_year = {YEAR} GROUP BY 1"
    ),
)
def flt10(spark, sf_dir):
    return heatmap(risk_summary(fixtures.summary_fact(spark, sf_dir)), YEAR)


# Functions


@registered("fn1_loan_to_value", after("SELECT k, loan_to_value_ratio FROM enriched"))
def fn1(spark, sf_dir):
    return fixtures.originated(spark, sf_dir).select(
        "k",
        loan_to_value(F.col("loan_amount"), F.col("property_value")).alias("loan_to_value_ratio"),
    )


@registered(
    "fn2_debt_to_income",
    after("SELECT k, debt_to_income_ratio, debt_to_income_numeric FROM enriched"),
)
def fn2(spark, sf_dir):
    return fixtures.originated(spark, sf_dir).select(
        "k",
        "debt_to_income_ratio",
        debt_to_income(F.col("debt_to_income_ratio")).alias("debt_to_income_numeric"),
    )


@registered(
    "fn3_rate_spread",
    after("SELECT k, round(interest_rate_spread, 6) AS interest_rate_spread FROM enriched"),
)
def fn3(spark, sf_dir):
    return rounded(fixtures.enriched(spark, sf_dir).select("k", "interest_rate_spread"))


@registered(
    "fn4_rounded_spread",
    after(
        "SELECT k, interest_rate, avg_fed_rate, round(interest_rate - avg_fed_rate, 2) "
        f"AS interest_rate_spread FROM ({EXPLORE_JOINED_SQL}) WHERE avg_fed_rate IS NOT NULL"
    ),
)
def fn4(spark, sf_dir):
    return matched_spread(explore_joined(spark, sf_dir)).select(
        "k", "interest_rate", "avg_fed_rate", "interest_rate_spread"
    )


@registered(
    "fn5_risk_segment_as_written",
    after(f"SELECT k, {segment('debt_to_income_numeric')} AS risk_segment FROM enriched"),
)
def fn5(spark, sf_dir):
    return add_ratios(fixtures.originated(spark, sf_dir)).select(
        "k",
        risk_segment(F.col("loan_to_value_ratio"), F.col("debt_to_income_numeric")).alias(
            "risk_segment"
        ),
    )


@registered("fn6_cost_category", after(f"SELECT k, {COST} AS cost_category FROM enriched"))
def fn6(spark, sf_dir):
    return fixtures.enriched(spark, sf_dir).select(
        "k", cost_category(F.col("interest_rate_spread")).alias("cost_category")
    )


@registered(
    "fn7_year_of_timestamp",
    after(
        "SELECT CAST(observation_date AS DATE) AS observation_date, "
        "CAST(year(observation_date) AS INTEGER) AS yr FROM rates"
    ),
)
def fn7(spark, sf_dir):
    return with_date(fixtures.rates(spark, sf_dir)).select(
        "observation_date", F.year("observation_date").alias("yr")
    )


@registered(
    "fn8_model_timestamps",
    after("SELECT count(*) AS n_rows, count(*) AS n_staged, count(*) AS n_marted FROM fact"),
)
def fn8(spark, sf_dir):
    """Both model timestamps are set in every row; their value is the run's."""
    stamped = staging_view(fixtures.staged(spark, sf_dir)).withColumn(
        "mart_updated_at", F.current_timestamp()
    )
    return stamped.agg(
        F.count("*").alias("n_rows"),
        F.count("dbt_updated_at").alias("n_staged"),
        F.count("mart_updated_at").alias("n_marted"),
    )


@registered(
    "fn9_share",
    after(
        "SELECT state_code, CAST(count(CASE WHEN interest_rate IS NULL THEN 1 END) AS DOUBLE) "
        "/ NULLIF(count(*), 0) AS no_rate_share, "
        "CAST(count(CASE WHEN income IS NULL THEN 1 END) AS DOUBLE) / "
        "NULLIF(count(CASE WHEN interest_rate < 0 THEN 1 END), 0) AS over_nothing "
        "FROM loans GROUP BY 1"
    ),
)
def fn9(spark, sf_dir):
    loans = fixtures.originated(spark, sf_dir)
    return loans.groupBy("state_code").agg(
        share(F.count_if(F.col("interest_rate").isNull()), F.count("*")).alias("no_rate_share"),
        share(
            F.count_if(F.col("income").isNull()), F.count_if(F.col("interest_rate") < 0)
        ).alias("over_nothing"),
    )


@registered(
    "fn10_rounded_means",
    after(
        "SELECT state_code, "
        "CAST(round(CAST(avg(loan_amount) AS DECIMAL(38, 12)), 2) AS DOUBLE) AS avg_loan_size, "
        "CAST(round(CAST(avg(interest_rate) AS DECIMAL(38, 12)), 2) AS DOUBLE) "
        f"AS avg_interest_rate FROM ({EXPLORE_SQL}) GROUP BY 1"
    ),
)
def fn10(spark, sf_dir):
    return (
        explore_input(spark, sf_dir)
        .groupBy("state_code")
        .agg(
            F.round(F.avg("loan_amount"), 2).alias("avg_loan_size"),
            F.round(F.avg("interest_rate"), 2).alias("avg_interest_rate"),
        )
    )


# Joins


@registered(
    "jn1_join_benchmark",
    after("SELECT k, activity_year, yr, round(mkt_benchmark, 6) AS mkt_benchmark FROM enriched"),
)
def jn1(spark, sf_dir):
    joined = join_benchmark(
        fixtures.originated(spark, sf_dir), fixtures.rates(spark, sf_dir)
    )
    return rounded(joined.select("k", "activity_year", "yr", "mkt_benchmark"))


@registered(
    "jn2_join_benchmark_rounded",
    after(f"SELECT k, activity_year, avg_fed_rate FROM ({EXPLORE_JOINED_SQL})"),
)
def jn2(spark, sf_dir):
    return explore_joined(spark, sf_dir).select("k", "activity_year", "avg_fed_rate")


def _register_lookups() -> None:
    for number, (name, (code, text)) in enumerate(LOOKUPS.items(), start=3):

        def lookup(spark, sf_dir, name=name, code=code, text=text):
            staged = fixtures.staged(spark, sf_dir)
            return describe(staged, builtin_seeds(spark), [name]).select("id", code, text)

        registered(
            f"jn{number}_describe_{name}", after(f"SELECT id, {code}, {text} FROM described")
        )(lookup)


_register_lookups()


# Benchmarks


@registered(
    "ag1_yearly_benchmark",
    after("SELECT yr, round(mkt_benchmark, 6) AS mkt_benchmark FROM yearly"),
)
def ag1(spark, sf_dir):
    return rounded(yearly_benchmark(fixtures.rates(spark, sf_dir)))


@registered("ag2_yearly_benchmark_rounded", after("SELECT * FROM yearly2"))
def ag2(spark, sf_dir):
    return yearly_benchmark_rounded(fixtures.rates(spark, sf_dir))

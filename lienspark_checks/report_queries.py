"""Queries for results over the fact and the summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lienspark.operators.quality import (
    accepted_values_failures,
    not_null_failures,
    unique_failures,
)
from lienspark.operators.sampling import random_rows, sample_quality
from lienspark.operators.shaping import staging_view
from lienspark.operators.summary import (
    heatmap,
    kpis,
    purpose_breakdown,
    risk_hierarchy,
    state_names,
    years,
)
from lienspark.plans import documented
from lienspark.plans.dashboard import selected
from lienspark.plans.explore import (
    high_rate_high_dti,
    largest_first,
    newest_benchmarks,
    newest_rates,
    top_states,
    unmatched,
)
from lienspark.plans.marts import loan_sample, sample_of, segmented, summarise
from lienspark.schemas import FACT_COLUMNS, SAMPLE_COLUMNS
from lienspark.sources.seeds import builtin_seeds
from lienspark_checks import fixtures
from lienspark_checks.oracle import after, segment
from lienspark_checks.registry import registered
from lienspark_checks.step_queries import (
    EXPLORE_JOINED_SQL,
    EXPLORE_SQL,
    HIGH_DTI_SQL,
    STATE_LIST,
    STATES,
    YEAR,
    explore_input,
    explore_joined,
    rounded,
    rounded_sql,
    with_date,
)

SUMMARY_SQL = (
    "SELECT data_year, state_code, state_name, risk_segment, loan_purpose_name, loan_count, "
    "total_loan_amount, round(sum_interest_rate, 6) AS sum_interest_rate, "
    "round(avg_rate_spread, 6) AS avg_rate_spread, high_risk_ratio FROM summary"
)


def rounded_summary(summary: DataFrame) -> DataFrame:
    return summary.withColumns(
        {name: F.round(name, 6) for name in ("sum_interest_rate", "avg_rate_spread")}
    )


def summary_of(spark, sf_dir) -> DataFrame:
    loans = segmented(fixtures.staged(spark, sf_dir))
    return summarise(loans, builtin_seeds(spark))


# Fact and aggregates


@registered("fct_loan_risk", after(f"SELECT {rounded_sql(FACT_COLUMNS)} FROM fact"))
def fct_loan_risk(spark, sf_dir):
    return rounded(fixtures.fact(spark, sf_dir).drop("mart_updated_at"))


@registered("ag3_risk_summary", after(SUMMARY_SQL))
def ag3(spark, sf_dir):
    return rounded_summary(summary_of(spark, sf_dir))


@registered(
    "ag4_high_risk_ratio",
    after(
        "SELECT risk_segment, high_risk_ratio, count(*) AS n_groups, "
        "CAST(sum(loan_count) AS BIGINT) AS loan_count FROM summary GROUP BY 1, 2"
    ),
)
def ag4(spark, sf_dir):
    return (
        summary_of(spark, sf_dir)
        .groupBy("risk_segment", "high_risk_ratio")
        .agg(F.count("*").alias("n_groups"), F.sum("loan_count").alias("loan_count"))
    )


@registered(
    "ag5_heatmap",
    after(
        "SELECT state_code, CAST(sum(loan_count) AS BIGINT) AS loan_count FROM summary "
        "WHERE data_year = 2000 GROUP BY 1"
    ),
)
def ag5(spark, sf_dir):
    return heatmap(summary_of(spark, sf_dir), 2000)


CHOSEN_SQL = f"FROM summary WHERE data_year = {YEAR} AND state_name IN ({STATE_LIST})"


@registered(
    "ag6_kpis",
    after(
        "SELECT total_loans, amount / 1e6 AS portfolio_value_millions, "
        "round(rates / total_loans, 6) AS avg_market_rate, "
        "round(high / total_loans * 100, 6) AS high_risk_pct FROM ("
        "SELECT CAST(sum(loan_count) AS BIGINT) AS total_loans, sum(total_loan_amount) AS amount, "
        "sum(sum_interest_rate) AS rates, "
        "CAST(sum(CASE WHEN risk_segment = 'High' THEN loan_count END) AS DOUBLE) AS high "
        f"{CHOSEN_SQL})"
    ),
)
def ag6(spark, sf_dir):
    return kpis(selected(summary_of(spark, sf_dir), YEAR, STATES)).withColumns(
        {name: F.round(name, 6) for name in ("avg_market_rate", "high_risk_pct")}
    )


@registered(
    "ag7_risk_hierarchy",
    after(
        "SELECT risk_segment, loan_purpose_name, CAST(sum(loan_count) AS BIGINT) AS loan_count, "
        f"CAST(0 AS INTEGER) AS is_total {CHOSEN_SQL} GROUP BY 1, 2 UNION ALL "
        "SELECT risk_segment, NULL, CAST(sum(loan_count) AS BIGINT), CAST(1 AS INTEGER) "
        f"{CHOSEN_SQL} GROUP BY 1"
    ),
)
def ag7(spark, sf_dir):
    return risk_hierarchy(selected(summary_of(spark, sf_dir), YEAR, STATES))


@registered(
    "ag8_purpose_breakdown",
    after(
        "SELECT loan_purpose_name, risk_segment, CAST(sum(loan_count) AS BIGINT) AS loan_count "
        f"{CHOSEN_SQL} AND loan_purpose_name IS NOT NULL GROUP BY 1, 2"
    ),
)
def ag8(spark, sf_dir):
    return purpose_breakdown(selected(summary_of(spark, sf_dir), YEAR, STATES))


TOP_SQL = (
    "SELECT state_code, count(*) AS total_loans, "
    "CAST(round(CAST(avg(loan_amount) AS DECIMAL(38, 12)), 2) AS DOUBLE) AS avg_loan_size, "
    "CAST(round(CAST(avg(interest_rate) AS DECIMAL(38, 12)), 2) AS DOUBLE) AS avg_interest_rate "
    f"FROM ({EXPLORE_SQL}) GROUP BY 1 ORDER BY total_loans DESC, state_code NULLS LAST"
)


@registered("ag9_top_states", after(f"{TOP_SQL} LIMIT 10"))
def ag9(spark, sf_dir):
    return top_states(explore_input(spark, sf_dir))


@registered("ag10_row_count", after(f"SELECT count(*) AS n_loans FROM ({EXPLORE_SQL})"))
def ag10(spark, sf_dir):
    return explore_input(spark, sf_dir).agg(F.count("*").alias("n_loans"))


@registered(
    "ag11_unmatched_count",
    after(f"SELECT count(*) AS n_unmatched FROM ({EXPLORE_JOINED_SQL}) WHERE avg_fed_rate IS NULL"),
)
def ag11(spark, sf_dir):
    return unmatched(explore_joined(spark, sf_dir)).agg(F.count("*").alias("n_unmatched"))


@registered("ag12_years", after("SELECT DISTINCT data_year FROM summary ORDER BY data_year DESC"))
def ag12_years(spark, sf_dir):
    return years(summary_of(spark, sf_dir))


@registered(
    "ag12_state_names",
    after(
        "SELECT DISTINCT state_name FROM summary WHERE state_name IS NOT NULL ORDER BY state_name"
    ),
)
def ag12_state_names(spark, sf_dir):
    return state_names(summary_of(spark, sf_dir))


# Order, limit, sample


@registered("srt1_top_three_states", after(f"{TOP_SQL} LIMIT 3"))
def srt1(spark, sf_dir):
    return top_states(explore_input(spark, sf_dir), 3)


@registered(
    "srt2_largest_first",
    after(
        "SELECT k, lei, loan_amount, income, debt_to_income_ratio, interest_rate "
        f"FROM ({EXPLORE_SQL}) WHERE {HIGH_DTI_SQL} ORDER BY loan_amount DESC NULLS LAST, k"
    ),
)
def srt2(spark, sf_dir):
    loans = high_rate_high_dti(explore_input(spark, sf_dir)).select(
        "k", "lei", "loan_amount", "income", "debt_to_income_ratio", "interest_rate"
    )
    return largest_first(loans, "k")


@registered(
    "srt3_newest_rates",
    after(
        "SELECT CAST(observation_date AS DATE) AS observation_date, fed_rate, "
        "CAST(year(observation_date) AS INTEGER) AS activity_year FROM rates "
        "ORDER BY activity_year DESC, observation_date DESC"
    ),
)
def srt3(spark, sf_dir):
    return newest_rates(with_date(fixtures.rates(spark, sf_dir)))


@registered(
    "srt3_newest_benchmarks",
    after("SELECT activity_year, avg_fed_rate FROM yearly2 ORDER BY activity_year DESC"),
)
def srt3_benchmarks(spark, sf_dir):
    return newest_benchmarks(fixtures.rates(spark, sf_dir))


@registered("srt4_loan_sample", after(f"SELECT {rounded_sql(SAMPLE_COLUMNS)} FROM sample"))
def srt4(spark, sf_dir):
    loans = segmented(fixtures.staged(spark, sf_dir))
    return rounded(sample_of(loans, builtin_seeds(spark), reproducible=True))


@registered(
    "srt4_small_sample",
    after("SELECT id, income FROM quality ORDER BY md5(CAST(id AS VARCHAR)), id LIMIT 100"),
)
def srt4_small(spark, sf_dir):
    """A sample far smaller than the table, so that the limit binds."""
    fit = sample_quality(fixtures.summary_fact(spark, sf_dir))
    return random_rows(fit, 100, reproducible=True).select("id", "income")


@registered(
    "srt4_seeded_sample_size",
    after("SELECT least(count(*), 10000) AS n_rows, least(count(*), 10000) AS n_ids FROM quality"),
)
def srt4_seeded(spark, sf_dir):
    """The seeded draw differs between engines; its size and distinct ids do not."""
    fit = sample_quality(fixtures.summary_fact(spark, sf_dir))
    return random_rows(fit, seed=7).agg(
        F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids")
    )


@registered(
    "srt5_head",
    after("SELECT k, activity_year, lei FROM register ORDER BY k LIMIT 5"),
)
def srt5(spark, sf_dir):
    head = fixtures.register(spark, sf_dir).orderBy("k").limit(5)
    return head.select("k", "activity_year", "lei")


# Data tests


@registered(
    "dq1_unique_id",
    after("SELECT id, count(*) AS n_rows FROM fact GROUP BY 1 HAVING count(*) > 1"),
)
def dq1(spark, sf_dir):
    return unique_failures(fixtures.summary_fact(spark, sf_dir), "id")


@registered(
    "dq1_unique_lender",
    after(
        "SELECT lei, count(*) AS n_rows FROM fact WHERE lei IS NOT NULL "
        "GROUP BY 1 HAVING count(*) > 1"
    ),
)
def dq1_lender(spark, sf_dir):
    """The same test on a column that repeats, so that it has failures to show."""
    return unique_failures(fixtures.summary_fact(spark, sf_dir), "lei")


def _nulls(table: str, *columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS n_rows FROM {table} "
        f"WHERE {name} IS NULL HAVING count(*) > 0"
        for name in columns
    )


FACT_NOT_NULL = ["id", "state_name", "loan_purpose_name", "interest_rate", "income"]


@registered("dq2_not_null_fact", after(_nulls("fact", *FACT_NOT_NULL)))
def dq2_fact(spark, sf_dir):
    return not_null_failures(fixtures.fact(spark, sf_dir), FACT_NOT_NULL)


@registered("dq2_not_null_summary", after(_nulls("summary", "data_year", "state_code")))
def dq2_summary(spark, sf_dir):
    return not_null_failures(summary_of(spark, sf_dir), ["data_year", "state_code"])


@registered(
    "dq2_not_null_sample", after(_nulls("sample", "income", "interest_rate_spread", "state_name"))
)
def dq2_sample(spark, sf_dir):
    return not_null_failures(
        loan_sample(fixtures.summary_fact(spark, sf_dir), reproducible=True),
        ["income", "interest_rate_spread", "state_name"],
    )


@registered("dq3_not_null_source", after(_nulls("staged", "data_year", "state_code")))
def dq3(spark, sf_dir):
    return not_null_failures(fixtures.staged(spark, sf_dir), ["data_year", "state_code"])


@registered(
    "dq4_accepted_values",
    after(
        "SELECT 'risk_segment' AS column_name, risk_segment AS value, count(*) AS n_rows "
        "FROM fact WHERE risk_segment NOT IN ('Low', 'High') GROUP BY 2 UNION ALL "
        "SELECT 'cost_category', cost_category, count(*) FROM fact "
        "WHERE cost_category NOT IN ('High Cost', 'Market/Subsidized') GROUP BY 2"
    ),
)
def dq4(spark, sf_dir):
    """One value too few is accepted, so that the test has failures to show."""
    return accepted_values_failures(
        fixtures.summary_fact(spark, sf_dir),
        {
            "risk_segment": ["Low", "High"],
            "cost_category": ["High Cost", "Market/Subsidized"],
        },
    )


# Documented questions


@registered(
    "doc1_high_risk_by_state",
    after(
        "SELECT state_code, state_name, count(*) AS loan_count, "
        "CAST(count(CASE WHEN risk_segment = 'High' THEN 1 END) AS DOUBLE) / count(*) "
        "AS high_risk_share FROM fact GROUP BY 1, 2 "
        "ORDER BY high_risk_share DESC, state_code NULLS LAST"
    ),
)
def doc1(spark, sf_dir):
    return documented.high_risk_by_state(fixtures.summary_fact(spark, sf_dir))


@registered(
    "doc2_ltv_beside_benchmark",
    after(
        "SELECT data_year, round(avg(loan_to_value_ratio), 6) AS avg_ltv, "
        "round(avg(mkt_benchmark), 6) AS mkt_benchmark FROM fact GROUP BY 1"
    ),
)
def doc2(spark, sf_dir):
    trend = documented.ltv_beside_benchmark(fixtures.summary_fact(spark, sf_dir))
    return trend.withColumns({name: F.round(name, 6) for name in ("avg_ltv", "mkt_benchmark")})


@registered(
    "doc3_segment_shares",
    after(
        "SELECT state_code, risk_segment, loan_count, CAST(loan_count AS DOUBLE) / "
        "sum(loan_count) OVER (PARTITION BY state_code) AS segment_share FROM ("
        "SELECT state_code, risk_segment, count(*) AS loan_count FROM fact GROUP BY 1, 2)"
    ),
)
def doc3(spark, sf_dir):
    return documented.segment_shares(fixtures.summary_fact(spark, sf_dir))


@registered(
    "doc4_ratio_kpis",
    after(
        "SELECT round(avg(loan_to_value_ratio), 6) AS avg_ltv, "
        "round(avg(debt_to_income_numeric), 6) AS avg_dti FROM fact"
    ),
)
def doc4(spark, sf_dir):
    means = documented.ratio_kpis(fixtures.summary_fact(spark, sf_dir))
    return means.withColumns({name: F.round(name, 6) for name in means.columns})


@registered(
    "doc5_segment_distribution",
    after("SELECT risk_segment, count(*) AS loan_count FROM fact GROUP BY 1"),
)
def doc5(spark, sf_dir):
    return documented.segment_distribution(fixtures.summary_fact(spark, sf_dir))


@registered(
    "doc6_loan_type_breakdown",
    after("SELECT loan_type_name, count(*) AS loan_count FROM fact GROUP BY 1"),
)
def doc6(spark, sf_dir):
    return documented.loan_type_breakdown(fixtures.fact(spark, sf_dir))


@registered(
    "doc7_ltv_dti_sample",
    after(
        "SELECT id, loan_to_value_ratio, debt_to_income_numeric, risk_segment FROM fact "
        "WHERE loan_to_value_ratio IS NOT NULL AND debt_to_income_numeric IS NOT NULL "
        "ORDER BY md5(CAST(id AS VARCHAR)), id LIMIT 10000"
    ),
)
def doc7(spark, sf_dir):
    return documented.ltv_dti_sample(fixtures.summary_fact(spark, sf_dir), reproducible=True)


@registered(
    "doc8_risk_segment_percent",
    after(f"SELECT k AS id, {segment('debt_to_income_numeric * 100')} AS risk_segment FROM enriched"),
)
def doc8(spark, sf_dir):
    return fixtures.fact(spark, sf_dir, dti_scale=100).select("id", "risk_segment")


@registered(
    "doc9_by_segment_and_type",
    after(
        "SELECT id, risk_segment, loan_type_name FROM fact "
        "WHERE risk_segment IN ('High', 'Medium') AND loan_type_name IN ('Conventional', 'FHA-insured')"
    ),
)
def doc9(spark, sf_dir):
    return documented.by_segment_and_type(
        fixtures.fact(spark, sf_dir), ["High", "Medium"], ["Conventional", "FHA-insured"]
    ).select("id", "risk_segment", "loan_type_name")


@registered(
    "doc10_one_year_view",
    after(f"SELECT id, data_year, lei, loan_amount FROM staged WHERE data_year = {YEAR}"),
)
def doc10(spark, sf_dir):
    return staging_view(fixtures.staged(spark, sf_dir), YEAR).select(
        "id", "data_year", "lei", "loan_amount"
    )


@registered(
    "doc11_loans_of_named_states",
    after(f"SELECT id, state_code FROM fact WHERE data_year = {YEAR} AND state_name IN ({STATE_LIST})"),
)
def doc11(spark, sf_dir):
    states = builtin_seeds(spark)["state_mapping"]
    fact = fixtures.summary_fact(spark, sf_dir)
    return documented.in_states(fact, states, YEAR, STATES).select("id", "state_code")

"""DuckDB text for each step, put together by the queries' oracles."""

from __future__ import annotations

from lienspark.schemas import FACT_COLUMNS, LOAD_COLUMNS, REGISTER_TYPES
from lienspark.sources.seeds import SEED_ROWS, SEED_SCHEMAS
from lienspark_checks.fixtures import RATES_SQL, STATE_FOR_MISSING

# The loan-shaped register; ``fixtures`` has the same with array lookups.
REGISTER_SQL = """
SELECT o_orderkey AS k,
 CASE WHEN o_orderkey % 29 = 0 THEN '2005' ELSE CAST(year(o_orderdate) AS STRING)
  END AS activity_year,
 concat('LEI', lpad(CAST(o_custkey % 100 AS STRING), 17, '0')) AS lei,
 CASE c_nationkey WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' WHEN 2 THEN 'FL' WHEN 3 THEN 'NY'
  WHEN 4 THEN 'WA' WHEN 5 THEN 'IL' WHEN 6 THEN 'OH' WHEN 7 THEN 'GA' WHEN 8 THEN 'NC'
  WHEN 9 THEN 'MI' WHEN 10 THEN 'NJ' WHEN 11 THEN 'VA' WHEN 12 THEN 'AZ' WHEN 13 THEN 'PR'
  WHEN 14 THEN 'NA' WHEN 15 THEN NULL ELSE 'CO' END AS state_code,
 lpad(CAST(o_custkey % 1000 AS STRING), 5, '0') AS county_code,
 lpad(CAST(o_custkey AS STRING), 11, '0') AS census_tract,
 CASE WHEN o_orderkey % 50 = 49 THEN 'NA' ELSE CAST(1 + o_orderkey % 4 AS STRING) END AS loan_type,
 CASE WHEN o_orderkey % 47 = 46 THEN 'NA' WHEN o_orderkey % 6 = 0 THEN '1'
  WHEN o_orderkey % 6 = 1 THEN '2' WHEN o_orderkey % 6 = 2 THEN '31'
  WHEN o_orderkey % 6 = 3 THEN '32' WHEN o_orderkey % 6 = 4 THEN '4' ELSE '5' END AS loan_purpose,
 CAST(CAST(round(o_totalprice) AS BIGINT) AS STRING) AS loan_amount,
 CASE WHEN o_orderkey % 37 = 0 THEN 'NA' WHEN o_orderkey % 41 = 0 THEN 'Exempt'
  ELSE concat(CAST(2 + o_orderkey % 7 AS STRING), '.', CAST(o_orderkey % 10 AS STRING))
  END AS interest_rate,
 CASE WHEN o_orderkey % 97 = 0 THEN 'Exempt' WHEN o_orderkey % 101 = 0 THEN '0'
  ELSE CAST(CAST(round(round(o_totalprice) * 100 / (35 + o_orderkey % 76)) AS BIGINT) AS STRING)
  END AS property_value,
 CAST(1 + o_orderkey % 3 AS STRING) AS occupancy_type,
 CAST(o_orderkey % 5000 AS STRING) AS total_loan_costs,
 CASE WHEN o_orderkey % 31 = 0 THEN 'NA' WHEN o_orderkey % 53 = 0 THEN '63.5'
  ELSE CAST(o_orderkey % 1100 AS STRING) END AS income,
 CASE o_orderkey % 11 WHEN 0 THEN '<20%' WHEN 1 THEN '20%-<30%' WHEN 2 THEN '30%-<36%'
  WHEN 3 THEN '36' WHEN 4 THEN '43' WHEN 5 THEN '44' WHEN 6 THEN '49' WHEN 7 THEN '50%-60%'
  WHEN 8 THEN '>60%' WHEN 9 THEN 'NA' ELSE 'Exempt' END AS debt_to_income_ratio,
 CAST(1 + o_orderkey % 9 AS STRING) AS applicant_credit_score_type,
 CAST(1 + o_orderkey % 4 AS STRING) AS applicant_sex,
 CASE o_orderkey % 4 WHEN 0 THEN '<25' WHEN 1 THEN '25-34' WHEN 2 THEN '>74' ELSE 'NA'
  END AS applicant_age,
 CASE o_orderstatus WHEN 'P' THEN '3' ELSE '1' END AS action_taken,
 CAST(1 + o_orderkey % 3 AS STRING) AS hoepa_status,
 CAST(1 + o_orderkey % 2 AS STRING) AS lien_status,
 CASE WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE concat(CAST(40 + o_orderkey % 60 AS STRING), '.5')
  END AS combined_loan_to_value_ratio,
 CASE o_orderkey % 3 WHEN 0 THEN '360' WHEN 1 THEN '180' ELSE 'NA' END AS loan_term,
 CASE WHEN o_orderkey % 5 = 0 THEN '60' ELSE 'NA' END AS intro_rate_period,
 CAST(1 + o_orderkey % 2 AS STRING) AS interest_only_payment,
 CAST(1 + o_orderkey % 2 AS STRING) AS balloon_payment,
 CAST(1 + o_orderkey % 2 AS STRING) AS negative_amortization,
 CASE o_orderstatus WHEN 'P' THEN CAST(1 + o_orderkey % 9 AS STRING) ELSE '10' END AS denial_reason_1,
 CASE o_orderkey % 3 WHEN 0 THEN 'White' WHEN 1 THEN 'Asian' ELSE 'Race Not Available' END AS derived_race,
 CASE o_orderkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Joint' END AS derived_sex
FROM orders JOIN customer ON o_custkey = c_custkey
"""

_DUCK_TYPES = {"int": "INTEGER", "smallint": "SMALLINT", "bigint": "BIGINT"}


def _cast(name: str) -> str:
    kind = REGISTER_TYPES[name]
    if kind == "string":
        return name
    if kind == "double":
        return f"TRY_CAST({name} AS DOUBLE) AS {name}"
    return f"TRY_CAST(trunc(TRY_CAST({name} AS DOUBLE)) AS {_DUCK_TYPES[kind]}) AS {name}"


def _seed(name: str) -> str:
    columns = ", ".join(field.split()[0] for field in SEED_SCHEMAS[name].split(", "))
    rows = ", ".join(
        f"({key}, '{text}')" if isinstance(key, int) else f"('{key}', '{text}')"
        for key, text in SEED_ROWS[name]
    )
    return f"SELECT * FROM (VALUES {rows}) AS seed({columns})"


def _load(name: str) -> str:
    if name in ("loan_type", "loan_purpose", "occupancy_type", "lien_status", "activity_year"):
        return f"CAST(coalesce({name}, 0) AS INTEGER) AS {name}"
    if name == "income":
        return "CAST(coalesce(income, 0) AS BIGINT) AS income"
    if name == "data_year":
        return "CAST(coalesce(activity_year, 0) AS INTEGER) AS data_year"
    return name


def segment(dti: str) -> str:
    return (
        f"CASE WHEN loan_to_value_ratio > 0.8 OR {dti} > 43 THEN 'High' "
        f"WHEN loan_to_value_ratio BETWEEN 0.6 AND 0.8 AND {dti} <= 43 THEN 'Medium' "
        "ELSE 'Low' END"
    )


COST = "CASE WHEN interest_rate_spread > 0 THEN 'High Cost' ELSE 'Market/Subsidized' END"

_STEPS = {
    "register": REGISTER_SQL,
    "rates": RATES_SQL.format(lineitem="lineitem"),
    "yearly": (
        "SELECT CAST(year(observation_date) AS INTEGER) AS yr, avg(fed_rate) AS mkt_benchmark "
        "FROM rates GROUP BY 1"
    ),
    "yearly2": (
        "SELECT CAST(year(observation_date) AS INTEGER) AS activity_year, "
        "round(avg(fed_rate), 2) AS avg_fed_rate FROM rates GROUP BY 1"
    ),
    "loans": (
        f"SELECT k, {', '.join(_cast(name) for name in REGISTER_TYPES)} "
        "FROM register WHERE action_taken = '1'"
    ),
    "enriched": (
        "SELECT loans.*, loan_amount / NULLIF(property_value, 0) AS loan_to_value_ratio, "
        "CAST(NULLIF(regexp_extract(debt_to_income_ratio, '(\\d+)', 1), '') AS DOUBLE) / 100 "
        "AS debt_to_income_numeric, yr, mkt_benchmark, "
        "interest_rate - mkt_benchmark AS interest_rate_spread "
        "FROM loans LEFT JOIN yearly ON activity_year = yr"
    ),
    "staged": f"SELECT k AS id, {', '.join(_load(name) for name in LOAD_COLUMNS)} FROM enriched",
    **{name: _seed(name) for name in SEED_ROWS},
    "described": (
        "SELECT staged.*, lt.description AS loan_type_name, lp.description AS loan_purpose_name, "
        "ot.description AS occupancy_type_name, ls.description AS lien_status_name, state_name "
        "FROM staged LEFT JOIN loan_type lt ON staged.loan_type = lt.id "
        "LEFT JOIN loan_purpose lp ON staged.loan_purpose = lp.id "
        "LEFT JOIN occupancy_type ot ON staged.occupancy_type = ot.id "
        "LEFT JOIN lien_status ls ON staged.lien_status = ls.id "
        "LEFT JOIN state_mapping sm ON staged.state_code = sm.state_code"
    ),
    "segmented": (
        f"SELECT *, {segment('debt_to_income_numeric')} AS risk_segment, {COST} AS cost_category "
        "FROM described"
    ),
    "fact": f"SELECT {', '.join(FACT_COLUMNS)} FROM segmented",
    "summary": (
        "SELECT data_year, state_code, state_name, risk_segment, loan_purpose_name, "
        "count(*) AS loan_count, sum(loan_amount) AS total_loan_amount, "
        "sum(interest_rate) AS sum_interest_rate, avg(interest_rate_spread) AS avg_rate_spread, "
        "CAST(count(CASE WHEN risk_segment = 'High' THEN 1 END) AS DOUBLE) "
        "/ NULLIF(count(*), 0) AS high_risk_ratio FROM fact GROUP BY 1, 2, 3, 4, 5"
    ),
    "quality": (
        "SELECT * FROM fact WHERE income > 0 AND income < 1000 "
        "AND interest_rate_spread IS NOT NULL AND interest_rate_spread != 0"
    ),
    "sample": "SELECT * FROM quality ORDER BY md5(CAST(id AS VARCHAR)), id LIMIT 10000",
}


def after(select: str, all_states: bool = False) -> str:
    """``select`` with every step in front of it; unused ones cost nothing."""
    texts = dict(_STEPS)
    if all_states:
        texts["register"] = REGISTER_SQL.replace("THEN NULL ELSE 'CO'", f"THEN '{STATE_FOR_MISSING}' ELSE 'CO'")
    steps = ", ".join(f"{name} AS ({text})" for name, text in texts.items())
    return f"WITH {steps} {select}"

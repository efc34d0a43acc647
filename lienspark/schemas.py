"""Column lists and types shared by every step."""

from __future__ import annotations

# The public loan register columns the pipeline keeps, each with
# the type it is cast to after the all-text read.
REGISTER_TYPES = {
    "activity_year": "int",
    "lei": "string",
    "state_code": "string",
    "county_code": "string",
    "census_tract": "string",
    "loan_type": "smallint",
    "loan_purpose": "smallint",
    "loan_amount": "double",
    "interest_rate": "double",
    "property_value": "double",
    "occupancy_type": "smallint",
    "total_loan_costs": "double",
    "income": "int",
    "debt_to_income_ratio": "string",
    "applicant_credit_score_type": "smallint",
    "applicant_sex": "smallint",
    "applicant_age": "string",
    "action_taken": "smallint",
    "hoepa_status": "smallint",
    "lien_status": "smallint",
}
REGISTER_COLUMNS = list(REGISTER_TYPES)

# The other 20 columns, used by the exploration queries.
EXPLORE_COLUMNS = [
    "activity_year",
    "lei",
    "state_code",
    "loan_type",
    "loan_purpose",
    "loan_amount",
    "interest_rate",
    "property_value",
    "income",
    "debt_to_income_ratio",
    "combined_loan_to_value_ratio",
    "loan_term",
    "intro_rate_period",
    "interest_only_payment",
    "balloon_payment",
    "negative_amortization",
    "action_taken",
    "denial_reason_1",
    "derived_race",
    "derived_sex",
]

# The warehouse table. `id` and `loaded_at` are made on load, the
# last two columns are its partition keys.
WAREHOUSE_TYPES = {
    "id": "bigint",
    "activity_year": "int",
    "lei": "string",
    "county_code": "string",
    "census_tract": "string",
    "loan_type": "int",
    "loan_purpose": "int",
    "loan_amount": "double",
    "interest_rate": "double",
    "property_value": "double",
    "occupancy_type": "int",
    "lien_status": "int",
    "income": "bigint",
    "applicant_age": "string",
    "loan_to_value_ratio": "double",
    "debt_to_income_numeric": "double",
    "mkt_benchmark": "double",
    "interest_rate_spread": "double",
    "loaded_at": "timestamp",
    "data_year": "int",
    "state_code": "string",
}
PARTITION_KEYS = ["data_year", "state_code"]

# What a load takes from staging, in the order it is inserted.
LOAD_COLUMNS = [
    "activity_year",
    "lei",
    "state_code",
    "county_code",
    "census_tract",
    "loan_type",
    "loan_purpose",
    "loan_amount",
    "interest_rate",
    "property_value",
    "occupancy_type",
    "lien_status",
    "income",
    "applicant_age",
    "loan_to_value_ratio",
    "debt_to_income_numeric",
    "mkt_benchmark",
    "interest_rate_spread",
    "data_year",
]

# Whole-number columns whose NULL becomes 0 on load.
CODE_COLUMNS = [
    "loan_type",
    "loan_purpose",
    "occupancy_type",
    "lien_status",
    "data_year",
    "activity_year",
]

# The staging view, without its timestamp.
STAGING_COLUMNS = [
    "id",
    "lei",
    "state_code",
    "county_code",
    "census_tract",
    "data_year",
    "activity_year",
    "loan_type",
    "loan_purpose",
    "loan_amount",
    "interest_rate",
    "property_value",
    "income",
    "occupancy_type",
    "lien_status",
    "loan_to_value_ratio",
    "debt_to_income_numeric",
    "mkt_benchmark",
    "interest_rate_spread",
]

# The fact, without its timestamp.
FACT_COLUMNS = [
    "id",
    "lei",
    "state_code",
    "state_name",
    "county_code",
    "census_tract",
    "data_year",
    "loan_amount",
    "property_value",
    "income",
    "interest_rate",
    "loan_type_name",
    "loan_purpose_name",
    "occupancy_type_name",
    "lien_status_name",
    "loan_to_value_ratio",
    "debt_to_income_numeric",
    "mkt_benchmark",
    "interest_rate_spread",
    "risk_segment",
    "cost_category",
]

# The columns of the dashboard sample.
SAMPLE_COLUMNS = [
    "data_year",
    "state_code",
    "state_name",
    "income",
    "interest_rate_spread",
    "risk_segment",
    "loan_amount",
    "loan_purpose_name",
]

RISK_SEGMENTS = ["Low", "Medium", "High"]
COST_CATEGORIES = ["High Cost", "Market/Subsidized"]


def layer_name(base: str, layer: str | None = None, style: str = "prefixed") -> str:
    """Database of a layer: ``base_layer``, or the bare upper-cased layer."""
    base = base.strip()
    layer = layer.strip() if layer is not None else None
    if style == "prefixed":
        return base if layer is None else f"{base}_{layer}"
    if style == "bare":
        return (base if layer is None else layer).upper()
    raise ValueError(f"unknown layer style {style!r}: use 'prefixed' or 'bare'")

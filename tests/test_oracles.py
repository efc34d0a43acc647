"""Every registered query beside its DuckDB text, on the small tables."""

import pytest

import __spark_entry__ as contract
from conftest import SF_DIR
from lienspark_checks.compare import connect, differences
from lienspark_checks.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert differences(frame, duck, contract.oracle_sql()[name]) is None


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0
    assert frame.columns == [
        "data_year",
        "state_code",
        "state_name",
        "risk_segment",
        "loan_purpose_name",
        "loan_count",
        "total_loan_amount",
        "sum_interest_rate",
        "avg_rate_spread",
        "high_risk_ratio",
    ]


def test_segments_of_the_known_table(spark):
    """Counts known beforehand for the sf0.01 tables, under both readings."""
    from lienspark_checks import fixtures

    def counts(scale):
        fact = fixtures.fact(spark, "/root/testdata/sf0.01", dti_scale=scale)
        return {row.risk_segment: row["count"] for row in fact.groupBy("risk_segment").count().collect()}

    assert counts(1) == {"High": 3863, "Medium": 2113, "Low": 3936}
    assert counts(100) == {"High": 6073, "Medium": 1180, "Low": 2659}

"""Inputs written once give the same results as derived ones."""

from conftest import SF_DIR
from lienspark_checks import fixtures, job_queries, report_queries  # noqa: F401
from lienspark_checks.registry import QUERIES


def test_prepared_inputs_change_no_result(spark, monkeypatch):
    names = ["job2_enrich", "ag3_risk_summary", "src4_read_rates"]
    derived = {name: sorted(QUERIES[name](spark, SF_DIR).collect(), key=str) for name in names}
    monkeypatch.setattr(fixtures, "_prepared", {})
    fixtures.prepare(spark, SF_DIR)
    for name in names:
        assert sorted(QUERIES[name](spark, SF_DIR).collect(), key=str) == derived[name]

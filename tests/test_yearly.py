import pytest
from pyspark.sql import functions as F

from lienspark.operators.quality import DataTestFailure
from lienspark.plans.explore import explore
from lienspark.plans.yearly import run_year
from lienspark.settings import fresh_path
from lienspark.sinks.lake import write_rates
from lienspark_checks import fixtures
from lienspark_checks.job_queries import write_register
from conftest import SF_DIR


def run(spark, place, register, year=2024):
    rates = f"{place}/rates"
    write_rates(fixtures.rates(spark, SF_DIR), rates)
    table = f"loans_{place.split('/')[-2]}"
    return table, run_year(
        spark,
        year,
        register,
        rates,
        f"{place}/lake",
        table,
        location=f"{place}/table",
        base=table,
        marts_root=f"{place}/marts",
    )


@pytest.fixture
def place(spark):
    return fresh_path(spark, "run")


def test_two_years_and_one_again(spark, place):
    register = write_register(spark, SF_DIR, all_states=True)
    originated = fixtures.originated(spark, SF_DIR).count()
    for year in (2023, 2024, 2023):
        table, names = run(spark, place, register, year)
    per_year = spark.table(table).groupBy("data_year").count().collect()
    assert {tuple(row) for row in per_year} == {(2023, originated), (2024, originated)}
    summary = spark.table(names["prd_risk_summary"])
    assert summary.agg(F.sum("loan_count")).first()[0] == 2 * originated
    ids = spark.table(table).agg(F.count_distinct("id"), F.count("*")).first()
    assert ids[0] == ids[1]
    assert spark.table(table).where("activity_year = data_year").isEmpty()


def test_nothing_originated_stops_before_enrichment(spark, place):
    register = write_register(spark, SF_DIR)
    none = f"{place}/none"
    (
        spark.read.option("sep", "|")
        .option("header", True)
        .csv(register)
        .withColumn("action_taken", F.lit("3"))
        .write.option("sep", "|")
        .option("header", True)
        .csv(none)
    )
    table, names = run(spark, place, none)
    assert names is None
    assert not spark.catalog.tableExists(table)


def test_loans_without_a_state_stop_at_the_gate(spark, place):
    with pytest.raises(DataTestFailure, match="state_code"):
        run(spark, place, write_register(spark, SF_DIR))


def test_missing_register_fails(spark, place):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run(spark, place, f"{place}/nowhere")


def test_explore_frames(spark):
    from lienspark.sources.register import read_register_inferred

    register = read_register_inferred(spark, write_register(spark, SF_DIR))
    frames = explore(register, fixtures.rates(spark, SF_DIR), keep=["k"], view="explored")
    total = frames["n_loans"].first().n_loans
    missing = frames["n_unmatched"].first().n_unmatched
    assert total == frames["loans"].count()
    assert spark.sql("SELECT count(*) FROM explored").first()[0] == total
    assert frames["unmatched"].count() == missing > 0
    assert frames["spread"].count() == total - missing
    amounts = [row.loan_amount for row in frames["high_rate_high_dti"].collect()]
    assert amounts == sorted(amounts, reverse=True) and amounts
    assert frames["top_states"].count() == 10
    newest = [row.activity_year for row in frames["newest_rates"].collect()]
    assert newest[0] == max(newest)

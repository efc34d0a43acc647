import pytest
from pyspark.sql import functions as F

from lienspark.operators import quality
from lienspark.operators.quality import unique_failures, unique_failures_in_files
from lienspark.operators.surrogate import add_surrogate_id, year_start
from lienspark.plans.dashboard import dashboard_frames, dashboard_rows, frames_from
from lienspark.plans.marts import build_marts, loan_fact
from lienspark.plans.results import CHOICES_SECONDS, DATA_SECONDS, Results, kept_choices, kept_dashboard, version
from lienspark.operators.summary import risk_summary
from lienspark.settings import fresh_path
from lienspark.sinks.generations import current_rows
from lienspark.sinks.warehouse import create_loan_table, replace_year, written_files
from lienspark.sources.seeds import builtin_seeds
from test_marts import as_rows, fact_rows, year_rows

STATES = ["California", "Texas"]


class Clock:
    now = 1_000_000.0

    def __call__(self):
        return self.now


@pytest.fixture
def built(spark):
    location = fresh_path(spark, "loans")
    table = f"loans_{location.split('/')[-2]}"
    create_loan_table(spark, table, location)
    replace_year(year_rows(spark, 90, 2024), table, 2024)
    options = {"base": table, "root": f"{location}_marts", "reproducible": True}
    return table, build_marts(spark, table, **options), options


@pytest.fixture
def asked(monkeypatch):
    """Which questions were really asked."""
    seen = []
    write = Results.answer

    def answer(self, question, arguments, tables, seconds, ask):
        return write(self, question, arguments, tables, seconds, lambda: seen.append(question) or ask())

    monkeypatch.setattr(Results, "answer", answer)
    return seen


def shown(frames):
    return {name: as_rows(frame) for name, frame in frames.items()}


def test_a_second_question_reads_no_source(spark, built, asked):
    table, names, _ = built
    results = Results(spark, fresh_path(spark, "results"), Clock())
    first = kept_dashboard(results, names, 2024, STATES)
    assert asked == ["dashboard", "sample"]
    plain = dashboard_frames(spark.table(names["prd_risk_summary"]), spark.table(names["prd_loan_sample"]), 2024, STATES)
    assert shown(first) == shown(plain)
    again = kept_dashboard(Results(spark, results.folder, results.clock), names, 2024, STATES[::-1])
    assert asked == ["dashboard", "sample"] and shown(again) == shown(plain)
    for frame in again.values():
        assert all(results.folder.removeprefix("file:") in file for file in frame.inputFiles())
    kept_dashboard(results, names, 2024, STATES[:1])
    assert asked == ["dashboard", "sample"] * 2


def test_answers_end(spark, built, asked):
    _, names, _ = built
    clock = Clock()
    results = Results(spark, fresh_path(spark, "results"), clock)
    kept_dashboard(results, names, 2024, STATES)
    choices = kept_choices(results, names)
    assert [r.data_year for r in choices["years"].collect()] == [2024]
    assert [r.state_name for r in choices["state_names"].collect()] == STATES
    clock.now += DATA_SECONDS - 1
    kept_dashboard(results, names, 2024, STATES)
    assert asked == ["dashboard", "sample", "years", "state_names"]
    clock.now += 2
    kept_dashboard(results, names, 2024, STATES)
    kept_choices(results, names)
    assert asked == ["dashboard", "sample", "years", "state_names", "dashboard", "sample"]
    clock.now += CHOICES_SECONDS
    kept_choices(results, names)
    assert asked[6:] == ["years", "state_names"]


def test_a_load_ends_the_answers(spark, built, asked):
    table, names, options = built
    results = Results(spark, fresh_path(spark, "results"), Clock())
    before = version(spark, table)
    assert version(spark, table) == before
    kept_dashboard(results, names, 2024, STATES)
    replace_year(year_rows(spark, 40, 2024), table, 2024)
    assert version(spark, table) != before
    build_marts(spark, table, year=2024, **options)
    loans = kept_dashboard(results, names, 2024, STATES)["kpis"].first().total_loans
    assert loans == 40 and asked == ["dashboard", "sample"] * 2


def test_an_answer_cut_off_is_not_found(spark, built, asked, monkeypatch):
    _, names, _ = built
    results = Results(spark, fresh_path(spark, "results"), Clock())
    with monkeypatch.context() as patched:
        patched.setattr("lienspark.plans.results.create_file", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept_dashboard(results, names, 2024, STATES)
    kept_dashboard(results, names, 2024, STATES)
    assert asked == ["dashboard", "dashboard", "sample"]


@pytest.mark.parametrize("year, states", [(2023, STATES), (2023, []), (1999, STATES), (2023, ["Nowhere"])])
def test_one_pass_gives_every_frame(spark, plan_of, year, states):
    rows = fact_rows(spark, 150).withColumn("loan_purpose", F.when(F.col("id") % 7 > 0, F.col("loan_purpose")))
    path = fresh_path(spark, "summary")
    odd = rows.withColumn("state_code", F.when(F.col("id") % 11 > 0, F.col("state_code")).otherwise("ZZ"))
    risk_summary(loan_fact(odd, builtin_seeds(spark))).write.parquet(path)
    summary = spark.read.parquet(path)
    grouped = dashboard_rows(summary, year, states)
    plan = plan_of(grouped).split("Physical Plan")[1].split("Initial Plan")[-1]
    assert plan.count("FileScan") == 1 and "EqualTo(data_year" in plan
    sample = summary.withColumn("income", F.lit(1))
    plain = dashboard_frames(summary, sample, year, states)
    found = frames_from(grouped)
    for name, frame in found.items():
        assert frame.columns == plain[name].columns
        assert as_rows(frame) == as_rows(plain[name]), name


# Ids in files


def in_files(spark, rows, files):
    path = fresh_path(spark, "ids")
    rows.repartition(files, "id").sortWithinPartitions("id").write.parquet(path)
    numbered = fresh_path(spark, "numbered")
    add_surrogate_id(spark.read.parquet(path).withColumnRenamed("id", "k"), year_start(2024)).write.parquet(numbered)
    return numbered


def test_intervals_find_what_grouping_finds(spark, monkeypatch):
    path = in_files(spark, spark.range(4_000), 9)
    rows = spark.read.parquet(path)
    grouped = []
    monkeypatch.setattr(quality, "unique_failures", lambda r, c: grouped.append(r) or unique_failures(r, c))
    assert unique_failures_in_files(rows, "id").isEmpty()
    assert [sorted(r.columns) for r in grouped] == [["id", "k"]], "asked for the schema alone"
    grouped.clear()
    low = rows.agg(F.min("id")).first()[0]
    doubles = spark.createDataFrame([(low + 5, 1), (low + 5, 2), (low + 900, 3), (None, 4), (None, 5)], "id long, k long")
    doubles.coalesce(1).write.mode("append").parquet(path)
    rows = spark.read.parquet(path)
    found = sorted(map(tuple, unique_failures_in_files(rows, "id").collect()))
    assert found == sorted(map(tuple, unique_failures(rows, "id").collect())) == [(low + 5, 3), (low + 900, 2)]
    (checked,) = grouped
    assert 1_000 < 4 * checked.count() < 8 * 4_000 / 2


def test_ids_in_any_order_are_grouped(spark, monkeypatch):
    monkeypatch.setattr(quality, "MOST_INTERVALS", 50)
    path = fresh_path(spark, "mixed")
    spark.range(1_000).select((F.xxhash64("id") % 700).alias("id")).repartition(3).write.parquet(path)
    rows = spark.read.parquet(path)
    assert sorted(unique_failures_in_files(rows, "id").collect()) == sorted(unique_failures(rows, "id").collect())
    assert unique_failures_in_files(rows.where("false"), "id").isEmpty()


def test_files_of_a_load(spark, built):
    table, _, _ = built
    files = written_files(spark, table, 2024).collect()
    assert sum(f.n_rows for f in files) == 90 and {f.state_code for f in files} == {"CA", "TX"}
    assert current_rows(spark, table).columns == spark.table(table).columns
    replace_year(year_rows(spark, 30, 2024).coalesce(1), table, 2024, batch_rows=4)
    files = written_files(spark, table, 2024).collect()
    assert max(f.n_rows for f in files) == 4 and sum(f.n_rows for f in files) == 30

import pytest
from pyspark.sql import functions as F

from lienspark.operators.lookups import describe
from lienspark.operators.quality import (
    DataTestFailure,
    accepted_values_failures,
    not_null_failures,
    require_none,
    unique_failures,
)
from lienspark.operators import sampling
from lienspark.operators.sampling import merged_rows, random_rows, random_rows_by
from lienspark.operators.summary import (
    heatmap,
    kpis,
    purpose_breakdown,
    risk_hierarchy,
    risk_summary,
)
from lienspark.operators.surrogate import year_start
from lienspark.plans import marts
from lienspark.plans.dashboard import dashboard_frames, filter_choices, kept, selected
from lienspark.plans.documented import in_states
from lienspark.plans.enrich import enrich
from lienspark.plans.marts import (
    build_marts,
    loan_fact,
    loan_sample,
    sample_of,
    segmented,
    summarise,
)
from lienspark.schemas import FACT_COLUMNS
from lienspark.settings import fresh_path
from lienspark.sinks.warehouse import create_loan_table, replace_year
from lienspark.sources.seeds import builtin_seeds

SUMMARY = """
    data_year int, state_code string, state_name string, risk_segment string,
    loan_purpose_name string, loan_count bigint, total_loan_amount double,
    sum_interest_rate double
"""


def summary(spark):
    return spark.createDataFrame(
        [
            (2023, "CA", "California", "High", "Refinancing", 3, 3e6, 18.0),
            (2023, "CA", "California", "High", None, 1, 1e6, None),
            (2023, "TX", "Texas", "Low", "Refinancing", 4, 4e6, 20.0),
            (2023, None, None, "Low", "Refinancing", 9, 9e6, 9.0),
            (2024, "CA", "California", "Low", "Refinancing", 5, 5e6, 5.0),
        ],
        SUMMARY,
    )


# Lookups and benchmark


def test_unknown_codes_get_no_name_and_rows_stay(spark):
    rows = [(1, 1, 31, 1, 1, "CA"), (2, 0, 0, 0, 0, "NA"), (3, None, None, None, None, None)]
    loans = spark.createDataFrame(
        rows,
        "id int, loan_type int, loan_purpose int, occupancy_type int, lien_status int, "
        "state_code string",
    )
    found = {row.id: row for row in describe(loans, builtin_seeds(spark)).collect()}
    assert len(found) == 3
    assert found[1].loan_purpose_name == "Refinancing" and found[1].state_name == "California"
    for key in (2, 3):
        assert found[key].loan_type_name is None and found[key].state_name is None


def test_enrichment_broadcasts_and_never_shuffles_loans(spark, plan_of):
    loans = spark.range(10).selectExpr(
        "cast(2000 + id % 2 as int) activity_year", "1d loan_amount", "1d property_value",
        "'36' debt_to_income_ratio", "5d interest_rate",
    )
    rates = spark.range(10).selectExpr(
        "cast(make_date(2000 + id * 2, 1, 1) as timestamp) observation_date", "2d fed_rate"
    )
    frame = enrich(loans, rates)
    assert frame.where("yr = 2000 AND interest_rate_spread = 3").count() == 5
    with_plan = plan_of(frame)
    assert "BroadcastHashJoin" in with_plan and "SortMergeJoin" not in with_plan
    left, right = with_plan.split("Physical Plan")[1].split("BroadcastExchange")
    assert "Exchange" not in left and "hashpartitioning" in right


def test_fact_is_one_pass_without_shuffle(spark, plan_of):
    table, _ = loan_table(spark, fact_rows(spark, 10))
    plan = plan_of(loan_fact(spark.table(table), builtin_seeds(spark)))
    physical = plan.split("Physical Plan")[1]
    assert physical.count("BroadcastHashJoin") == 5
    assert "hashpartitioning" not in physical
    assert FACT_COLUMNS == loan_fact(spark.table(table), builtin_seeds(spark)).columns[:-1]


# Summary and dashboard


def test_kpis(spark):
    row = kpis(selected(summary(spark), 2023, ["California", "Texas"])).first()
    assert tuple(row) == (8, 8.0, 38.0 / 8, 50.0)


def test_kpis_of_nothing(spark):
    assert tuple(kpis(selected(summary(spark), 2023, [])).first()) == (0, 0.0, 0.0, 0.0)


def test_hierarchy_tells_missing_purpose_from_total(spark):
    rows = risk_hierarchy(selected(summary(spark), 2023, ["California", "Texas"])).collect()
    assert {tuple(row) for row in rows} == {
        ("High", "Refinancing", 3, 0),
        ("High", None, 1, 0),
        ("High", None, 4, 1),
        ("Low", "Refinancing", 4, 0),
        ("Low", None, 4, 1),
    }


def test_purpose_breakdown_leaves_missing_purpose_out(spark):
    rows = purpose_breakdown(selected(summary(spark), 2023, ["California"])).collect()
    assert [tuple(row) for row in rows] == [("Refinancing", "High", 3)]


def test_heatmap_shows_all_states(spark):
    rows = {tuple(row) for row in heatmap(summary(spark), 2023).collect()}
    assert rows == {("CA", 4), ("TX", 4), (None, 9)}


def test_choices_and_frames(spark):
    with kept(summary(spark)) as rows:
        assert rows.is_cached
        choices = filter_choices(rows)
        assert [r.data_year for r in choices["years"].collect()] == [2024, 2023]
        assert [r.state_name for r in choices["state_names"].collect()] == ["California", "Texas"]
        frames = dashboard_frames(rows, rows, 2024, ["California"])
        assert frames["kpis"].first().total_loans == 5
        assert frames["heatmap"].count() == 1
        assert frames["income_vs_spread"].count() == 1
    assert not rows.is_cached


def test_empty_selection_gives_empty_frames(spark):
    frames = dashboard_frames(summary(spark), summary(spark), 2023, [])
    for name in ("risk_hierarchy", "income_vs_spread", "purpose_breakdown"):
        assert frames[name].isEmpty()


def test_ratio_of_a_segment_is_one_or_zero(spark):
    fact = loan_fact(fact_rows(spark, 50), builtin_seeds(spark))
    ratios = risk_summary(fact).select("risk_segment", "high_risk_ratio").distinct().collect()
    assert {tuple(row) for row in ratios} <= {("High", 1.0), ("Medium", 0.0), ("Low", 0.0)}


# Sample


def sample_input(spark, n, partitions=8):
    return spark.range(0, n, 1, partitions).withColumn("v", F.col("id") * 2)


@pytest.mark.parametrize("n", [1, 10, 100, 5000, 19_999, 20_000, 30_000])
def test_sample_equals_a_full_sort(spark, n):
    rows = sample_input(spark, 20_000)
    drawn = [r.id for r in random_rows(rows, n, reproducible=True).collect()]
    full = rows.orderBy(F.md5(F.col("id").cast("string")), "id").limit(n)
    assert drawn == [r.id for r in full.collect()]
    assert len(drawn) == min(n, 20_000)


def test_sample_of_equal_ids_is_whole(spark):
    rows = spark.range(0, 9_000, 1, 8).select(
        F.when(F.col("id") < 3_000, 7).otherwise(F.col("id")).alias("id")
    )
    drawn = random_rows(rows, 4_000, reproducible=True)
    full = rows.orderBy(F.md5(F.col("id").cast("string")), "id").limit(4_000)
    assert sorted(drawn.collect()) == sorted(full.collect())


def test_seed_repeats_over_any_partitioning(spark):
    def draw(partitions, seed):
        rows = sample_input(spark, 5_000, partitions)
        return [r.id for r in random_rows(rows, 100, seed=seed).collect()]

    assert draw(8, 1) == draw(3, 1)
    assert draw(8, 1) != draw(8, 2)
    assert draw(8, None) != draw(8, None)


def test_sample_is_uniform(spark):
    drawn = random_rows(sample_input(spark, 100_000), 10_000, seed=3)
    tenths = drawn.groupBy((F.col("id") / 10_000).cast("int")).count().collect()
    assert len(tenths) == 10
    assert all(880 < row["count"] < 1120 for row in tenths)


def test_sample_sorts_few_rows(spark, plan_of):
    frame = random_rows(sample_input(spark, 200_000), 100, reproducible=True)
    plan = plan_of(frame)
    assert "TakeOrderedAndProject" in plan
    assert "SinglePartition" not in plan.split("Physical Plan")[1].split("Subquery")[0]
    hashed = F.md5(F.col("id").cast("string"))
    survivors = sample_input(spark, 200_000).where(F.substring(hashed, 1, 2) == "00").count()
    assert 100 <= survivors < 1600


# Data tests


def test_unique(spark):
    rows = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "id int")
    assert [tuple(r) for r in unique_failures(rows, "id").collect()] == [(2, 2)]
    assert unique_failures(rows.where("id = 1"), "id").isEmpty()


def test_not_null(spark):
    rows = spark.createDataFrame([(1, None), (None, None), (3, 1)], "a int, b int")
    found = {tuple(r) for r in not_null_failures(rows, ["a", "b"]).collect()}
    assert found == {("a", 1), ("b", 2)}
    assert not_null_failures(rows.where("b = 1"), ["a", "b"]).isEmpty()


def test_accepted_values(spark):
    rows = spark.createDataFrame([("x", 1), ("y", 2), (None, 9), ("y", 1)], "a string, b int")
    accepted = {"a": ["x"], "b": [1, 2]}
    found = {tuple(r) for r in accepted_values_failures(rows, accepted).collect()}
    assert found == {("a", "y", 2), ("b", "9", 1)}
    assert accepted_values_failures(rows.where("a = 'x' OR a IS NULL AND b < 3"), accepted).isEmpty()


def test_gate(spark):
    rows = spark.createDataFrame([(1,), (1,)], "id int")
    with pytest.raises(DataTestFailure, match="unique id.*'n_rows': 2"):
        require_none(unique_failures(rows, "id"), "unique id")
    require_none(unique_failures(rows.limit(1), "id"), "unique id")


# Build


def fact_rows(spark, n, id_of="id"):
    return spark.range(n).selectExpr(
        f"cast({id_of} as bigint) id", "cast(2023 as int) activity_year",
        "concat('L', id % 5) lei", "'06001' county_code", "'06001000100' census_tract",
        "cast(1 + id % 4 as int) loan_type", "cast(1 + id % 5 as int) loan_purpose",
        "cast(1000 * id as double) loan_amount", "cast(5 + id % 3 as double) interest_rate",
        "100000d property_value", "cast(1 as int) occupancy_type", "cast(1 as int) lien_status",
        "cast(id % 1100 as bigint) income", "'25-34' applicant_age",
        "id / 100 loan_to_value_ratio", "0.4d debt_to_income_numeric", "6d mkt_benchmark",
        "cast(id % 3 - 1 as double) interest_rate_spread", "cast(null as timestamp) loaded_at",
        "cast(2023 as int) data_year", "if(id % 2 = 0, 'CA', 'TX') state_code",
    )


def loan_table(spark, rows):
    location = fresh_path(spark, "loans")
    table = f"loans_{location.split('/')[-2]}"
    create_loan_table(spark, table, location)
    replace_year(rows, table, 2023)
    return table, location


def test_build(spark):
    table, location = loan_table(spark, fact_rows(spark, 200))
    names = build_marts(spark, table, base=table, root=f"{location}_marts", n_sample=20, seed=1)
    assert spark.table(names["prd_risk_summary"]).agg(F.sum("loan_count")).first()[0] == 200
    assert spark.table(names["prd_loan_sample"]).count() == 20
    assert spark.table(names["fct_loan_risk"]).count() == 200
    assert spark.table(names["state_mapping"]).count() == 56
    assert "mart_updated_at" in spark.table(names["fct_loan_risk"]).columns
    other = spark.newSession()
    frame = loan_fact(spark.table(table), builtin_seeds(spark)).drop("mart_updated_at")
    lasting = other.table(names["fct_loan_risk"]).drop("mart_updated_at")
    assert lasting.dtypes == frame.dtypes
    assert sorted(lasting.collect()) == sorted(frame.collect())
    assert other.table(names["stg_loans"]).count() == 200
    again = build_marts(
        spark, table, base=table, root=f"{location}_marts", n_sample=20, seed=1, dti_scale=100
    )
    assert again == names
    scaled = loan_fact(spark.table(table), builtin_seeds(spark), 100).drop("mart_updated_at")
    assert sorted(other.table(names["fct_loan_risk"]).drop("mart_updated_at").collect()) == sorted(
        scaled.collect()
    )


def two_year_table(spark, n=120):
    table, location = loan_table(spark, fact_rows(spark, n))
    replace_year(year_rows(spark, n + 30, 2024), table, 2024)
    return table, f"{location}_marts"


def year_rows(spark, n, year, shift=0):
    """Loans of a year, with ids of its range."""
    ids = F.col("id") + year_start(year) + 1
    return fact_rows(spark, n).withColumns(
        {"id": ids, "data_year": F.lit(year), "loan_amount": F.col("loan_amount") + shift}
    )


def as_rows(frame):
    return sorted((tuple(str(v) for v in row) for row in frame.collect()))


def test_one_year_is_refreshed_and_the_others_stay(spark):
    table, root = two_year_table(spark)
    options = {"n_sample": 70, "reproducible": True}
    names = build_marts(spark, table, base=table, root=root, **options)
    replace_year(year_rows(spark, 90, 2024, 7), table, 2024)
    again = build_marts(spark, table, base=table, root=root, year=2024, **options)
    assert again == names
    whole = build_marts(spark, table, base=f"{table}_whole", root=f"{root}_whole", **options)
    for model in ("prd_risk_summary", "prd_loan_sample", "summary_parts", "sample_parts"):
        assert as_rows(spark.table(names[model])) == as_rows(spark.table(whole[model])), model
    assert spark.table(names["fct_loan_risk"]).count() == 210
    seeds = builtin_seeds(spark)
    fact = loan_fact(spark.table(table), seeds)
    assert as_rows(spark.table(names["prd_loan_sample"])) == as_rows(loan_sample(fact, 70, reproducible=True))
    replace_year(year_rows(spark, 0, 2024), table, 2024)
    build_marts(spark, table, base=table, root=root, year=2024, **options)
    years = {row.data_year for row in spark.table(names["prd_risk_summary"]).collect()}
    assert years == {2023}


def test_a_refresh_reads_one_year(spark, monkeypatch, plan_of):
    table, root = two_year_table(spark)
    build_marts(spark, table, base=table, root=root)
    plans = []
    keep = marts._refresh
    monkeypatch.setattr(marts, "_refresh", lambda rows, *more: plans.append(rows) or keep(rows, *more))
    build_marts(spark, table, base=table, root=root, year=2024)
    assert len(plans) == 2
    for rows in plans:
        (files,) = {file.split("data_year=")[1][:4] for file in rows.inputFiles() if "data_year=" in file}
        assert files == "2024"


def test_a_failed_refresh_keeps_parts_and_tables(spark, monkeypatch):
    table, root = two_year_table(spark)
    names = build_marts(spark, table, base=table, root=root, reproducible=True)
    models = ("prd_risk_summary", "summary_parts", "sample_parts")
    before = [as_rows(spark.table(names[m])) for m in models]
    replace_year(year_rows(spark, 10, 2024), table, 2024)
    monkeypatch.setattr("lienspark.plans.marts.SEGMENT_VALUES", {"risk_segment": ["Nothing"]})
    with pytest.raises(DataTestFailure, match="summary accepted values"):
        build_marts(spark, table, base=table, root=root, year=2024, reproducible=True)
    assert [as_rows(spark.table(names[m])) for m in models] == before


@pytest.mark.parametrize(("broken", "message"), [("twice", "unique id"), ("of another year", "unique id"), ("state", "not null")])
def test_a_refresh_tests_its_year(spark, broken, message):
    table, root = two_year_table(spark)
    build_marts(spark, table, base=table, root=root)
    rows = year_rows(spark, 20, 2024)
    if broken == "twice":
        rows = rows.unionAll(rows.limit(1))
    elif broken == "of another year":
        rows = rows.withColumn("id", F.col("id") - year_start(2024) - 1)
    else:
        rows = rows.withColumn("state_code", F.lit(None).cast("string"))
    replace_year(rows, table, 2024)
    with pytest.raises(DataTestFailure, match=message):
        build_marts(spark, table, base=table, root=root, year=2024)


@pytest.mark.parametrize("groups", [sampling.BROADCAST_GROUPS, 0])
def test_samples_of_groups_merge_to_the_sample_of_all(spark, monkeypatch, groups):
    monkeypatch.setattr(sampling, "BROADCAST_GROUPS", groups)
    rows = spark.range(0, 30_000, 1, 8).withColumn("g", F.when(F.col("id") < 20_000, 1).when(F.col("id") < 20_050, 2))
    parts = random_rows_by(rows, "g", 300, reproducible=True)
    sizes = {row.g: row["count"] for row in parts.groupBy("g").count().collect()}
    assert sizes == {1: 300, 2: 50, None: 300}
    whole = random_rows(rows, 300, reproducible=True).collect()
    assert merged_rows(parts, 300).collect() == whole


@pytest.mark.parametrize("groups", [sampling.BROADCAST_GROUPS, 0])
@pytest.mark.parametrize("n", [1, 300, 9_000, 19_999, 20_000, 2**31 - 1])
def test_large_samples_are_those_of_the_full_order(spark, monkeypatch, groups, n):
    monkeypatch.setattr(sampling, "BROADCAST_GROUPS", groups)
    monkeypatch.setattr(sampling, "RANKED_ROWS", 0)
    monkeypatch.setattr(sampling, "EDGE_DIGITS", 2)
    rows = spark.range(0, 30_000, 1, 8).withColumn("g", F.when(F.col("id") < 20_000, 1).when(F.col("id") < 20_050, 2))
    parts = random_rows_by(rows, "g", n, reproducible=True)
    assert parts.columns == ["id", "g", "draw"]
    wanted = {}
    for row in rows.withColumn("draw", F.md5(F.col("id").cast("string"))).collect():
        wanted.setdefault(row.g, []).append((row.draw, row.id))
    found = {}
    for row in parts.collect():
        found.setdefault(row.g, []).append((row.draw, row.id))
    assert {g: sorted(own) for g, own in found.items()} == {g: sorted(own)[:n] for g, own in wanted.items()}
    order = sorted(pair for own in wanted.values() for pair in own)
    assert [row.id for row in merged_rows(parts, n).collect()] == [i for _, i in order[:n]]


@pytest.mark.parametrize("n", [3, 500, 1_500])
def test_samples_of_equal_and_missing_ids(spark, monkeypatch, n):
    monkeypatch.setattr(sampling, "RANKED_ROWS", 0)
    rows = spark.range(0, 2_000, 1, 8).select(F.lit(2024).alias("g"), F.when(F.col("id") % 2 == 0, F.col("id") % 6).alias("id"))
    parts = random_rows_by(rows, "g", n, reproducible=True)
    draws = sorted(row[0] for row in rows.select(F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))).collect())
    assert sorted(row.draw for row in parts.collect()) == draws[:n]
    assert merged_rows(parts, n).count() == n
    assert random_rows_by(rows.where("false"), "g", n).isEmpty() and merged_rows(parts.where("false"), n).isEmpty()


def test_a_sample_of_all_rows_is_not_brought_to_one_task(spark, plan_of):
    rows = spark.range(0, 5_000, 1, 8).withColumn("g", F.lit(2024))
    parts = random_rows_by(rows, "g", 2**31 - 1)
    assert "Window" not in plan_of(parts)
    assert "Limit" not in plan_of(merged_rows(parts, 2**31 - 1))


def test_ranked_rows_are_those_where_the_sample_ends(spark, monkeypatch, plan_of):
    monkeypatch.setattr(sampling, "RANKED_ROWS", 1_000)
    rows = spark.range(0, 50_000, 1, 8).withColumn("g", F.lit(2024))
    plan = plan_of(random_rows_by(rows, "g", 20_000)).split("== Physical Plan ==")[1]
    assert "Window" in plan and "Union" in plan and "StartsWith" in plan.replace("startswith", "StartsWith")


@pytest.mark.parametrize(("n_rows", "least", "most"), [(300_000, 9, 1_000), (20, 1, 1)])
def test_stored_parts_have_as_many_files_as_they_need(spark, monkeypatch, n_rows, least, most):
    monkeypatch.setitem(marts.GATHER_SETTINGS, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    table = f"parts_{fresh_path(spark, 'p').split('/')[-2]}"
    rows = spark.range(0, n_rows, 1, 8).select("id", F.md5(F.col("id").cast("string")).alias("draw"), F.lit(2024).alias("data_year"))
    types = {"id": "bigint", "draw": "string", "data_year": "int"}
    stored = marts._refresh(rows, table, types, None, lambda written: None)
    assert stored.count() == n_rows and least <= len(stored.inputFiles()) <= most


def test_failed_build_keeps_the_old_tables(spark, monkeypatch):
    table, location = loan_table(spark, fact_rows(spark, 40))
    names = build_marts(spark, table, base=table, root=f"{location}_marts")
    replace_year(fact_rows(spark, 60), table, 2023)
    monkeypatch.setattr("lienspark.plans.marts.SEGMENT_VALUES", {"risk_segment": ["Nothing"]})
    with pytest.raises(DataTestFailure, match="summary accepted values"):
        build_marts(spark, table, base=table, root=f"{location}_marts")
    spark.catalog.refreshTable(names["prd_risk_summary"])
    assert spark.table(names["prd_risk_summary"]).agg(F.sum("loan_count")).first()[0] == 40


def test_summary_by_code_equals_summary_of_the_fact(spark):
    rows, seeds = fact_rows(spark, 300), builtin_seeds(spark)
    by_code = summarise(segmented(rows), seeds)
    whole = risk_summary(loan_fact(rows, seeds))
    assert by_code.dtypes == whole.dtypes
    key = lambda r: tuple(map(str, r[:5]))
    for a, b in zip(sorted(by_code.collect(), key=key), sorted(whole.collect(), key=key), strict=True):
        assert a[:7] == b[:7] and a.high_risk_ratio == b.high_risk_ratio
        assert (a.sum_interest_rate, a.avg_rate_spread) == pytest.approx(
            (b.sum_interest_rate, b.avg_rate_spread)
        )


def test_sample_and_summary_meet_the_lookups_after_they_shrink(spark, plan_of):
    loans, seeds = segmented(fact_rows(spark, 100)), builtin_seeds(spark)
    summary = plan_of(summarise(loans, seeds)).split("Optimized Logical Plan")[1].split("== Physical")[0]
    assert summary.index("Join") < summary.rindex("Aggregate")
    sample = plan_of(sample_of(loans, seeds, 10)).split("Optimized Logical Plan")[1].split("== Physical")[0]
    assert sample.index("Join") < sample.index("GlobalLimit")


def test_filters_reach_the_summary_files(spark, plan_of):
    table, location = loan_table(spark, fact_rows(spark, 50))
    names = build_marts(spark, table, base=table, root=f"{location}_marts")
    chosen = selected(spark.table(names["prd_risk_summary"]), 2023, ["California", "Texas"])
    plan = plan_of(chosen.select("loan_count"))
    assert "EqualTo(data_year,2023)" in plan and "In(state_name, [California,Texas])" in plan
    assert "ReadSchema: struct<data_year:int,state_name:string,loan_count:bigint>" in plan


def test_state_names_prune_the_warehouse(spark, plan_of):
    table, _ = loan_table(spark, fact_rows(spark, 50))
    seeds = builtin_seeds(spark)
    fact = loan_fact(spark.table(table), seeds)
    path = fresh_path(spark, "states")
    seeds["state_mapping"].write.parquet(path)
    chosen = in_states(fact, spark.read.parquet(path), 2023, ["California"])
    assert chosen.count() == 25
    plan = plan_of(chosen).split("Physical Plan")[1]
    assert "LeftSemi" in plan
    pruned = plan.split("PartitionFilters: [")[1]
    assert "data_year" in pruned and "dynamicpruning" in pruned


def test_a_state_name_with_several_codes(spark):
    states = spark.createDataFrame([("CA", "West"), ("OR", "West"), ("TX", "South")], "state_code string, state_name string")
    loans = spark.createDataFrame([(i, 2023, s) for i, s in enumerate(["CA", "OR", "TX", "OR", None])], "id int, data_year int, state_code string")
    assert sorted(r.id for r in in_states(loans, states, 2023, ["West"]).collect()) == [0, 1, 3]
    assert sorted(r.id for r in in_states(loans, states, 2023, ["West", "South", "None"]).collect()) == [0, 1, 2, 3]


@pytest.mark.parametrize(
    ("broken", "message"),
    [
        ("state", "source not null"),
        ("id", "fact not null"),
        ("twice", "fact unique id"),
    ],
)
def test_failing_test_stops_the_build(spark, broken, message):
    rows = fact_rows(spark, 50, "id % 10" if broken == "twice" else "id")
    if broken == "state":
        rows = rows.withColumn("state_code", F.lit(None).cast("string"))
    if broken == "id":
        rows = rows.withColumn("id", F.lit(None).cast("bigint"))
    table, location = loan_table(spark, rows)
    with pytest.raises(DataTestFailure, match=message):
        build_marts(spark, table, base=table, root=f"{location}_marts")
    assert not spark.catalog.tableExists(f"{table}_prod.prd_risk_summary")


def test_repeated_seed_stops_the_build(spark):
    table, location = loan_table(spark, fact_rows(spark, 5))
    seeds = builtin_seeds(spark)
    seeds["loan_type"] = seeds["loan_type"].unionAll(seeds["loan_type"])
    with pytest.raises(DataTestFailure, match="unique loan_type"):
        build_marts(spark, table, seeds, base=table, root=f"{location}_marts")


def test_sample_rule(spark):
    fact = loan_fact(fact_rows(spark, 1200), builtin_seeds(spark))
    drawn = loan_sample(fact, 5_000, reproducible=True)
    assert drawn.where("income <= 0 OR income >= 1000 OR interest_rate_spread = 0").isEmpty()
    expected = fact.where(
        "income > 0 AND income < 1000 AND interest_rate_spread <> 0"
    ).count()
    assert drawn.count() == expected

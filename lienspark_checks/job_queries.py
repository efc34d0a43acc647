"""Queries that write in the shared folder and read back what they wrote."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.operators.lookups import describe
from lienspark.operators.quality import (
    DataTestFailure,
    not_null_failures,
    require_none,
    unique_failures_in_files,
)
from lienspark.operators.summary import kpis
from lienspark.operators.surrogate import add_surrogate_id, year_start
from lienspark.plans.dashboard import dashboard_frames, dashboard_rows, frames_from, kept, selected
from lienspark.plans.enrich import enrich_year
from lienspark.plans.explore import explore
from lienspark.plans.ingest import ingest_loans
from lienspark.plans.load import load_year
from lienspark.plans.marts import build_marts, loan_sample
from lienspark.plans.results import Results, kept_dashboard
from lienspark.plans.yearly import run_year
from lienspark.schemas import FACT_COLUMNS, REGISTER_COLUMNS, REGISTER_TYPES
from lienspark.settings import fresh_path, session_conf
from lienspark.sinks.curved import RANGES as RANGES_FOLDER
from lienspark.sinks.curved import read_curved, write_curved
from lienspark.sinks.lake import publish_year, write_by_state, write_clustered, write_rates
from lienspark.sinks.warehouse import create_loan_table, partition_keys, written_files
from lienspark.sources.lake import input_present, read_loans, read_rates, read_staging
from lienspark.sources.register import read_register, read_register_inferred
from lienspark.sources.seeds import builtin_seeds, read_seeds
from lienspark_checks import fixtures
from lienspark_checks.oracle import after
from lienspark_checks.registry import registered
from lienspark_checks.report_queries import SUMMARY_SQL, rounded_summary, summary_of
from lienspark_checks.step_queries import (
    EXPLORE_JOINED_SQL,
    EXPLORE_SQL,
    HIGH_DTI_SQL,
    STATE_LIST,
    STATES,
    YEAR,
    rounded,
    rounded_sql,
    with_date,
)

RUN_YEAR = 2024


def fresh_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A new table name and its place in the shared folder."""
    location = fresh_path(spark, name)
    return f"{name}_{location.split('/')[-2]}", location


def write_register(spark: SparkSession, sf_dir: str, all_states: bool = False) -> str:
    """The register as the delimited text the pipeline starts from."""
    loans = fixtures.register(spark, sf_dir, all_states)
    name = "register_text_all_states" if all_states else "register_text"
    return fixtures.folder(
        spark, sf_dir, name, loans.write.option("sep", "|").option("header", True).csv
    )


# Text and Parquet sources


@registered(
    "src1_read_register",
    after(f"SELECT CAST(k AS VARCHAR) AS k, {', '.join(REGISTER_COLUMNS)} FROM register"),
)
def src1(spark, sf_dir):
    return read_register(spark, write_register(spark, sf_dir)).select("k", *REGISTER_COLUMNS)


@registered(
    "src2_read_register_inferred",
    after(
        "SELECT CAST(k AS INTEGER) AS k, CAST(activity_year AS INTEGER) AS activity_year, "
        "CAST(action_taken AS INTEGER) AS action_taken, interest_rate FROM register"
    ),
)
def src2(spark, sf_dir):
    return read_register_inferred(spark, write_register(spark, sf_dir)).select(
        F.col("k").cast("int").alias("k"), "activity_year", "action_taken", "interest_rate"
    )


def written_loans(spark: SparkSession, sf_dir: str) -> str:
    loans = fixtures.originated(spark, sf_dir)
    return fixtures.folder(spark, sf_dir, "loans", lambda path: write_by_state(loans, path))


@registered("src3_read_loans", after(f"SELECT k, {', '.join(REGISTER_COLUMNS)} FROM loans"))
def src3(spark, sf_dir):
    return read_loans(spark, written_loans(spark, sf_dir)).select("k", *REGISTER_COLUMNS)


@registered(
    "src4_read_rates",
    after("SELECT CAST(observation_date AS DATE) AS observation_date, fed_rate FROM rates"),
)
def src4(spark, sf_dir):
    path = fresh_path(spark, "rates")
    write_rates(fixtures.rates(spark, sf_dir), path)
    return with_date(read_rates(spark, path))


# Sinks

NOT_COLORADO = "NOT state_code <=> 'CO'"
STATE_TOTALS = (
    "count(*) AS n_loans, CAST(sum(loan_amount) AS BIGINT) AS amount, "
    "count(interest_rate) AS n_rates"
)


def state_totals(loans: DataFrame, *keys: str) -> DataFrame:
    return loans.groupBy(*keys).agg(
        F.count("*").alias("n_loans"),
        F.sum("loan_amount").cast("bigint").alias("amount"),
        F.count("interest_rate").alias("n_rates"),
    )


@registered(
    "snk1_write_by_state",
    after(f"SELECT state_code, {STATE_TOTALS} FROM loans GROUP BY 1"),
)
def snk1(spark, sf_dir):
    return state_totals(read_loans(spark, written_loans(spark, sf_dir)), "state_code")


@registered(
    "snk2_publish_year",
    after(
        f"SELECT state_code, {STATE_TOTALS} FROM loans "
        "WHERE state_code IS DISTINCT FROM 'CO' GROUP BY 1"
    ),
)
def snk2(spark, sf_dir):
    """Publishing again removes a state the second version no longer has."""
    root = fresh_path(spark, "published")
    loans = fixtures.originated(spark, sf_dir)
    publish_year(loans, root, RUN_YEAR)
    publish_year(loans.where(NOT_COLORADO), root, RUN_YEAR)
    return state_totals(read_loans(spark, f"{root}/{RUN_YEAR}"), "state_code")


@registered(
    "snk4_replace_year",
    after(
        f"SELECT CAST(1997 AS INTEGER) AS data_year, state_code, {STATE_TOTALS} FROM loans "
        "WHERE state_code IS DISTINCT FROM 'CO' GROUP BY 2 UNION ALL "
        f"SELECT CAST(1998 AS INTEGER), state_code, {STATE_TOTALS} FROM loans GROUP BY 2"
    ),
)
def snk4(spark, sf_dir):
    """Two years loaded, one of them again without a state."""
    table, location = fresh_table(spark, "replaced")
    staging = read_staging(spark, written_loans(spark, sf_dir))
    load_year(staging, table, 1997, location=location, require_state=False)
    load_year(staging, table, 1998, require_state=False)
    load_year(staging.where(NOT_COLORADO), table, 1997, require_state=False)
    return state_totals(spark.table(table), "data_year", "state_code")


@registered(
    "snk4_failed_load",
    after(
        f"SELECT reader, CAST(1998 AS INTEGER) AS data_year, state_code, {STATE_TOTALS} FROM loans, "
        "(VALUES ('after failure'), ('before'), ('new entry')) AS readers(reader) GROUP BY 1, 3"
    ),
)
def snk4_failed(spark, sf_dir):
    """A load that fails in its tasks changes nothing, for whoever reads.

    The table is read by a frame made before the load, by another session after it,
    and by a new catalog entry on its folder.
    """
    table, location = fresh_table(spark, "kept_year")
    staging = read_staging(spark, written_loans(spark, sf_dir))
    load_year(staging, table, 1998, location=location, require_state=False)
    before = spark.table(table)
    broken = staging.where(NOT_COLORADO).withColumn(
        "loan_amount", F.expr("IF(k % 100 = 0, raise_error('broken row'), loan_amount)")
    )
    try:
        load_year(broken, table, 1998, require_state=False)
    except Exception as error:  # the load must fail, and only for this reason
        if "broken row" not in str(error):
            raise
    else:
        raise AssertionError("the broken load did not fail")
    create_loan_table(spark, f"{table}_again", location)
    readers = {
        "before": before,
        "after failure": spark.newSession().table(table),
        "new entry": spark.table(f"{table}_again"),
    }
    totals = [
        state_totals(rows, "data_year", "state_code").withColumn("reader", F.lit(reader))
        for reader, rows in readers.items()
    ]
    return reduce(DataFrame.unionByName, totals)


@registered(
    "snk8_batches",
    after(
        "SELECT state_code, count(*) AS n_loans, CAST(ceil(count(*) / 500.0) AS BIGINT) AS n_least, "
        "true AS in_bound FROM loans GROUP BY 1"
    ),
)
def snk8(spark, sf_dir):
    """No file holds more rows than a batch, and no row is lost."""
    table, location = fresh_table(spark, "batches")
    staging = read_staging(spark, written_loans(spark, sf_dir))
    load_year(staging, table, RUN_YEAR, location=location, batch_rows=500, require_state=False)
    files = spark.table(table).groupBy("state_code", F.input_file_name().alias("file")).count()
    return files.groupBy("state_code").agg(
        F.sum("count").alias("n_loans"),
        F.ceil(F.sum("count") / 500.0).alias("n_least"),
        ((F.max("count") <= 500) & (F.count("*") >= F.ceil(F.sum("count") / 500.0))).alias("in_bound"),
    )


@registered(
    "snk13_load_report",
    after("SELECT count(*) AS rows_removed, count(*) AS rows_loaded FROM loans"),
)
def snk13_load(spark, sf_dir):
    """The second load of a year removes what the first one loaded."""
    table, location = fresh_table(spark, "load_report")
    staging = read_staging(spark, written_loans(spark, sf_dir))
    load_year(staging, table, RUN_YEAR, location=location, require_state=False)
    return load_year(staging, table, RUN_YEAR, require_state=False)


@registered(
    "snk5_table_over_existing_data",
    after(
        f"SELECT CAST({RUN_YEAR} AS INTEGER) AS data_year, state_code, {STATE_TOTALS} "
        "FROM loans GROUP BY 2"
    ),
)
def snk5(spark, sf_dir):
    """A new catalog entry on a location that holds a year shows it."""
    table, location = fresh_table(spark, "first_entry")
    staging = read_staging(spark, written_loans(spark, sf_dir))
    load_year(staging, table, RUN_YEAR, location=location, require_state=False)
    create_loan_table(spark, f"{table}_again", location)
    return state_totals(spark.table(f"{table}_again"), "data_year", "state_code")


@registered(
    "snk12_lasting_fact_view",
    after("SELECT risk_segment, cost_category, count(*) AS n_loans FROM fact GROUP BY 1, 2", all_states=True),
)
def snk12(spark, sf_dir):
    """Another session of the same catalog asks the fact."""
    table, location = fresh_table(spark, "lasting")
    staging = read_staging(spark, written_staging(spark, sf_dir, all_states=True))
    load_year(staging, table, RUN_YEAR, location=location)
    names = build_marts(spark, table, base=table, root=f"{location}_marts")
    fact = spark.newSession().table(names["fct_loan_risk"])
    return fact.groupBy("risk_segment", "cost_category").agg(F.count("*").alias("n_loans"))


@registered("src8_input_present", "SELECT true AS written, false AS missing, true AS of_year, false AS of_other")
def src8(spark, sf_dir):
    path = written_loans(spark, sf_dir)
    dated = read_loans(spark, path).withColumn("data_year", F.lit(RUN_YEAR))
    found = (
        input_present(spark, path),
        input_present(spark, f"{path}-nowhere"),
        input_present(spark, dated, RUN_YEAR),
        input_present(spark, dated, RUN_YEAR - 1),
    )
    return spark.range(1).select(
        *(F.lit(v).alias(n) for n, v in zip(("written", "missing", "of_year", "of_other"), found))
    )


@registered(
    "src6_seeds_from_csv",
    after(
        "SELECT 'loan_purpose' AS lookup, CAST(id AS VARCHAR) AS key, description AS text FROM loan_purpose "
        "UNION ALL SELECT 'state_mapping', state_code, state_name FROM state_mapping "
        "UNION ALL SELECT 'named_loans', purpose.description, CAST(count(*) AS VARCHAR) FROM staged "
        "LEFT JOIN loan_purpose purpose ON staged.loan_purpose = purpose.id GROUP BY 2"
    ),
)
def src6(spark, sf_dir):
    """Lookups written as CSV, read again and joined to the loans."""
    folder = fresh_path(spark, "seeds")
    for name, rows in builtin_seeds(spark).items():
        rows.write.option("header", True).csv(f"{folder}/{name}.csv")
    seeds = read_seeds(spark, folder)
    rows = [
        seeds[name].select(
            F.lit(name).alias("lookup"),
            F.col(seeds[name].columns[0]).cast("string").alias("key"),
            F.col(seeds[name].columns[1]).alias("text"),
        )
        for name in ("loan_purpose", "state_mapping")
    ]
    named = describe(fixtures.staged(spark, sf_dir), seeds, ["loan_purpose"])
    counts = named.groupBy("loan_purpose_name").agg(F.count("*").cast("string").alias("text"))
    counts = counts.select(F.lit("named_loans").alias("lookup"), F.col("loan_purpose_name").alias("key"), "text")
    return rows[0].unionAll(rows[1]).unionAll(counts)


@registered(
    "snk6_partition_keys",
    after("SELECT DISTINCT state_code FROM loans WHERE state_code IS NOT NULL"),
)
def snk6(spark, sf_dir):
    return partition_keys(fixtures.originated(spark, sf_dir))


@registered(
    "snk7_clustered_layout",
    after(f"SELECT data_year, state_code, {STATE_TOTALS} FROM staged GROUP BY 1, 2"),
)
def snk7(spark, sf_dir):
    path = fresh_path(spark, "clustered")
    write_clustered(fixtures.staged(spark, sf_dir), path)
    return state_totals(spark.read.parquet(path), "data_year", "state_code")


RANGES = {
    "ltv": {"loan_to_value_ratio": (0.70, 0.74)},
    "spread": {"interest_rate_spread": (1.0, 1.4)},
    "both": {"loan_to_value_ratio": (0.80, None), "interest_rate_spread": (None, -1.5)},
}


def _range_sql(bounds: dict) -> str:
    ends = [(name, low, ">=") for name, (low, _) in bounds.items()]
    ends += [(name, high, "<=") for name, (_, high) in bounds.items()]
    return " AND ".join(f"{name} {sign} {value}" for name, value, sign in ends if value is not None)


@registered(
    "snk11_skip_by_ltv_and_spread",
    after(
        " UNION ALL ".join(
            f"SELECT '{name}' AS asked, data_year, count(*) AS n_loans, CAST(sum(loan_amount) AS BIGINT) AS amount "
            f"FROM staged WHERE {_range_sql(bounds)} GROUP BY 2"
            for name, bounds in RANGES.items()
        )
    ),
)
def snk11_ranges(spark, sf_dir):
    """Loans of ranges of LTV and spread, from the files that can hold them."""
    path = fresh_path(spark, "curved")
    write_curved(fixtures.staged(spark, sf_dir), path, files=128)

    def asked(name: str, bounds: dict) -> DataFrame:
        totals = state_totals(read_curved(spark, path, bounds), "data_year").drop("n_rates")
        return totals.withColumn("asked", F.lit(name))

    return reduce(DataFrame.unionByName, (asked(name, bounds) for name, bounds in RANGES.items()))


@registered(
    "snk11_file_ranges",
    after(
        "SELECT data_year, count(*) AS n_rows, min(loan_to_value_ratio) AS least_ltv, max(loan_to_value_ratio) AS greatest_ltv, "
        "round(min(interest_rate_spread), 6) AS least_spread, round(max(interest_rate_spread), 6) AS greatest_spread, "
        "true AS narrow FROM staged GROUP BY 1"
    ),
)
def snk11_files(spark, sf_dir):
    """The table of file ranges, by year; a file holds a part of its year's ranges."""
    path = fresh_path(spark, "curved")
    write_curved(fixtures.staged(spark, sf_dir), path, files=64)
    files = spark.read.parquet(f"{path}/{RANGES_FOLDER}")
    ltv, spread = (F.col(f"greatest_{n}") - F.col(f"least_{n}") for n in ("loan_to_value_ratio", "interest_rate_spread"))
    years = files.groupBy("data_year").agg(
        F.sum("n_rows").alias("n_rows"),
        F.min("least_loan_to_value_ratio").alias("least_ltv"),
        F.max("greatest_loan_to_value_ratio").alias("greatest_ltv"),
        F.round(F.min("least_interest_rate_spread"), 6).alias("least_spread"),
        F.round(F.max("greatest_interest_rate_spread"), 6).alias("greatest_spread"),
        (F.avg(F.coalesce(ltv, F.lit(0.0))) + F.avg(F.coalesce(spread, F.lit(0.0)))).alias("mean_width"),
        F.count("*").alias("n_files"),
    )
    whole = F.col("greatest_ltv") - F.col("least_ltv") + F.coalesce(F.col("greatest_spread") - F.col("least_spread"), F.lit(0.0))
    narrow = (F.col("n_files") < 4) | (F.col("mean_width") < whole * 0.75)
    return years.withColumn("narrow", narrow).drop("mean_width", "n_files")


# Ids that one task compares; it sorts them with the others' and groups them.
TASK_IDS = 400_000


def id_report(rows: DataFrame, others: DataFrame, start: int, reading: str) -> DataFrame:
    """Counts of one reading's ids, and of those that are alike in ``others``.

    Keys and ids are dealt to as many tasks as their number needs: left to the
    session they come to about as many tasks as there are cores, and what a task
    holds grows with the table.
    """
    tasks = max(1, -(-rows.count() // TASK_IDS))
    joined = rows.repartition(tasks, "k").join(others.repartition(tasks, "k"), "k", "left")
    alike = F.count_if(F.col("id") == F.col("other"))
    each = joined.repartition(tasks, "id").groupBy("id").agg(F.count("*").alias("n"), alike.alias("alike"))
    none = F.lit(0).cast("bigint")
    return each.agg(
        F.lit(reading).alias("reading"),
        F.coalesce(F.sum("n"), none).alias("n_rows"),
        F.count("id").alias("n_ids"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), none).alias("n_null"),
        (F.min("id") - start).alias("first_number"),
        (F.max("id") - start).alias("last_number"),
        F.coalesce(F.sum("alike"), none).alias("n_alike"),
    )


@registered(
    "snk9_surrogate_id",
    after(
        "SELECT reading, count(*) AS n_rows, count(*) AS n_ids, CAST(0 AS BIGINT) AS n_null, "
        "CAST(1 AS BIGINT) AS first_number, count(*) AS last_number, count(*) AS n_alike "
        "FROM loans, (VALUES ('as it is'), ('in small tasks')) AS readings(reading) GROUP BY 1"
    ),
)
def snk9(spark, sf_dir):
    """Ids of a folder: distinct, without a gap, and the same however it is read."""
    path = written_loans(spark, sf_dir)
    start = year_start(RUN_YEAR)

    def numbered(name: str) -> DataFrame:
        out = fresh_path(spark, name)
        add_surrogate_id(read_staging(spark, path), start).select("k", "id").write.parquet(out)
        return spark.read.parquet(out)

    ids = {"as it is": numbered("ids")}
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "0"}):
        ids["in small tasks"] = numbered("ids_again")
    others = ids["as it is"].select("k", F.col("id").alias("other"))
    results = [id_report(rows, others, start, reading) for reading, rows in ids.items()]
    return results[0].unionAll(results[1])


@registered(
    "snk10_loaded_at",
    after("SELECT state_code, count(*) AS n_loans, count(*) AS n_loaded_at FROM loans GROUP BY 1"),
)
def snk10(spark, sf_dir):
    table, location = fresh_table(spark, "loaded")
    staging = read_staging(spark, written_loans(spark, sf_dir))
    load_year(staging, table, RUN_YEAR, location=location, require_state=False)
    return (
        spark.table(table)
        .groupBy("state_code")
        .agg(F.count("*").alias("n_loans"), F.count("loaded_at").alias("n_loaded_at"))
    )


@registered(
    "snk13_ingest_report",
    after(
        f"SELECT CAST({len(REGISTER_COLUMNS)} AS INTEGER) AS n_columns, count(*) AS rows_loaded, "
        "count(DISTINCT coalesce(state_code, 'none')) AS n_files FROM loans"
    ),
)
def snk13(spark, sf_dir):
    report = ingest_loans(spark, write_register(spark, sf_dir), fresh_path(spark, "reported"))
    return report.select("n_columns", "rows_loaded", "n_files")


# Jobs


@registered("job1_ingest", after(f"SELECT {', '.join(REGISTER_COLUMNS)} FROM loans"))
def job1(spark, sf_dir):
    target = fresh_path(spark, "ingested")
    ingest_loans(spark, write_register(spark, sf_dir), target)
    return read_loans(spark, target).select(*REGISTER_COLUMNS)


def written_staging(spark: SparkSession, sf_dir: str, all_states: bool = False) -> str:
    """The enriched folder of one run over the whole register."""
    loans = fixtures.originated(spark, sf_dir, all_states)

    def write(lake: str) -> None:
        publish_year(loans, f"{lake}/raw", RUN_YEAR)
        write_rates(fixtures.rates(spark, sf_dir), f"{lake}/rates")

    given = fixtures.folder(spark, sf_dir, f"lake{'_all_states' * all_states}", write)
    lake = fresh_path(spark, "lake")
    enrich_year(spark, f"{given}/raw", f"{given}/rates", f"{lake}/staging", RUN_YEAR)
    return f"{lake}/staging/{RUN_YEAR}"


ENRICHED_COLUMNS = [
    "k",
    *REGISTER_TYPES,
    "loan_to_value_ratio",
    "debt_to_income_numeric",
    "yr",
    "mkt_benchmark",
    "interest_rate_spread",
]


@registered(
    "job2_enrich",
    after(
        "SELECT "
        + ", ".join(
            f"round({name}, 6) AS {name}"
            if name in ("mkt_benchmark", "interest_rate_spread")
            else name
            for name in ENRICHED_COLUMNS
        )
        + " FROM enriched"
    ),
)
def job2(spark, sf_dir):
    return rounded(read_staging(spark, written_staging(spark, sf_dir))).select(*ENRICHED_COLUMNS)


LOADED = """
    lei activity_year state_code county_code census_tract loan_type loan_purpose loan_amount
    interest_rate property_value occupancy_type lien_status income applicant_age
    loan_to_value_ratio debt_to_income_numeric
""".split()


@registered(
    "job3_load_year",
    after(f"SELECT {', '.join(LOADED)}, CAST({RUN_YEAR} AS INTEGER) AS data_year FROM staged"),
)
def job3(spark, sf_dir):
    table, location = fresh_table(spark, "year_table")
    staging = read_staging(spark, written_staging(spark, sf_dir))
    load_year(staging, table, RUN_YEAR, location=location, require_state=False)
    return spark.table(table).select(*LOADED, "data_year")


@registered(
    "job3_load_year_cloud",
    after(
        "SELECT state_code, count(*) AS n_loans, count(income) AS n_incomes, "
        "CAST(coalesce(sum(income), 0) AS BIGINT) AS income FROM loans GROUP BY 1"
    ),
)
def job3_cloud(spark, sf_dir):
    """The other backend keeps a missing income missing."""
    table, location = fresh_table(spark, "cloud_table")
    staging = read_staging(spark, written_loans(spark, sf_dir))
    load_year(staging, table, RUN_YEAR, income_to_zero=False, location=location)
    return (
        spark.table(table)
        .groupBy("state_code")
        .agg(
            F.count("*").alias("n_loans"),
            F.count("income").alias("n_incomes"),
            F.coalesce(F.sum("income"), F.lit(0)).alias("income"),
        )
    )


ONE_RUN_SUMMARY = (
    f"SELECT CAST({RUN_YEAR} AS INTEGER) AS data_year, state_code, state_name, risk_segment, "
    "loan_purpose_name, count(*) AS loan_count, sum(loan_amount) AS total_loan_amount, "
    "round(sum(interest_rate), 6) AS sum_interest_rate, "
    "round(avg(interest_rate_spread), 6) AS avg_rate_spread, "
    "CASE WHEN risk_segment = 'High' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS high_risk_ratio "
    "FROM fact GROUP BY 1, 2, 3, 4, 5"
)


@registered("job4_build_marts", after(ONE_RUN_SUMMARY, all_states=True))
def job4(spark, sf_dir):
    """Marts over a loaded table of loans that all have a state."""
    table, location = fresh_table(spark, "mart_source")
    staging = read_staging(spark, written_staging(spark, sf_dir, all_states=True))
    load_year(staging, table, RUN_YEAR, location=location)
    names = build_marts(spark, table, base=table, root=f"{location}_marts")
    return rounded_summary(spark.table(names["prd_risk_summary"]))


def built_marts(spark: SparkSession, sf_dir: str, **options) -> dict[str, str]:
    """Marts over one loaded year of loans that all have a state."""
    table, location = fresh_table(spark, "mart_source")
    staging = read_staging(spark, written_staging(spark, sf_dir, all_states=True))
    load_year(staging, table, RUN_YEAR, location=location)
    return build_marts(spark, table, base=table, root=f"{location}_marts", **options)


FACT_SHOWN = [name for name in FACT_COLUMNS if name not in ("id", "data_year")]


@registered(
    "job4_build_marts_fact",
    after(
        f"SELECT {rounded_sql(FACT_SHOWN)}, CAST({RUN_YEAR} AS INTEGER) AS data_year FROM fact",
        all_states=True,
    ),
)
def job4_fact(spark, sf_dir):
    """Every loan of the built fact, without its id."""
    fact = spark.table(built_marts(spark, sf_dir)["fct_loan_risk"])
    return rounded(fact).select(*FACT_SHOWN, "data_year")


@registered(
    "job4_build_marts_sample",
    after(
        f"SELECT CAST({RUN_YEAR} AS INTEGER) AS data_year, state_code, state_name, income, "
        "round(interest_rate_spread, 6) AS interest_rate_spread, risk_segment, loan_amount, loan_purpose_name "
        "FROM quality",
        all_states=True,
    ),
)
def job4_sample(spark, sf_dir):
    """The built sample when it is as large as the table: every loan fit for it."""
    names = built_marts(spark, sf_dir, n_sample=2**31 - 1)
    return rounded(spark.table(names["prd_loan_sample"]))


@registered(
    "doc10_refresh_one_year",
    after(
        ONE_RUN_SUMMARY.replace(f"CAST({RUN_YEAR} AS INTEGER) AS data_year", "run_year AS data_year").replace(
            "FROM fact",
            f"FROM fact, (VALUES (CAST({RUN_YEAR - 1} AS INTEGER)), (CAST({RUN_YEAR} AS INTEGER))) AS runs(run_year) "
            f"WHERE run_year < {RUN_YEAR} OR state_code <> 'CO'",
        ),
        all_states=True,
    ),
)
def doc10_refresh(spark, sf_dir):
    """Two years built; one of them loaded again without a state and refreshed alone."""
    table, location = fresh_table(spark, "refreshed")
    options = {"base": table, "root": f"{location}_marts"}
    staging = read_staging(spark, written_staging(spark, sf_dir, all_states=True))
    load_year(staging, table, RUN_YEAR - 1, location=location)
    load_year(staging, table, RUN_YEAR)
    build_marts(spark, table, **options)
    load_year(staging.where(NOT_COLORADO), table, RUN_YEAR)
    names = build_marts(spark, table, year=RUN_YEAR, **options)
    return rounded_summary(spark.table(names["prd_risk_summary"]))


@registered(
    "job5_dashboard_kpis_and_map",
    after(
        f"SELECT 'selected' AS part, CAST(sum(loan_count) AS BIGINT) AS loan_count FROM summary "
        f"WHERE data_year = {YEAR} AND state_name IN ({STATE_LIST}) UNION ALL "
        "SELECT 'map', CAST(sum(loan_count) AS BIGINT) FROM summary "
        f"WHERE data_year = {YEAR} UNION ALL "
        "SELECT 'purposes', CAST(sum(loan_count) AS BIGINT) FROM summary "
        f"WHERE data_year = {YEAR} AND state_name IN ({STATE_LIST}) "
        "AND loan_purpose_name IS NOT NULL UNION ALL "
        "SELECT 'scatter', count(*) FROM sample "
        f"WHERE data_year = {YEAR} AND state_name IN ({STATE_LIST})"
    ),
)
def job5(spark, sf_dir):
    """Totals of the dashboard's frames beside each other."""
    frames = dashboard_frames(
        summary_of(spark, sf_dir),
        loan_sample(fixtures.summary_fact(spark, sf_dir), reproducible=True),
        YEAR,
        STATES,
    )

    def total(part: str, frame: DataFrame, column) -> DataFrame:
        return frame.agg(column.cast("bigint").alias("loan_count")).select(
            F.lit(part).alias("part"), "loan_count"
        )

    return (
        total("selected", frames["kpis"], F.sum("total_loans"))
        .unionAll(total("map", frames["heatmap"], F.sum("loan_count")))
        .unionAll(total("purposes", frames["purpose_breakdown"], F.sum("loan_count")))
        .unionAll(total("scatter", frames["income_vs_spread"], F.count("*")))
    )


OF_YEAR = f"FROM summary WHERE data_year = {YEAR}"
CHOSEN_SQL = f"{OF_YEAR} AND state_name IN ({STATE_LIST})"
HIGH_SQL = "sum(CASE WHEN risk_segment = 'High' THEN loan_count END)"
NO_TEXT = "CAST(NULL AS VARCHAR)"


def _selection_sql(frame: str, keys: str, grouping: str = "") -> str:
    return (
        f"SELECT '{frame}' AS frame, {keys}, CAST(sum(loan_count) AS BIGINT) AS loan_count, "
        "sum(total_loan_amount) AS total_loan_amount, round(sum(sum_interest_rate), 6) AS sum_interest_rate, "
        f"CAST({HIGH_SQL} AS BIGINT) AS high_risk_count {CHOSEN_SQL} {grouping}"
    )


@registered(
    "job5_dashboard_one_pass",
    after(
        f"SELECT 'state' AS frame, state_code, {NO_TEXT} AS risk_segment, {NO_TEXT} AS loan_purpose_name, "
        "CAST(sum(loan_count) AS BIGINT) AS loan_count, CAST(NULL AS DOUBLE) AS total_loan_amount, "
        f"CAST(NULL AS DOUBLE) AS sum_interest_rate, CAST(NULL AS BIGINT) AS high_risk_count {OF_YEAR} GROUP BY state_code UNION ALL "
        + _selection_sql("purpose", f"{NO_TEXT}, risk_segment, loan_purpose_name", "GROUP BY risk_segment, loan_purpose_name")
        + " UNION ALL "
        + _selection_sql("segment", f"{NO_TEXT}, risk_segment, {NO_TEXT}", "GROUP BY risk_segment")
        + " UNION ALL "
        + _selection_sql("selection", f"{NO_TEXT}, {NO_TEXT}, {NO_TEXT}")
    ),
)
def job5_one_pass(spark, sf_dir):
    """Every group of the dashboard, of one reading of the summary."""
    rows = dashboard_rows(summary_of(spark, sf_dir), YEAR, STATES)
    return rows.withColumn("sum_interest_rate", F.round("sum_interest_rate", 6))


@registered(
    "job5_dashboard_every_frame",
    after(
        f"SELECT 'heatmap' AS frame, state_code AS first_key, {NO_TEXT} AS second_key, CAST(sum(loan_count) AS DOUBLE) AS value "
        f"{OF_YEAR} GROUP BY state_code UNION ALL "
        f"SELECT 'purpose_breakdown', loan_purpose_name, risk_segment, sum(loan_count) {CHOSEN_SQL} "
        "AND loan_purpose_name IS NOT NULL GROUP BY 2, 3 UNION ALL "
        f"SELECT 'risk_hierarchy', risk_segment, coalesce(loan_purpose_name, 'none'), sum(loan_count) {CHOSEN_SQL} GROUP BY 2, 3 UNION ALL "
        f"SELECT 'risk_hierarchy', risk_segment, 'all', sum(loan_count) {CHOSEN_SQL} GROUP BY 2 UNION ALL "
        f"SELECT 'kpis', 'total_loans', NULL, sum(loan_count) {CHOSEN_SQL} UNION ALL "
        f"SELECT 'kpis', 'portfolio_value_millions', NULL, round(sum(total_loan_amount) / 1e6, 6) {CHOSEN_SQL} UNION ALL "
        f"SELECT 'kpis', 'avg_market_rate', NULL, round(sum(sum_interest_rate) / sum(loan_count), 6) {CHOSEN_SQL} UNION ALL "
        f"SELECT 'kpis', 'high_risk_pct', NULL, round({HIGH_SQL} * 100.0 / sum(loan_count), 6) {CHOSEN_SQL} UNION ALL "
        "SELECT 'income_vs_spread', risk_segment, CAST(income AS VARCHAR), round(sum(interest_rate_spread), 4) FROM sample "
        f"WHERE data_year = {YEAR} AND state_name IN ({STATE_LIST}) GROUP BY 2, 3"
    ),
)
def job5_frames(spark, sf_dir):
    """Every value of every frame, as text keys and a number."""
    summary = summary_of(spark, sf_dir)
    sample = loan_sample(fixtures.summary_fact(spark, sf_dir), reproducible=True)
    frames = frames_from(dashboard_rows(summary, YEAR, STATES))
    kpis_row = frames["kpis"].withColumn("total_loans", F.col("total_loans").cast("double"))
    points = selected(sample, YEAR, STATES).groupBy("risk_segment", "income")

    def keyed(frame: str, rows: DataFrame, first, second, value) -> DataFrame:
        return rows.select(F.lit(frame).alias("frame"), first.alias("first_key"), second.alias("second_key"), value.cast("double").alias("value"))

    col, none = F.col, F.lit(None).cast("string")
    purpose = F.when(col("is_total") == 1, "all").otherwise(F.coalesce("loan_purpose_name", F.lit("none")))
    parts = [
        keyed("heatmap", frames["heatmap"], col("state_code"), none, col("loan_count")),
        keyed("purpose_breakdown", frames["purpose_breakdown"], col("loan_purpose_name"), col("risk_segment"), col("loan_count")),
        keyed("risk_hierarchy", frames["risk_hierarchy"], col("risk_segment"), purpose, col("loan_count")),
        keyed("kpis", kpis_row.unpivot([], kpis_row.columns, "name", "v"), col("name"), none, F.round("v", 6)),
        keyed(
            "income_vs_spread",
            points.agg(F.sum("interest_rate_spread").alias("v")),
            col("risk_segment"),
            col("income").cast("string"),
            F.round("v", 4),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


@registered(
    "srt8_stored_results",
    after(
        "SELECT asked, CAST(sum(loan_count) AS BIGINT) AS total_loans FROM fact_again, (VALUES ('first'), ('again'), ('after a load')) AS questions(asked) "
        "WHERE asked <> 'after a load' OR state_code <> 'CO' GROUP BY 1",
        all_states=True,
    ).replace(" SELECT asked,", f", fact_again AS (SELECT 1 AS loan_count, * FROM fact WHERE state_name IN ({STATE_LIST})) SELECT asked,"),
)
def srt8_stored(spark, sf_dir):
    """One question three times: asked, answered from what is stored, and after a load."""
    table, location = fresh_table(spark, "kept_results")
    options = {"base": table, "root": f"{location}_marts"}
    staging = read_staging(spark, written_staging(spark, sf_dir, all_states=True))
    load_year(staging, table, RUN_YEAR, location=location)
    names = build_marts(spark, table, **options)
    results = Results(spark, f"{location}_results")

    def asked(question: str) -> DataFrame:
        frames = kept_dashboard(results, names, RUN_YEAR, STATES)
        return frames["kpis"].select(F.lit(question).alias("asked"), "total_loans")

    answers = [asked("first"), asked("again")]
    load_year(staging.where(NOT_COLORADO), table, RUN_YEAR)
    build_marts(spark, table, year=RUN_YEAR, **options)
    return reduce(DataFrame.unionByName, [*answers, asked("after a load")])


@registered(
    "dq1_unique_id_in_files",
    after(
        "SELECT planted, CASE WHEN planted THEN count(*) FILTER (WHERE k % 97 = 0) ELSE 0 END AS n_failures, "
        "CASE WHEN planted THEN 2 * count(*) FILTER (WHERE k % 97 = 0) ELSE 0 END AS n_rows "
        "FROM loans, (VALUES (false), (true)) AS cases(planted) GROUP BY 1"
    ),
)
def dq1_in_files(spark, sf_dir):
    """Repeated ids of a numbered table, and of one with some rows in two files."""
    path = fresh_path(spark, "numbered")
    loans = read_staging(spark, written_loans(spark, sf_dir))
    add_surrogate_id(loans, year_start(RUN_YEAR)).select("k", "id").write.parquet(path)

    def failing(planted: bool) -> DataFrame:
        found = unique_failures_in_files(spark.read.parquet(path), "id")
        return found.agg(
            F.lit(planted).alias("planted"),
            F.count("*").alias("n_failures"),
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        )

    before = failing(False)
    before = spark.createDataFrame(before.collect(), before.schema)
    spark.read.parquet(path).where("k % 97 = 0").write.parquet(f"{path}-twice")
    both = spark.read.parquet(f"{path}-twice")
    both.write.mode("append").parquet(path)
    return before.unionAll(failing(True))


@registered(
    "snk13_rows_per_file",
    after(
        "SELECT state_code, CAST(ceil(count(*) / 500.0) AS BIGINT) AS n_files, count(*) AS n_rows, "
        "least(500, count(*)) AS largest FROM loans GROUP BY 1"
    ),
)
def snk13_files(spark, sf_dir):
    """Files of a load in batches, and the rows of each."""
    table, location = fresh_table(spark, "files")
    staging = read_staging(spark, written_loans(spark, sf_dir))
    load_year(staging, table, RUN_YEAR, location=location, batch_rows=500, require_state=False)
    files = written_files(spark, table, RUN_YEAR).groupBy("state_code")
    return files.agg(F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows"), F.max("n_rows").alias("largest"))


@registered(
    "job6_explore",
    after(
        "SELECT CAST(r.k AS INTEGER) AS k, CAST(r.activity_year AS INTEGER) AS activity_year, "
        "r.lei, TRY_CAST(interest_rate AS DOUBLE) AS interest_rate, avg_fed_rate, "
        "round(TRY_CAST(interest_rate AS DOUBLE) - avg_fed_rate, 2) AS interest_rate_spread "
        "FROM register r JOIN yearly2 ON CAST(r.activity_year AS INTEGER) = yearly2.activity_year "
        "WHERE action_taken = '1'"
    ),
)
def job6(spark, sf_dir):
    register = read_register_inferred(spark, write_register(spark, sf_dir))
    frames = explore(register, fixtures.rates(spark, sf_dir), keep=["k"])
    return frames["spread"].withColumn("k", F.col("k").cast("int"))


@registered("job7_run_year", after(ONE_RUN_SUMMARY, all_states=True))
def job7(spark, sf_dir):
    """From register text to the summary table, in one call."""
    table, location = fresh_table(spark, "run")
    rates = f"{location}_rates"
    write_rates(fixtures.rates(spark, sf_dir), rates)
    names = run_year(
        spark,
        RUN_YEAR,
        write_register(spark, sf_dir, all_states=True),
        rates,
        f"{location}_lake",
        table,
        location=location,
        base=table,
        marts_root=f"{location}_marts",
    )
    return rounded_summary(spark.table(names["prd_risk_summary"]))


@registered(
    "job6_explore_frames",
    after(
        f"SELECT 'loans' AS frame, count(*) AS n_rows FROM ({EXPLORE_SQL}) UNION ALL "
        f"SELECT 'n_loans', count(*) FROM ({EXPLORE_SQL}) UNION ALL "
        f"SELECT 'top_states', least(10, count(*)) FROM (SELECT DISTINCT state_code FROM ({EXPLORE_SQL})) UNION ALL "
        f"SELECT 'high_rate_high_dti', count(*) FROM ({EXPLORE_SQL}) WHERE {HIGH_DTI_SQL} UNION ALL "
        "SELECT 'newest_rates', count(*) FROM rates UNION ALL "
        "SELECT 'newest_benchmarks', count(*) FROM yearly2 UNION ALL "
        f"SELECT 'unmatched', count(*) FROM ({EXPLORE_JOINED_SQL}) WHERE avg_fed_rate IS NULL UNION ALL "
        f"SELECT 'n_unmatched', count(*) FROM ({EXPLORE_JOINED_SQL}) WHERE avg_fed_rate IS NULL UNION ALL "
        f"SELECT 'spread', count(*) FROM ({EXPLORE_JOINED_SQL}) WHERE avg_fed_rate IS NOT NULL"
    ),
)
def job6_frames(spark, sf_dir):
    """Rows of every frame of the exploration; the counting ones give their count."""
    register = read_register_inferred(spark, write_register(spark, sf_dir))
    frames = explore(register, fixtures.rates(spark, sf_dir), keep=["k"])
    counts = [
        frame.agg((F.first(name) if name.startswith("n_") else F.count("*")).alias("n_rows")).select(
            F.lit(name).alias("frame"), "n_rows"
        )
        for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionAll, counts)


@registered("srt7_session_view", after(f"SELECT count(*) AS n_loans FROM ({EXPLORE_SQL})"))
def srt7(spark, sf_dir):
    """SQL of one's own over the view the exploration leaves."""
    register = read_register_inferred(spark, write_register(spark, sf_dir))
    explore(register, fixtures.rates(spark, sf_dir), keep=["k"], view="explored_loans")
    return spark.sql("SELECT count(*) AS n_loans FROM explored_loans")


@registered(
    "srt8_kept_result",
    after(
        "SELECT CAST(sum(loan_count) AS BIGINT) AS all_loans, "
        f"CAST(sum(CASE WHEN data_year = {YEAR} THEN loan_count END) AS BIGINT) AS of_year FROM summary"
    ),
)
def srt8(spark, sf_dir):
    """Two selections of one summary that is kept between them."""
    with kept(summary_of(spark, sf_dir)) as summary:
        total = summary.agg(F.sum("loan_count")).first()[0]
        of_year = summary.where(F.col("data_year") == YEAR).agg(F.sum("loan_count")).first()[0]
    return spark.range(1).select(
        F.lit(total).cast("bigint").alias("all_loans"), F.lit(of_year).cast("bigint").alias("of_year")
    )


@registered(
    "flt6_empty_selection",
    "SELECT CAST(0 AS BIGINT) AS total_loans, CAST(0 AS DOUBLE) AS portfolio_value_millions, "
    "CAST(0 AS DOUBLE) AS avg_market_rate, CAST(0 AS DOUBLE) AS high_risk_pct",
)
def flt6(spark, sf_dir):
    """No states chosen: zeros, not all loans."""
    return kpis(selected(summary_of(spark, sf_dir), YEAR, []))


@registered("dq5_gate", after("SELECT count(*) > 0 AS stopped FROM fact WHERE state_code IS NULL"))
def dq5(spark, sf_dir):
    """The gate stops at loans without a state."""
    fact = fixtures.summary_fact(spark, sf_dir)
    try:
        require_none(not_null_failures(fact, ["state_code"]), "state")
        stopped = False
    except DataTestFailure:
        stopped = True
    return spark.range(1).select(F.lit(stopped).alias("stopped"))


@registered(
    "prj12_microseconds",
    after("SELECT count(*) AS n_rates, count(*) AS n_with_microsecond FROM rates"),
)
def prj12(spark, sf_dir):
    """A microsecond outlives the written rates."""
    rates = fixtures.rates(spark, sf_dir)
    path = fresh_path(spark, "rates")
    write_rates(
        rates.withColumn("observation_date", F.expr("observation_date + INTERVAL 1 MICROSECOND")), path
    )
    written = read_rates(spark, path)
    micro = F.expr("CAST(date_format(observation_date, 'SSSSSS') AS INT) = 1")
    return written.agg(F.count("*").alias("n_rates"), F.count_if(micro).alias("n_with_microsecond"))

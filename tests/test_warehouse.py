import glob
import os
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from lienspark.operators.layout import GATHER_SETTINGS, gather_by
from lienspark.operators.quality import DataTestFailure
from lienspark.operators.surrogate import YEAR_SHIFT, add_surrogate_id, year_start
from lienspark.plans.load import load_year, shape_for_load
from lienspark.schemas import LOAD_COLUMNS, WAREHOUSE_TYPES
from lienspark.settings import OPEN_FILES_SETTINGS, fresh_path, session_conf
from lienspark.sinks import generations
from lienspark.sinks.generations import committed, place_of, rows_table, show_current
from lienspark.sinks.lake import count_files, publish_year, write_by_state, write_clustered
from lienspark.sinks.warehouse import create_loan_table, partition_keys, written_files
from lienspark.sources.lake import read_loans
from lienspark_checks import job_queries
from lienspark_checks.registry import QUERIES

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

STAGING = """
    activity_year int, lei string, state_code string, loan_type smallint, loan_purpose smallint,
    occupancy_type smallint, lien_status smallint, loan_amount double, income int, yr int
"""


def loan(state, amount=100.0, lei="L1", **values):
    row = dict.fromkeys(field.split()[0] for field in STAGING.split(","))
    row.update(activity_year=1999, lei=lei, state_code=state, loan_amount=amount, yr=1999)
    return {**row, **values}


def staging(spark, *rows):
    names = [field.split()[0] for field in STAGING.split(",")]
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], STAGING)


@pytest.fixture
def table(spark):
    location = fresh_path(spark, "loans")
    name = f"loans_{location.split('/')[-2]}"
    create_loan_table(spark, name, location)
    return name


def contents(spark, table):
    rows = spark.table(table).groupBy("data_year", "state_code").agg(F.sum("loan_amount")).collect()
    return {(row.data_year, row.state_code): row[2] for row in rows}


def test_year_is_replaced_whole(spark, table):
    load_year(staging(spark, loan("CA"), loan("TX", 5.0)), table, 2023)
    load_year(staging(spark, loan("CA"), loan("NY", 7.0)), table, 2024)
    load_year(staging(spark, loan("CA", 1.0), loan("CA", 2.0)), table, 2023)
    assert contents(spark, table) == {(2023, "CA"): 3.0, (2024, "CA"): 100.0, (2024, "NY"): 7.0}
    folders = {"/".join(file.split("/")[-3:-1]) for file in spark.table(table).inputFiles()}
    assert folders == {
        "data_year=2023/state_code=CA",
        "data_year=2024/state_code=CA",
        "data_year=2024/state_code=NY",
    }


def test_year_is_replaced_whole_in_a_dynamic_session(spark, table):
    with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "DYNAMIC"}):
        load_year(staging(spark, loan("CA"), loan("TX")), table, 2023)
        load_year(staging(spark, loan("CA")), table, 2023)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "DYNAMIC"
    assert contents(spark, table) == {(2023, "CA"): 100.0}


def test_loading_the_same_year_again_changes_nothing(spark, table):
    rows = staging(spark, loan("CA"), loan("TX", 5.0))
    load_year(rows, table, 2023)
    first = spark.table(table).drop("loaded_at").orderBy("id").collect()
    load_year(rows, table, 2023)
    assert spark.table(table).drop("loaded_at").orderBy("id").collect() == first


def test_batches_become_files(spark, table):
    rows = staging(spark, *(loan("CA") for _ in range(10))).coalesce(1)
    load_year(rows, table, 2023, batch_rows=4)
    assert len(spark.table(table).inputFiles()) == 3
    load_year(rows, table, 2023)
    assert len(spark.table(table).inputFiles()) == 1
    assert spark.table(table).agg(F.count_distinct("id")).first()[0] == 10


def test_filters_of_small_batches_are_small(spark, table):
    rows = staging(spark, *(loan("CA", lei=f"L{i:05d}") for i in range(40))).coalesce(1)
    load_year(rows, table, 2023, batch_rows=4)
    files = [file.removeprefix("file:") for file in spark.table(table).inputFiles()]
    assert len(files) == 10 and max(map(os.path.getsize, files)) < 50_000
    for i in (0, 17, 39):
        assert spark.table(table).where(F.col("lei") == f"L{i:05d}").count() == 1


def test_states_are_written_side_by_side(spark, table, monkeypatch):
    from lienspark.sinks import lake

    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    for module in (lake, generations):

        @contextmanager
        def noted(session, settings, keep=module.session_conf):
            with keep(session, settings):
                seen.append(session.conf.get(name))
                yield

        monkeypatch.setattr(module, "session_conf", noted)
    before = spark.conf.get(name)
    write_by_state(staging(spark, loan("CA"), loan("TX")), fresh_path(spark, "beside"))
    load_year(staging(spark, loan("CA"), loan("TX")), table, 2023)
    assert len(seen) == 2 and min(map(int, seen)) >= 60
    assert spark.conf.get(name) == before


@pytest.mark.parametrize("open_files", ["1", "3", "100"])
def test_more_states_than_open_files(spark, table, monkeypatch, open_files):
    monkeypatch.setitem(OPEN_FILES_SETTINGS, "spark.sql.maxConcurrentOutputFileWriters", open_files)
    states = ["CA", None, "TX", "NY", "CO", "WA", "PR"]
    rows = staging(spark, *(loan(states[i % 7], float(i)) for i in range(70))).coalesce(1)
    path = fresh_path(spark, "many")
    report = write_by_state(rows, path, gather=False).first()
    assert (report.rows_loaded, report.n_files) == (70, 7)
    written = {r.state_code: r[1] for r in read_loans(spark, path).groupBy("state_code").agg(F.sum("loan_amount")).collect()}
    assert written == {state: sum(float(i) for i in range(70) if states[i % 7] == state) for state in states}
    load_year(rows, table, 2023, batch_rows=4, require_state=False)
    assert {state: amount for (_, state), amount in contents(spark, table).items()} == written
    files = {(r.state_code, r.file): r.n_rows for r in written_files(spark, table, 2023).collect()}
    assert len(files) == 7 * 3 and sorted({*files.values()}) == [2, 4]
    assert spark.table(table).agg(F.count_distinct("id")).first()[0] == 70


def test_odd_states_keep_their_place(spark, table):
    odd = staging(spark, loan("NA", 1.0), loan(None, 2.0), loan("A/'", 3.0))
    load_year(odd, table, 2023, require_state=False)
    assert contents(spark, table) == {(2023, "NA"): 1.0, (2023, None): 2.0, (2023, "A/'"): 3.0}
    keys = {row.state_code for row in partition_keys(spark.table(table)).collect()}
    assert keys == {"NA", "A/'"}


def test_loaded_row(spark, table):
    load_year(staging(spark, loan("CA", income=None, loan_type=None, loan_purpose=31)), table, 2023)
    row = spark.table(table).first().asDict()
    assert spark.table(table).dtypes == list(WAREHOUSE_TYPES.items())
    assert row["data_year"] == 2023 and row["activity_year"] == 1999
    assert row["loan_type"] == 0 and row["loan_purpose"] == 31
    assert row["income"] == 0 and row["property_value"] is None
    assert row["loaded_at"] is not None and row["id"] > year_start(2023)


def test_cloud_backend_keeps_missing_income(spark):
    rows = staging(spark, loan("CA"))
    local = shape_for_load(rows, 2023)
    cloud = shape_for_load(rows, 2023, income_to_zero=False, upper=True)
    assert local.first().income == 0
    assert cloud.first().INCOME is None
    assert cloud.columns == [name.upper() for name in local.columns]
    assert local.columns == [name for name in LOAD_COLUMNS if name in local.columns]
    assert "yr" not in local.columns


def test_ids_are_unique_over_loads_and_tasks(spark, table):
    many = spark.range(0, 20_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "CA").otherwise("TX").alias("state_code"),
        F.col("id").cast("double").alias("loan_amount"),
    )
    for year in (2022, 2023):
        load_year(many, table, year, gather=True)
    ids = spark.table(table).agg(F.count("id"), F.count_distinct("id"), F.count("*")).first()
    assert tuple(ids) == (40_000, 40_000, 40_000)
    ranges = spark.table(table).groupBy("data_year").agg(F.min("id"), F.max("id")).collect()
    for year, low, high in ranges:
        assert year_start(year) < low <= high <= year_start(year + 1)


def test_ids_of_the_largest_year_fit(spark):
    assert year_start(9999) + (1 << YEAR_SHIFT) < 1 << 63
    frame = add_surrogate_id(spark.range(3), year_start(9999))
    assert frame.dtypes[0] == ("id", "bigint")


def test_ids_do_not_depend_on_tasks(spark, monkeypatch):
    path = fresh_path(spark, "staged")
    rows = spark.range(0, 5_000, 1, 7).select(F.concat(F.lit("S"), F.col("id") % 3).alias("state_code"), F.col("id").alias("k"))
    rows.repartition(5).write.option("parquet.block.size", 4096).partitionBy("state_code").parquet(path)

    def numbered(frame, start=10):
        return {row.k: row.id for row in add_surrogate_id(frame, start).select("k", "id").collect()}

    first = numbered(read_loans(spark, path))
    assert sorted(first.values()) == list(range(11, 5_011))
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "0"}):
        many = read_loans(spark, path)
        assert many.rdd.getNumPartitions() > 15
        assert numbered(many) == first
    monkeypatch.setattr("lienspark.operators.surrogate.BROADCAST_FILES", 0)
    assert numbered(read_loans(spark, path)) == first


@pytest.mark.parametrize("change", ["where k % 3 > 0", "twice", "joined", "half of them twice"])
def test_ids_of_rows_that_are_no_whole_files(spark, change):
    path = fresh_path(spark, "staged")
    spark.range(0, 1_000, 1, 4).withColumnRenamed("id", "k").write.parquet(path)
    rows = spark.read.parquet(path)
    if change == "twice":
        rows = rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    elif change == "joined":
        rows = rows.join(spark.range(900), F.col("k") == F.col("id")).drop("id")
    elif change == "half of them twice":
        rows = rows.where("k % 2 = 0").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    else:
        rows = rows.where(change.removeprefix("where "))
    ids = sorted(row.id for row in add_surrogate_id(rows, 0).collect())
    assert ids == list(range(1, rows.count() + 1))


def test_no_rows_no_ids(spark):
    frame = add_surrogate_id(spark.range(0).withColumnRenamed("id", "k"), 5)
    assert frame.collect() == [] and frame.dtypes[-1] == ("id", "bigint")


def test_load_from_a_state_folder_does_not_shuffle(spark, plan_of):
    path = fresh_path(spark, "staged")
    write_by_state(staging(spark, loan("CA"), loan("TX")), path)
    shaped = add_surrogate_id(shape_for_load(read_loans(spark, path), 2023), 0)
    plan = plan_of(shaped)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "raise_error" not in plan


def test_year_and_states_prune_partitions(spark, table, plan_of):
    load_year(staging(spark, loan("CA"), loan("TX"), loan("NY")), table, 2023)
    load_year(staging(spark, loan("CA")), table, 2024)
    few = spark.table(table).where("data_year = 2023 AND state_code IN ('CA', 'TX')")
    with session_conf(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        plan = plan_of(few.select("loan_amount"))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(f"{name}#" in filters for name in ("data_year", "state_code", "generation"))
    assert len(few.inputFiles()) == 2


def test_lender_bloom_filter_and_statistics(spark, table):
    import pyarrow.parquet as pq

    rows = [loan("CA", lei=f"L{i % 50:05d}") for i in range(2000)]
    load_year(staging(spark, *rows), table, 2023)
    (location,) = {f.removeprefix("file:") for f in spark.table(table).inputFiles()[:1]}
    group = pq.ParquetFile(location).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert columns["loan_amount"].statistics.has_min_max
    described = spark.sql(f"DESCRIBE EXTENDED {rows_table(table)}").collect()
    assert any("parquet.bloom.filter.enabled#lei" in row.data_type for row in described)
    lender = columns["lei"]
    assert "RLE_DICTIONARY" not in lender.encodings and "PLAIN_DICTIONARY" not in lender.encodings
    # The filter lies between the column's pages and the footer.
    behind = max(c.data_page_offset + c.total_compressed_size for c in columns.values())
    assert os.path.getsize(location) - behind > 1_000_000 // 8


def test_failed_load_changes_nothing(spark, table):
    load_year(staging(spark, loan("CA"), loan("TX", 5.0)), table, 2023)
    first = spark.table(table).orderBy("id").collect()
    rows = staging(spark, *(loan("CA", float(i)) for i in range(50)), loan("NY")).repartition(4)
    broken = rows.withColumn(
        "loan_amount", F.expr("IF(loan_amount = 49, raise_error('broken row'), loan_amount)")
    )
    with pytest.raises(Exception, match="broken row"):
        load_year(broken, table, 2023)
    spark.catalog.refreshTable(table)
    assert spark.table(table).orderBy("id").collect() == first


@pytest.fixture
def cut_off(monkeypatch):
    """Ends a load at the named step, as if the driver had died there."""

    class Died(BaseException):
        pass

    def load(step, *arguments, **options):
        with monkeypatch.context() as patched:
            patched.setattr(generations, step, lambda *_: (_ for _ in ()).throw(Died()))
            with pytest.raises(Died):
                load_year(*arguments, **options)

    return load


OLD = {(2023, "CA"): 100.0, (2023, "TX"): 5.0, (2024, "CA"): 1.0}
NEW = {(2023, "CA"): 2.0, (2023, "NY"): 7.0, (2024, "CA"): 1.0}


def two_years(spark, table):
    load_year(staging(spark, loan("CA"), loan("TX", 5.0)), table, 2023)
    load_year(staging(spark, loan("CA", 1.0)), table, 2024)
    return staging(spark, loan("CA", 2.0), loan("NY", 7.0))


@pytest.mark.parametrize("step", ["create_file", "show_current"])
def test_a_load_cut_off_leaves_one_whole_year(spark, table, cut_off, step):
    rows = two_years(spark, table)
    cut_off(step, rows, table, 2023)
    for session in (spark, spark.newSession()):
        assert contents(session, table) == OLD
    # Another catalog goes by the marks; so does the view once it is asked to.
    create_loan_table(spark, f"{table}_other", place_of(spark, table))
    expected = NEW if step == "show_current" else OLD
    assert contents(spark, f"{table}_other") == expected
    show_current(spark, table)
    assert contents(spark, table) == expected
    load_year(rows, table, 2023)
    assert contents(spark, table) == NEW
    load_year(rows, table, 2023)
    assert contents(spark, table) == NEW


def test_a_reader_sees_the_old_year_or_the_new_one(spark, table, monkeypatch):
    rows = two_years(spark, table)
    other = spark.newSession()
    early = other.table(table).groupBy("data_year", "state_code").agg(F.sum("loan_amount"))
    early.explain()
    seen = {}

    def watched(step):
        function = getattr(generations, step)

        def run(*arguments):
            seen[f"before {step}"] = contents(other, table)
            out = function(*arguments)
            seen[f"after {step}"] = contents(other, table)
            return out

        monkeypatch.setattr(generations, step, run)

    watched("create_file")
    watched("show_current")
    load_year(rows, table, 2023)
    assert [seen[k] for k in ("before create_file", "after create_file", "before show_current")] == [OLD] * 3
    assert seen["after show_current"] == contents(other, table) == NEW
    # What was asked before the load still has its files.
    assert {(r[0], r[1]): r[2] for r in early.collect()} == OLD


def test_old_generations_go_with_their_files(spark, table):
    rows = two_years(spark, table)
    for _ in range(4):
        load_year(rows, table, 2023)
    place = place_of(spark, table)
    left = committed(spark, place)
    assert [name.split("-")[1] for name in left] == ["2024", "2023", "2023"]
    folders = {name for name in os.listdir(place) if name.startswith("generation=")}
    assert folders == {f"generation={name}" for name in left}
    shown = {row.partition.split("/")[0] for row in spark.sql(f"SHOW PARTITIONS {rows_table(table)}").collect()}
    assert shown == folders


def test_all_years_at_once_and_one_after_it(spark):
    name = f"yearly_{fresh_path(spark, 'x').split('/')[-2]}"
    generations.create(spark, name, {"v": "int", "data_year": "int"})

    def shown():
        return sorted(map(tuple, spark.table(name).collect()))

    assert shown() == []
    both = spark.createDataFrame([(2023, 1), (2024, 2)], "data_year int, v int")
    generations.replace(both, name)
    assert shown() == [(1, 2023), (2, 2024)]
    generations.replace(spark.createDataFrame([(3,)], "v int"), name, 2023)
    assert shown() == [(2, 2024), (3, 2023)]
    plan = spark.table(name).where("data_year = 2023")
    assert len(plan.inputFiles()) == 1
    with pytest.raises(ValueError, match="no"):
        generations.replace(both, name, test=lambda _: (_ for _ in ()).throw(ValueError("no")))
    assert shown() == [(2, 2024), (3, 2023)]
    generations.replace(both.where("v = 2"), name)
    assert shown() == [(2, 2024)]
    generations.replace(both.where("v = 5").drop("data_year"), name, 2024)
    assert shown() == []


def test_states_that_vanish_go_with_their_files(spark, table):
    odd = staging(spark, loan("NA", 1.0), loan(None, 2.0), loan("A/'", 3.0), loan("B\\", 4.0))
    load_year(odd, table, 2023, require_state=False)
    report = load_year(staging(spark, loan("NA", 9.0)), table, 2023).first()
    assert (report.rows_removed, report.rows_loaded) == (4, 1)
    assert contents(spark, table) == {(2023, "NA"): 9.0}
    spark.sql(f"ALTER TABLE {rows_table(table)} RECOVER PARTITIONS")
    assert contents(spark, table) == {(2023, "NA"): 9.0}
    report = load_year(staging(spark, loan("CA")).limit(0), table, 2023).first()
    assert (report.rows_removed, report.rows_loaded) == (1, 0)


def test_new_entry_over_existing_years(spark, table):
    load_year(staging(spark, loan("CA")), table, 2022)
    load_year(staging(spark, loan("TX", 5.0)), table, 2023)
    create_loan_table(spark, f"{table}_again", place_of(spark, table))
    assert contents(spark, f"{table}_again") == {(2022, "CA"): 100.0, (2023, "TX"): 5.0}


@pytest.mark.parametrize("missing", ["value", "column"])
def test_local_load_needs_a_state(spark, table, missing):
    load_year(staging(spark, loan("CA")), table, 2023)
    rows = staging(spark, loan("TX"), loan(None))
    rows = rows.drop("state_code") if missing == "column" else rows
    with pytest.raises(DataTestFailure, match="state"):
        load_year(rows, table, 2023)
    assert contents(spark, table) == {(2023, "CA"): 100.0}
    load_year(rows, table, 2023, income_to_zero=False)


def test_failed_publishing_keeps_the_old_year(spark):
    root = fresh_path(spark, "root")
    publish_year(staging(spark, loan("CA"), loan("TX")), root, 2023)
    broken = staging(spark, loan("NY")).withColumn(
        "loan_amount", F.expr("raise_error('broken row')").cast("double")
    )
    with pytest.raises(Exception, match="broken row"):
        publish_year(broken, root, 2023)
    assert {r.state_code for r in read_loans(spark, f"{root}/2023").collect()} == {"CA", "TX"}
    assert os.listdir(root) == ["2023"]


def test_clustered_files_leave_out_most_for_a_year_and_state(spark):
    import pyarrow.parquet as pq

    path = fresh_path(spark, "pruned")
    rows = spark.range(0, 200_000, 1, 8).select(
        F.xxhash64("id").alias("id"),
        (2016 + F.col("id") % 8).cast("int").alias("data_year"),
        F.when(F.col("id") % 3 == 0, "CA")
        .otherwise(F.concat(F.lit("S"), F.lpad((F.xxhash64("id") % 50 + 50).cast("string"), 3, "0")))
        .alias("state_code"),
    )
    write_clustered(rows, path, files=40)
    ranges = []
    for file in glob.glob(f"{path}/*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        stats = {group.column(i).path_in_schema: group.column(i).statistics for i in range(3)}
        ranges.append([(stats[c].min, stats[c].max) for c in ("data_year", "state_code")])
    assert len(ranges) >= 30

    def opened(year, state):
        return sum(a <= year <= b and c <= state <= d for (a, b), (c, d) in ranges)

    assert opened(2019, "S050") <= 3
    assert opened(2019, "CA") <= 6


def test_publishing_replaces_the_year_folder_only(spark):
    root = fresh_path(spark, "root")
    publish_year(staging(spark, loan("CA"), loan("TX")), root, 2023)
    publish_year(staging(spark, loan("NY")), root, 2024)
    publish_year(staging(spark, loan("CA", 9.0)), root, 2023)
    assert {r.state_code for r in read_loans(spark, f"{root}/2023").collect()} == {"CA"}
    assert {r.state_code for r in read_loans(spark, f"{root}/2024").collect()} == {"NY"}


def test_publishing_in_a_dynamic_session(spark):
    root = fresh_path(spark, "root")
    with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "DYNAMIC"}):
        publish_year(staging(spark, loan("CA"), loan("TX")), root, 2023)
        publish_year(staging(spark, loan("CA")), root, 2023)
    assert {r.state_code for r in read_loans(spark, f"{root}/2023").collect()} == {"CA"}


def test_report_of_a_write(spark):
    path = fresh_path(spark, "report")
    report = write_by_state(staging(spark, loan("CA"), loan("TX"), loan("TX")), path).first()
    assert report.rows_loaded == 3
    assert report.n_columns == 10
    assert report.n_files == count_files(spark, path) == len(glob.glob(f"{path}/*/*.parquet"))


def test_hot_state_is_cut_and_small_ones_are_not_scattered(spark, monkeypatch):
    monkeypatch.setitem(GATHER_SETTINGS, ADVISORY, "64k")
    path = fresh_path(spark, "skewed")
    rows = spark.range(0, 300_000, 1, 16).select(
        F.xxhash64("id").alias("k"),
        F.when(F.col("id") % 3 > 0, "CA")
        .otherwise(F.concat(F.lit("S"), (F.col("id") % 5).cast("string")))
        .alias("state_code"),
    )
    write_by_state(rows, path)
    files = {s: len(glob.glob(f"{path}/state_code={s}/*.parquet")) for s in ("CA", "S0")}
    assert files["CA"] >= 8
    assert files["S0"] < 16
    assert read_loans(spark, path).count() == 300_000


def test_gathering_uses_one_rebalance(spark, plan_of):
    rows = staging(spark, loan("CA"))
    assert plan_of(gather_by(rows, "state_code")).count("REBALANCE_PARTITIONS_BY_COL") >= 1


def test_clustered_files_are_narrow_and_cut_a_hot_state(spark, monkeypatch):
    monkeypatch.setitem(GATHER_SETTINGS, ADVISORY, "64k")
    path = fresh_path(spark, "clustered")
    rows = spark.range(0, 120_000, 1, 16).select(
        F.xxhash64("id").alias("id"),
        F.lit(2023).alias("data_year"),
        F.when(F.col("id") % 3 > 0, "CA").otherwise("TX").alias("state_code"),
    )
    write_clustered(rows, path, files=6)
    per_file = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name().alias("file"))
        .agg(F.count("*").alias("n"), F.count_distinct("state_code").alias("states"))
        .collect()
    )
    assert sum(row.n for row in per_file) == 120_000
    assert max(row.n for row in per_file) < 40_000
    assert sum(row.states > 1 for row in per_file) <= 1


def test_ids_are_compared_in_as_many_tasks_as_they_need(spark, tmp_path, plan_of, monkeypatch):
    monkeypatch.setattr(job_queries, "TASK_IDS", 20, raising=False)
    orders = "id o_orderkey, id % 40 o_custkey, 'F' o_orderstatus, 1.0D + id o_totalprice, timestamp'1997-03-04' o_orderdate"
    spark.range(130).selectExpr(*orders.split(", ")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(40).selectExpr("id c_custkey", "id % 25 c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    frame = QUERIES["snk9_surrogate_id"](spark, str(tmp_path))
    dealt = re.findall(r"hashpartitioning\((k|id)#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan_of(frame))
    assert {*dealt} == {("k", "7"), ("id", "7")}
    counts = (130, 130, 0, 1, 130, 130)
    assert sorted(map(tuple, frame.collect())) == [("as it is", *counts), ("in small tasks", *counts)]


def test_id_report_of_repeated_and_missing_ids(spark):
    def rows(text):
        return spark.sql(f"SELECT * FROM VALUES {text} AS t(k, id)")

    ids = rows("(1L, 101L), (1L, 102L), (2L, 102L), (NULL, 104L), (5L, NULL)")
    others = ids.withColumnRenamed("id", "other")
    report = job_queries.id_report(ids, others, 100, "own").first()
    assert tuple(report) == ("own", 7, 3, 1, 1, 4, 3)
    empty = job_queries.id_report(ids.limit(0), others, 100, "none").first()
    assert tuple(empty) == ("none", 0, 0, 0, None, None, 0)

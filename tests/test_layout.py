import glob

import pytest
from pyspark.sql import functions as F

from lienspark.operators import layout
from lienspark.operators.layout import cluster_by, curve_by, file_numbers
from lienspark.settings import fresh_path
from lienspark.sinks.curved import RANGES, read_curved, write_curved
from lienspark.sinks.lake import write_clustered

LTV, SPREAD = "loan_to_value_ratio", "interest_rate_spread"


@pytest.fixture(scope="module")
def loans(spark):
    """Two years, a hot state, heavy tails, nulls, and a value that many loans share."""
    draw = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(10_000)) / 10_000
    frame = spark.range(0, 60_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, 2023).otherwise(2024).alias("data_year"),
        F.when(draw(1) < 0.4, "CA").when(draw(1) < 0.42, None).otherwise(F.concat(F.lit("S"), (draw(2) * 50).cast("int"))).alias("state_code"),
        F.when(draw(3) < 0.05, None).when(draw(3) < 0.06, draw(4) * 1e6).otherwise(0.3 + draw(4) * 0.8).alias(LTV),
        F.when(draw(5) < 0.1, 0.0).when(draw(5) < 0.12, None).otherwise(draw(6) * 8 - 3).alias(SPREAD),
    )
    path = fresh_path(spark, "loans")
    frame.write.parquet(path)
    return spark.read.parquet(path)


def numbered(rows, *keys, files):
    placed, n = file_numbers(rows, *keys, files=files)
    return {row.id: row["_file"] for row in placed.select("id", "_file").collect()}, n


def test_files_are_the_same_on_every_run(loans):
    first, n = numbered(loans, "data_year", "state_code", files=40)
    assert len(set(first.values())) == n and 40 <= n <= 42
    assert numbered(loans.repartition(13, "id"), "data_year", "state_code", files=40) == (first, n)
    assert numbered(loans.orderBy(F.desc("id")), "data_year", "state_code", files=40) == (first, n)


@pytest.mark.parametrize("bound", [layout.BROADCAST_ROWS, 0])
def test_files_hold_one_year_neighbours_and_as_many_rows(spark, loans, monkeypatch, bound):
    monkeypatch.setattr(layout, "BROADCAST_ROWS", bound)
    path = fresh_path(spark, "clustered")
    write_clustered(loans, path, files=40)
    rows = spark.read.parquet(path).groupBy(F.input_file_name().alias("file"))
    files = rows.agg(
        F.count("*").alias("n"),
        F.count_distinct("data_year").alias("years"),
        F.min("data_year").alias("year"),
        F.min(F.coalesce("state_code", F.lit(""))).alias("low"),
        F.max(F.coalesce("state_code", F.lit(""))).alias("high"),
    ).collect()
    assert sum(f.n for f in files) == 60_000 and {f.years for f in files} == {1}
    assert max(f.n for f in files) < 1.15 * 60_000 / 40
    for year in (2023, 2024):
        own = sorted((f.low, f.high) for f in files if f.year == year)
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:]))
        assert sum(low <= "S17" <= high for low, high in own) <= 2


def test_rows_come_out_as_they_went_in(loans):
    for made in (cluster_by(loans, "data_year", "state_code", files=5), curve_by(loans, "data_year", (LTV, SPREAD), files=5)):
        assert made.schema == loans.schema
        assert made.exceptAll(loans).isEmpty() and loans.exceptAll(made).isEmpty()


def test_odd_tables(spark, loans):
    assert cluster_by(loans.where("false"), "data_year", "state_code").count() == 0
    assert curve_by(loans.where("false"), "data_year", (LTV, SPREAD)).count() == 0
    rows = spark.createDataFrame([(None, None, None)] * 3 + [(1, "a", float("nan")), (1, "a", float("inf"))], "y int, s string, x double")
    assert cluster_by(rows, "y", "s", files=3).count() == curve_by(rows, "y", ["x"], files=3).count() == 5


@pytest.fixture(scope="module")
def curved(spark, loans):
    path = fresh_path(spark, "curved")
    write_curved(loans, path, files=120)
    return path


@pytest.mark.parametrize(
    "bounds",
    [{LTV: (0.5, 0.53)}, {LTV: (1.06, None)}, {SPREAD: (1.0, 1.2)}, {SPREAD: (None, -2.6)}, {LTV: (0.7, 0.8), SPREAD: (2.0, 3.0)}, {LTV: (2000.0, None)}],
)
def test_a_range_opens_few_files_and_loses_no_row(spark, loans, curved, bounds):
    found = read_curved(spark, curved, bounds, 2024)
    of_year = len(read_curved(spark, curved, {}, 2024).inputFiles())
    assert of_year >= 75
    assert len(found.inputFiles()) < of_year / 4
    expected = loans.where("data_year = 2024")
    for name, (low, high) in bounds.items():
        expected = expected.where(F.col(name).between(-1e9 if low is None else low, 1e9 if high is None else high))
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in expected.collect())
    assert found.schema == loans.schema


def test_no_bounds_no_file_and_the_table_beside_the_files(spark, loans, curved):
    assert read_curved(spark, curved, {}).count() == 60_000
    assert read_curved(spark, curved, {}, 1999).collect() == []
    assert read_curved(spark, curved, {LTV: (5e9, None)}).inputFiles() == []
    assert spark.read.parquet(curved).count() == 60_000
    ranges = spark.read.parquet(f"{curved}/{RANGES}")
    assert ranges.count() == len(glob.glob(f"{curved}/*.parquet"))
    assert ranges.agg(F.sum("n_rows")).first()[0] == 60_000


def test_a_failed_write_keeps_files_and_table(spark, loans, tmp_path):
    path = f"{tmp_path}/kept"
    write_curved(loans.where("id < 1000"), path, files=4)
    broken = loans.withColumn(LTV, F.expr("IF(id = 77, raise_error('broken row'), loan_to_value_ratio)"))
    with pytest.raises(Exception, match="broken row"):
        write_curved(broken, path, files=4)
    assert read_curved(spark, path, {SPREAD: (-9, 9)}).count() == loans.where(f"id < 1000 AND {SPREAD} IS NOT NULL").count()

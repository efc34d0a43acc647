import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lienspark.operators.benchmark import yearly_benchmark
from lienspark.plans.ingest import clean_loans
from lienspark.schemas import REGISTER_COLUMNS, layer_name
from lienspark.settings import fresh_path, session_conf, shared_folder
from lienspark.sinks.lake import write_by_state, write_rates
from lienspark.sources.lake import input_present, read_loans, read_rates
from lienspark.sources.rates import normalise_rates
from lienspark.sources.register import read_register, read_register_inferred
from lienspark.sources.seeds import SEED_ROWS, SEED_SCHEMAS, builtin_seeds, read_seeds


def text_file(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def test_register_is_text_by_header_name(spark, tmp_path):
    path = text_file(tmp_path / "r", "a.txt", "b|a|code", "1|x|007", "||")
    frame = read_register(spark, path)
    assert frame.dtypes == [("b", "string"), ("a", "string"), ("code", "string")]
    assert [tuple(row) for row in frame.select("code", "b").collect()] == [
        ("007", "1"),
        (None, None),
    ]


def test_register_refuses_a_file_with_other_columns(spark, tmp_path):
    text_file(tmp_path / "r", "a.txt", "a|b", "1|2")
    path = text_file(tmp_path / "r", "b.txt", "b|a", "3|4")
    with pytest.raises(Exception, match="(?i)header"):
        read_register(spark, path).collect()


def test_register_ingest_prunes_columns_and_filters_early(spark, tmp_path, plan_of):
    header = "|".join(["extra", *REGISTER_COLUMNS])
    path = text_file(tmp_path / "r", "a.txt", header)
    plan = plan_of(clean_loans(read_register(spark, path)))
    assert "EqualTo(action_taken,1)" in plan
    assert "extra" not in plan.split("Physical Plan")[1]


def test_inferred_register(spark, tmp_path):
    path = text_file(tmp_path / "r", "a.txt", "year|rate|state", "1997|5.5|CA", "1998|NA|TX")
    assert read_register_inferred(spark, path).dtypes == [
        ("year", "int"),
        ("rate", "string"),
        ("state", "string"),
    ]


def test_state_stays_text(spark):
    path = fresh_path(spark, "states")
    rows = [(1, "06"), (2, "NA"), (3, None), (4, "")]
    write_by_state(spark.createDataFrame(rows, "k int, state_code string"), path)
    read = read_loans(spark, path)
    assert dict(read.dtypes)["state_code"] == "string"
    assert {row.k: row.state_code for row in read.collect()} == {
        1: "06",
        2: "NA",
        3: None,
        4: None,
    }


def test_rates_without_nan(spark):
    rows = [
        (datetime(2000, 1, 1), 2.0),
        (datetime(2000, 2, 1), math.nan),
        (datetime(2000, 3, 1), None),
        (datetime(2000, 4, 1), 4.0),
    ]
    series = normalise_rates(spark.createDataFrame(rows, "index timestamp, value double"))
    assert series.columns == ["observation_date", "fed_rate"]
    assert [tuple(row) for row in yearly_benchmark(series).collect()] == [(2000, 3.0)]


def test_rates_are_written_in_microseconds(spark):
    import glob

    import pyarrow.parquet as pq

    path = fresh_path(spark, "rates")
    rows = [(datetime(2000, 1, 1, 0, 0, 0, 123456), 2.0)]
    with session_conf(spark, {"spark.sql.parquet.outputTimestampType": "INT96"}):
        write_rates(
            spark.createDataFrame(rows, "observation_date timestamp, fed_rate double"), path
        )
        assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96"
    file = glob.glob(f"{path}/*.parquet")[0]
    assert str(pq.read_schema(file).field("observation_date").type) == "timestamp[us, tz=UTC]"
    assert read_rates(spark, path).first().observation_date.microsecond == 123456


def seed_folder(tmp_path, **changes):
    folder = tmp_path / "seeds"
    for name, rows in {**SEED_ROWS, **changes}.items():
        header = ",".join(field.split()[0] for field in SEED_SCHEMAS[name].split(", "))
        text_file(folder, f"{name}.csv", header, *(f"{key},{text}" for key, text in rows))
    return str(folder)


def test_seeds_from_files_equal_the_builtin_ones(spark, tmp_path):
    read, builtin = read_seeds(spark, seed_folder(tmp_path)), builtin_seeds(spark)
    assert list(read) == list(builtin)
    for name in builtin:
        assert read[name].dtypes == builtin[name].dtypes
        assert sorted(read[name].collect()) == sorted(builtin[name].collect())
    assert builtin["state_mapping"].count() == 56


@pytest.mark.parametrize("rows", [[(1, "a"), (1, "b")], [("", "a")]])
def test_seed_key_must_be_unique_and_known(spark, tmp_path, rows):
    with pytest.raises(ValueError, match="loan_type"):
        read_seeds(spark, seed_folder(tmp_path, loan_type=rows))


def test_only_a_small_seed_is_marked_for_broadcast(spark, tmp_path, monkeypatch, plan_of):
    monkeypatch.setattr("lienspark.sources.seeds.BROADCAST_ROWS", 4)
    seeds = read_seeds(spark, seed_folder(tmp_path))
    assert "strategy=broadcast" in plan_of(seeds["loan_type"])
    assert "strategy=broadcast" not in plan_of(seeds["state_mapping"])


def test_input_present(spark):
    path = fresh_path(spark, "present")
    assert not input_present(spark, path)
    frame = spark.createDataFrame([(1997, "CA")], "data_year int, state_code string")
    write_by_state(frame.where("false"), path)
    assert not input_present(spark, path)
    write_by_state(frame, path)
    assert input_present(spark, path)
    assert input_present(spark, path, 1997)
    assert not input_present(spark, read_loans(spark, path), 1998)


def test_layer_names():
    assert layer_name("risk", "stg") == "risk_stg"
    assert layer_name(" risk ") == "risk"
    assert layer_name("risk", " prod ", style="bare") == "PROD"
    assert layer_name("risk", style="bare") == "RISK"
    with pytest.raises(ValueError):
        layer_name("risk", "stg", style="other")


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_session_conf_puts_values_back(spark):
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    with pytest.raises(RuntimeError):
        with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "DYNAMIC"}):
            assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "DYNAMIC"
            raise RuntimeError
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"

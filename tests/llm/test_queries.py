"""The registered queries: names, columns, and those with a DuckDB text."""

import pytest

import __spark_entry__ as contract
from conftest import SF_DIR
from lienspark.llm import queries
from lienspark_checks.compare import connect, differences

COLUMNS = {
    1: "doc_id size source_size target taken",
    2: "doc_id held_out lang_pred score",
    3: "doc_id item_id similarity first_word n_words",
    4: "doc_id class_id kept",
    5: "doc_id n_bytes n_removed n_spans kept_sha256",
    6: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept n_boilerplate",
    7: "doc_id held_out score predicted",
    8: "doc_id held_out n_tokens n_known train_tokens base_score score",
    9: "doc_id n_words n_removed kept_sha256",
    10: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    11: "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    12: "anchor_id positive_id rank negative_id positive_score negative_score",
    13: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
}


def number(name):
    return int(name[2:].split("_")[0])


def test_all_are_registered():
    assert sorted(map(number, queries.QUERIES)) == sorted(COLUMNS)
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(queries.ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(name for name in queries.QUERIES if number(name) <= 10))
def test_one_row_for_every_document(spark, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    assert found.columns == COLUMNS[number(name)].split()
    ids = sorted(r.doc_id for r in found.select("doc_id").collect())
    documents = sorted(r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect())
    assert set(ids) <= set(documents) if name.startswith("op3_") else ids == documents


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(name for name in queries.QUERIES if number(name) in (11, 13)))
def test_one_row_for_every_conversation(spark, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    assert found.columns == COLUMNS[number(name)].split()
    ids = sorted(r.conv_id for r in found.select("conv_id").collect())
    known = {r.conv_id for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id").collect()}
    assert ids == sorted(known | {-1} if number(name) == 13 else known)


def test_hard_negatives_columns(spark):
    (name,) = (name for name in queries.QUERIES if number(name) == 12)
    found = queries.QUERIES[name](spark, SF_DIR)
    assert found.columns == COLUMNS[12].split() and found.schema["rank"].dataType.simpleString() == "int"

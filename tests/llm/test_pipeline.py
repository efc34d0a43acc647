"""The pipeline beside a plain version of its stages, on the small table."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_DIR
from lienspark.llm import pii, quality
from .test_near_dup import plain_classes


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and what it returned, as rows."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [("documents", docs.columns, docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        given = spark.createDataFrame(out[-1][2], docs.schema)
        found = stage(spark, given, SF_DIR)
        out.append((name, found.columns, found.collect()))
    return out


def test_stages_call_the_five_operators_in_order(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "near duplicates", "decontamination", "personal data", "mixing"]
    documents = stages[0][1]
    assert all(columns == documents for _, columns, _ in stages[:-1])
    assert stages[-1][1] == ["doc_id", "size", "source_size", "target", "taken"]


def test_quality_stage(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1][2]}
    judged = [(d, q) for d, q in labels.items() if d in {r.doc_id for r in stages[0][2]}]
    right = [(d in kept) == (q == 1) for d, q in judged]
    assert sum(right) / len(right) > 0.95
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert kept == {r.doc_id for r in quality.score(docs, model).collect() if r.score >= quality.THRESHOLD}


def test_near_duplicate_stage(stages):
    classes = plain_classes([(r.doc_id, r.text) for r in stages[1][2]])
    assert sorted(r.doc_id for r in stages[2][2]) == sorted(set(classes.values()))


def test_decontamination_stage(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]

    def plain(text):
        return " " + " ".join(re.findall(r"[a-zà-öø-þ0-9]+", text.lower())) + " "

    holds = {r.doc_id for r in stages[2][2] if any(plain(i) in plain(r.text) for i in items)}
    gone = {r.doc_id for r in stages[2][2]} - {r.doc_id for r in stages[3][2]}
    assert holds <= gone and len(gone - holds) <= 1


def test_personal_data_stage(stages):
    before = {r.doc_id: r for r in stages[3][2]}
    after = {r.doc_id: r for r in stages[4][2]}
    assert before.keys() == after.keys()
    for i, row in after.items():
        assert not any(pii.base_spans(row.text).values())
        if row.text != before[i].text:
            assert row.n_chars == len(row.text) and re.search(r"\[[A-Z]+\]", row.text)
        else:
            assert row == before[i]


def test_run_is_the_stages_one_after_the_other(spark, stages):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, stages[-1][2]))


@pytest.mark.parametrize("table", ["awkward", "repeated", "nothing"])
def test_awkward_tables_pass_every_stage(spark, request, awkward, table):
    """Nulls, repeated ids with other texts, clashing columns, and no rows at all."""
    if table == "repeated":
        docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        docs = docs.union(docs.withColumn("text", F.reverse("text")).limit(40)).union(docs.limit(5))
    else:
        docs = request.getfixturevalue(table)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = spark.createDataFrame(docs.collect(), docs.schema)
        docs = stage(spark, given, SF_DIR)
        assert docs.columns == columns, name
        texts = {(r.doc_id, r.text) for r in given.select("doc_id", "text").collect()}
        left = docs.select("doc_id", "text").collect()
        if name != "personal data":
            assert {(r.doc_id, r.text) for r in left} <= texts, name
        if name == "near duplicates":
            classes = plain_classes(list(enumerate({t for i, t in texts if i is not None and t is not None})))
            worded = [r for r in left if r.doc_id is not None and r.text is not None]
            assert len(worded) == len(set(classes.values()))
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert sorted(map(str, (r.doc_id for r in mixed.collect()))) == sorted(map(str, (r.doc_id for r in docs.collect())))

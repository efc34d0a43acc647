"""From documents to a training mix: each stage reads what the stage before wrote.

Near-duplicate and contaminated documents and those of low quality go, personal
data is masked, and the sources are mixed to their weights. Every stage but the
last returns the columns it was given, those of ``documents`` or more.

Nulls and corner cases: a null text counts as an empty one, which holds no item; rows
without an id or text are no copies of any; of rows with one id and text one stays,
and another text of the same id is a document of its own; an empty table passes every
stage empty; further columns, whatever their names, are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lienspark.llm import decontaminate, mixing, near_dup, pii, quality
from lienspark.llm.io import written
from lienspark.llm.registry import read


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier predicts to be good; the labels are the folder's."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.keep(docs, model)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates."""
    return near_dup.keep(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the folder's benchmark."""
    return decontaminate.keep(docs, read(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in the text."""
    return pii.redact(docs, pii.train(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mix takes of each document that is left."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("personal data", pii_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a written table between them."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs


# Trained models take part, which SQL cannot express; tests hold run() against a
# plain version of each stage.
ORACLE_SQL = None

"""Quality classifier: a linear support vector machine over naive Bayes ratios.

Indicators of hashed n-grams (of bytes, and of word shapes) are scaled by the log
ratio of their frequency in good and bad documents; a linear hinge-loss model is
fitted to the scaled, length-normalised rows by dual coordinate descent, and its
margin is turned into a probability on rows kept out of the fit.

Nulls and corner cases: a null or empty text has no n-grams and gets the score of
the model's constant; a null ``doc_id`` is never learned from and is not held
out; labels without quality are ignored, and of several labels of one document
the largest counts; with labels of one class only, or none, every score is the
smoothed share of good labels. Repeated rows get equal results. Further columns
stay, save those named like a result, which the result replaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lienspark.llm.registry import read, registered
from lienspark.llm.text import Words, runs, utf8

BYTE_BITS, SHAPE_BITS = 16, 14
FEATURES = (1 << BYTE_BITS) + (1 << SHAPE_BITS)
ROW_BITS = (FEATURES - 1).bit_length()

# Labelled rows the model is fitted to, chosen by a hash of the id: the bound of
# what the driver holds.
TRAIN_ROWS = 4000
THRESHOLD = 0.3
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 20
SEED = 7

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>!"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LOWER = np.zeros(256, bool)
_LOWER[ord("a") : ord("z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True


def _shapes(words: Words) -> np.ndarray:
    """Six bits a word: letters, digits, symbols it holds, and whether it repeats."""
    data, starts = words.data, words.starts
    shape = np.zeros(len(starts), np.uint32)
    for bit, kind in enumerate((_UPPER, _LOWER, _DIGIT, _SYMBOL)):
        shape |= np.logical_or.reduceat(kind[data], starts).astype(np.uint32) << np.uint32(bit)
    shape |= (words.ends - starts == 1).astype(np.uint32) << np.uint32(4)
    hashes = words.hashes()
    same = np.zeros(len(starts), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[words.bounds[:-1][words.bounds[:-1] < len(starts)]] = False
    return shape | same.astype(np.uint32) << np.uint32(5)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a run of documents: document numbers and feature numbers."""
    n_docs = len(offsets) - 1
    kind = np.uint32 if n_docs << ROW_BITS < 1 << 32 else np.uint64
    keys = []
    if len(data) > 2:
        doc = np.repeat(np.arange(n_docs, dtype=kind), np.diff(offsets))
        code = data.astype(np.uint32)
        code = code[:-2] | code[1:-1] << np.uint32(8) | code[2:] << np.uint32(16)
        code = (code * np.uint32(2654435761)) >> np.uint32(32 - BYTE_BITS)
        whole = doc[:-2] == doc[2:]
        keys.append((doc[:-2] << kind(ROW_BITS) | code)[whole])
    words = Words(data, offsets)
    if len(words.starts):
        doc = words.documents().astype(kind)
        shape = _shapes(words)
        for size in (1, 2, 3):
            n = len(shape) - size + 1
            if n <= 0:
                break
            code = np.full(n, size, np.uint32)
            for k in range(size):
                code = code << np.uint32(6) | shape[k : k + n]
            code = (code * np.uint32(2654435761)) >> np.uint32(32 - SHAPE_BITS)
            whole = doc[:n] == doc[size - 1 :]
            keys.append((doc[:n] << kind(ROW_BITS) | (code + np.uint32(1 << BYTE_BITS)))[whole])
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    distinct = np.sort(np.concatenate(keys))
    distinct = distinct[np.concatenate(([True], distinct[1:] != distinct[:-1]))] if len(distinct) else distinct
    return (distinct >> kind(ROW_BITS)).astype(np.int64), (distinct & kind((1 << ROW_BITS) - 1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Ratio-scaled weights, and the line that turns a margin into log odds."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    intercept: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        doc, feature = features(data, offsets)
        ratio = self.ratios[feature]
        dot = np.bincount(doc, self.weights[feature] * ratio, n)
        norm = np.sqrt(np.bincount(doc, ratio * ratio, n))
        margin = dot / np.maximum(norm, 1e-12) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.intercept, -30, 30)))


def constant(share: float) -> Model:
    zeros = np.zeros(FEATURES)
    return Model(zeros, zeros, 0.0, 0.0, float(np.log(share / (1 - share))))


def _descend(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and constant of the hinge-loss model, by dual coordinate descent.

    Rows have length 1, and a constant 1 stands for the bias.
    """
    rng = np.random.default_rng(SEED)
    weights, bias = np.zeros(FEATURES), 0.0
    alpha = np.zeros(len(rows))
    squares = np.array([v @ v + 1.0 for v in values])
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ values[i] + bias) - 1
            after = min(max(alpha[i] - gradient / squares[i], 0.0), COST)
            step = (after - alpha[i]) * signs[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = after
        if moved < 1e-3:
            break
    return weights, bias


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """The model of documents given as arrays of distinct features."""
    good = labels == 1
    share = (good.sum() + 1) / (len(labels) + 2)
    if not len(labels) or good.all() or not good.any():
        return constant(share)
    kept_out = np.arange(len(rows)) % 4 == 3
    if len(set(labels[kept_out])) < 2 or len(set(labels[~kept_out])) < 2:
        kept_out = np.zeros(len(rows), bool)
    fitted = np.flatnonzero(~kept_out)
    counts = {}
    for which in (True, False):
        mine = [rows[i] for i in fitted if good[i] == which]
        counts[which] = np.bincount(np.concatenate(mine), minlength=FEATURES) + SMOOTHING
    ratios = np.log(counts[True] / counts[True].sum()) - np.log(counts[False] / counts[False].sum())
    values = [ratios[r] / max(np.linalg.norm(ratios[r]), 1e-12) for r in rows]
    signs = np.where(good, 1.0, -1.0)
    weights, bias = _descend([rows[i] for i in fitted], [values[i] for i in fitted], signs[fitted])
    margins = np.array([weights[r] @ v + bias for r, v in zip(rows, values, strict=True)])
    calibrated = np.flatnonzero(kept_out) if kept_out.any() else fitted
    slope, intercept = _logistic(margins[calibrated], good[calibrated])
    return Model(ratios, weights, bias, slope, intercept)


def _logistic(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the log odds over a margin, by Newton steps."""
    positive, negative = good.sum(), (~good).sum()
    target = np.where(good, (positive + 1) / (positive + 2), 1 / (negative + 2))
    slope, intercept = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + intercept, -30, 30)))
        error, spread = p - target, np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([error @ margins, error.sum()])
        curve = np.array([[spread @ margins**2, spread @ margins], [spread @ margins, spread.sum()]])
        move = np.linalg.solve(curve + 1e-6 * np.eye(2), gradient)
        move = np.clip(move, -2, 2)
        slope, intercept = slope - move[0], intercept - move[1]
        if np.abs(move).max() < 1e-7:
            break
    return float(slope), float(intercept)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in runs(batch):
            data, offsets = utf8(run.column("text"))
            doc, feature = features(data, offsets)
            cuts = np.searchsorted(doc, np.arange(run.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(feature.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([run.column("doc_id"), run.column("quality"), lists], ["doc_id", "quality", "features"])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit the model to at most ``rows`` labelled documents, chosen by a hash."""
    chosen = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL AND pmod(crc32(CAST(doc_id AS STRING)), 5) <> 0")
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id")
        .limit(rows)
    )
    # ``chosen`` holds ``rows`` rows at the most, so it is small enough to send.
    sample = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .mapInArrow(_feature_rows, "doc_id long, quality int, features array<int>")
        .toArrow()
    )
    found = sorted(
        (d, tuple(f), q)
        for d, f, q in zip(sample["doc_id"].to_pylist(), sample["features"].to_pylist(), sample["quality"].to_pylist(), strict=True)
    )
    return fit([np.array(f, np.int64) for _, f, _ in found], np.array([q for _, _, q in found], np.int64))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (probability of good quality) and ``predicted``."""
    kept = docs.drop("score", "predicted")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                values = model.scores(*utf8(run.column("text")))
                columns = [*run.columns, pa.array(values), pa.array((values >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return kept.mapInArrow(scored, schema)


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, columns unchanged."""

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                yield run.filter(pa.array(model.scores(*utf8(run.column("text"))) >= threshold))

    return docs.mapInArrow(passing, docs.schema)


@registered("op7_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")

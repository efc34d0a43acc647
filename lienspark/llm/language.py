"""Language of a text by a bidirectional gated recurrent network over its bytes.

A text is cut into windows of ``STEPS`` bytes. Two gated recurrent layers, one from
each end, read a window; at every byte a softmax over both states gives the chance
of each language, and a document's chances are the mean over all its bytes. Gates
and candidates use clipped lines in place of logistic curves, in training as in
use. The network is trained in numpy by backpropagation through time, with the
document's language as the label of every byte.

It learns from windows of about ``TRAIN_DOCUMENTS`` documents of each language,
chosen by a hash, at ``TRAIN_WINDOWS`` places of the whole text; of the rows of one id
and language it learns from the least text, so rows that repeat an id never add to what
the driver holds. ``lang``,
``source`` and ``doc_id`` take no part in a prediction. Every text is read whole.

Nulls and corner cases: ``und`` with score 0 for a null text, a text without a
letter, or if there was nothing to learn from; a null ``lang`` or ``doc_id`` is not
learned from; with one language in training that one is predicted; of equal chances
the language that sorts first (by code point) is taken; repeated rows get equal results; an empty table gives an empty result; only ``doc_id``, ``text``
and, to learn, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.llm.registry import read, registered
from lienspark.llm.text import mix, runs, utf8

STEPS, HIDDEN = 64, 10
PAD = 256
TRAIN_DOCUMENTS, TRAIN_WINDOWS = 300, 8
ROUNDS, BATCH, RATE = 350, 256, 0.02
# Windows that go through the network at once.
WINDOWS = 4096
SEED = 5
UNKNOWN = "und"


@dataclass
class Network:
    """Weights by name; the last axis of all states is the window."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN) -> Network:
        rng = np.random.default_rng(SEED)
        weights = {}
        for way in ("forth", "back"):
            bytes_in = rng.normal(0, 0.3, (3 * hidden, PAD + 1))
            bytes_in[: 2 * hidden] += 0.5
            weights[f"{way}_in"] = bytes_in
            weights[f"{way}_gates"] = rng.normal(0, 0.2, (2 * hidden, hidden))
            weights[f"{way}_state"] = rng.normal(0, 0.3, (hidden, hidden))
            weights[f"{way}_out"] = rng.normal(0, 0.3, (len(languages), hidden))
        weights["out"] = np.zeros((len(languages), 1))
        return cls(languages, {name: w.astype(np.float32) for name, w in weights.items()})

    def states(self, window: np.ndarray, way: str, trace: list | None = None) -> np.ndarray:
        """States after each byte of ``window`` (steps x windows), in reading order."""
        table, gates, state = (self.weights[f"{way}_{part}"] for part in ("in", "gates", "state"))
        hidden, (steps, n) = state.shape[0], window.shape
        out = np.empty((steps, hidden, n), np.float32)
        before = np.zeros((hidden, n), np.float32)
        for step in range(steps):
            given = np.take(table, window[step], axis=1, mode="clip")
            gate = gates @ before
            gate += given[: 2 * hidden]
            np.clip(gate, 0, 1, out=gate)
            kept = gate[hidden:] * before
            new = state @ kept
            new += given[2 * hidden :]
            np.clip(new, -1, 1, out=new)
            if trace is not None:
                trace.append((before, gate, kept, new))
            after = out[step]
            np.subtract(new, before, out=after)
            after *= gate[:hidden]
            after += before
            before = after
        return out

    def chances(self, window: np.ndarray) -> Iterator[np.ndarray]:
        """Chances of the languages (languages x windows) at each byte in turn."""
        forth = self.states(window, "forth")
        back = self.states(window[::-1], "back")[::-1]
        for step in range(len(window)):
            yield self._softmax(forth[step], back[step])

    def _softmax(self, forth: np.ndarray, back: np.ndarray) -> np.ndarray:
        odds = self.weights["forth_out"] @ forth
        odds += self.weights["back_out"] @ back
        odds += self.weights["out"]
        odds -= odds.max(axis=0)
        np.exp(odds, out=odds)
        odds /= odds.sum(axis=0)
        return odds

    def gradient(self, window: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over all bytes that are no padding."""
        steps, n = window.shape
        real = window != PAD
        share = (real / max(real.sum(), 1)).astype(np.float32)
        traces: dict[str, list] = {"forth": [], "back": []}
        forth = self.states(window, "forth", traces["forth"])
        back = self.states(window[::-1], "back", traces["back"])[::-1]
        error = np.empty((steps, len(self.languages), n), np.float32)
        for step in range(steps):
            error[step] = self._softmax(forth[step], back[step])
        error[:, label, np.arange(n)] -= 1
        error *= share[:, None, :]
        found = {"out": error.sum(axis=(0, 2))[:, None]}
        for way, states, errors, read_as in (("forth", forth, error, window), ("back", back[::-1], error[::-1], window[::-1])):
            found |= self._back_through(way, states, errors, read_as, traces[way])
        return found

    def _back_through(self, way, states, errors, window, trace) -> dict[str, np.ndarray]:
        table, gates, state, out = (self.weights[f"{way}_{part}"] for part in ("in", "gates", "state", "out"))
        hidden, (steps, n) = state.shape[0], window.shape
        given = np.empty((steps, 3 * hidden, n), np.float32)
        d_gates, d_state, d_out = np.zeros_like(gates), np.zeros_like(state), np.zeros_like(out)
        carried = np.zeros((hidden, n), np.float32)
        for step in reversed(range(steps)):
            before, gate, kept, new = trace[step]
            d_out += errors[step] @ states[step].T
            d_after = out.T @ errors[step] + carried
            update = gate[:hidden]
            d_gate = np.empty_like(gate)
            d_gate[:hidden] = d_after * (new - before)
            d_new = d_after * update
            d_new *= (new > -1) & (new < 1)
            d_kept = state.T @ d_new
            d_gate[hidden:] = d_kept * before
            d_gate *= (gate > 0) & (gate < 1)
            carried = d_after * (1 - update) + d_kept * gate[hidden:] + gates.T @ d_gate
            d_state += d_new @ kept.T
            d_gates += d_gate @ before.T
            given[step, : 2 * hidden], given[step, 2 * hidden :] = d_gate, d_new
        flat, rows = window.ravel(), given.transpose(1, 0, 2).reshape(3 * hidden, -1)
        d_table = np.stack([np.bincount(flat, row, PAD + 1) for row in rows]).astype(np.float32)
        return {f"{way}_in": d_table, f"{way}_gates": d_gates, f"{way}_state": d_state, f"{way}_out": d_out}


def train_network(windows: np.ndarray, labels: np.ndarray, languages: list[str], rounds: int = ROUNDS) -> Network:
    """Fit a network to windows (rows) and their labels, by Adam steps."""
    rng = np.random.default_rng(SEED)
    network = Network.fresh(languages)
    mean = {k: np.zeros_like(w) for k, w in network.weights.items()}
    square = {k: np.zeros_like(w) for k, w in network.weights.items()}
    by_label = [np.flatnonzero(labels == k) for k in range(len(languages))]
    for turn in range(1, rounds + 1):
        drawn = rng.integers(0, len(languages), BATCH)
        rows = np.array([rng.choice(by_label[k]) for k in drawn])
        gradient = network.gradient(np.ascontiguousarray(windows[rows].T), labels[rows])
        norm = np.sqrt(sum(float((g**2).sum()) for g in gradient.values()))
        rate = RATE * min(1.0, 2 * (1 - turn / (rounds + 1)))
        for name, g in gradient.items():
            g = g / max(norm, 1.0)
            mean[name] += 0.1 * (g - mean[name])
            square[name] += 0.01 * (g**2 - square[name])
            step = mean[name] / (1 - 0.9**turn) / (np.sqrt(square[name] / (1 - 0.99**turn)) + 1e-8)
            network.weights[name] -= (rate * step).astype(np.float32)
    return network


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Windows (rows) of ``STEPS`` bytes from ``starts``, padded from ``ends`` on."""
    at = starts[:, None] + np.arange(STEPS)[None, :]
    real = at < ends[:, None]
    return np.where(real, data[np.minimum(at, len(data) - 1)].astype(np.int64), PAD)


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in runs(batch):
            data, offsets = utf8(run.column("text"))
            full = np.flatnonzero(np.diff(offsets) > 0)
            if not len(full):
                continue
            draw = mix(run.column("draw").to_numpy().view(np.uint64)[full][:, None] + np.arange(TRAIN_WINDOWS, dtype=np.uint64)[None, :])
            room = np.maximum(np.diff(offsets)[full] - STEPS // 2, 1)
            starts = (offsets[full][:, None] + (draw % room[:, None].astype(np.uint64)).astype(np.int64)).ravel()
            rows = np.repeat(full, TRAIN_WINDOWS)
            windows = cut(data, starts, offsets[rows + 1])
            yield pa.RecordBatch.from_arrays(
                [run.column("lang").take(pa.array(rows)), pa.array(draw.ravel().view(np.int64)), pa.array([w.astype(np.int16).tobytes() for w in windows], pa.binary())],
                ["lang", "draw", "piece"],
            )


def train(docs: DataFrame, documents: int = TRAIN_DOCUMENTS) -> Network | None:
    """A network for the languages of ``docs``; None if there are none to learn."""
    labelled = docs.select("doc_id", "text", "lang").where(
        r"lang IS NOT NULL AND doc_id IS NOT NULL AND pmod(crc32(CAST(doc_id AS STRING)), 4) <> 2 AND text RLIKE '\\p{L}'"
    )
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count_distinct("doc_id").alias("n")).collect()}
    if not counts:
        return None
    draw = F.xxhash64("doc_id", F.lit(SEED))
    chance = F.create_map(*(F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, documents / n))))
    unit = F.shiftrightunsigned(draw, 11).cast("double") / 2.0**53
    sample = (
        labelled.where(unit < chance[F.col("lang")])
        .groupBy("doc_id", "lang")
        .agg(F.min("text").alias("text"))
        .select("lang", "text", draw.alias("draw"))
        .mapInArrow(_samples, "lang string, draw long, piece binary")
        .toArrow()
        .sort_by([("draw", "ascending"), ("lang", "ascending")])
    )
    languages = sorted(set(sample["lang"].to_pylist()))
    if not languages:
        return None
    windows = np.stack([np.frombuffer(p, np.int16) for p in sample["piece"].to_pylist()]).astype(np.int64)
    labels = np.searchsorted(languages, sample["lang"].to_pylist())
    return train_network(windows, labels, languages)


def pooled(network: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Chances of the languages (texts x languages): the mean over a text's bytes."""
    lengths = np.diff(offsets)
    n_windows = -(-lengths // STEPS)
    text = np.repeat(np.arange(len(lengths)), n_windows)
    number = np.arange(len(text)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    starts = offsets[text] + number * STEPS
    total = np.zeros((len(lengths), len(network.languages)))
    for low in range(0, len(text), WINDOWS):
        mine = slice(low, low + WINDOWS)
        window = np.ascontiguousarray(cut(data, starts[mine], offsets[text[mine] + 1]).T)
        real = (window != PAD).astype(np.float32)
        chances = np.zeros((len(network.languages), window.shape[1]), np.float32)
        for step, now in enumerate(network.chances(window)):
            now *= real[step]
            chances += now
        for k in range(len(network.languages)):
            total[:, k] += np.bincount(text[mine], chances[k], len(lengths))
    return total / np.maximum(lengths, 1)[:, None]


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (the language's chance) of every row."""
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                names, scores = np.full(run.num_rows, UNKNOWN, object), np.zeros(run.num_rows)
                at = np.flatnonzero(run.column("lettered").to_numpy(zero_copy_only=False))
                if network is not None and len(at):
                    chances = pooled(network, *utf8(run.column("text").take(pa.array(at))))
                    best = chances.argmax(axis=1)
                    names[at] = np.array(network.languages, object)[best]
                    scores[at] = np.clip(chances[np.arange(len(at)), best], 0, 1)
                yield pa.RecordBatch.from_arrays([run.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text", lettered).mapInArrow(predicted, "doc_id long, lang_pred string, score double")


@registered("op2_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    return predict(docs, train(docs)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")

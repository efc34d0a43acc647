"""Repeated words by suffix automata of reference stretches.

A document loses every word that is covered by a window of 20 consecutive words
whose sequence also starts earlier: in a document with a smaller id, or earlier in
the same one. Windows are judged on the input, and none crosses documents. Words
are the runs of bytes between [\\x20\\x09-\\x0D], compared by 64-bit hashes.

Each shard (see ``repeats``) holds the reference stretches, those of the documents
where an anchor occurs first, before all others. It streams its stretches in order
of document and start through an automaton of what came before: the length of the
longest match that ends at a word tells whether the 20 words ending there have
occurred. Only what did not match is added to the automaton, so copies cost a
lookup a word and the automaton holds each text once. While words are added, the
length at the suffix link tells whether they repeat within the added text.

That differs from one automaton of a fixed reference sent to all tasks: here the
reference is every document, so its automata are spread by content, and a stretch
meets the one automaton that can hold its windows. A reference stretch that many
documents repeat is sent to several shards.

Nulls and corner cases: a null text has no words and keeps the digest of nothing;
fewer than 20 words lose nothing; a null ``doc_id`` counts as one document after
all others; rows that repeat an id are parts of one document in the order of their
texts, so an earlier part covers a later one, but no window crosses parts; an
empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lienspark.llm.registry import read, registered
from lienspark.llm.repeats import SPANS, Chunk, Found, Kind, Sizes, Stretches, removed_spans, repeats, word_items
from lienspark.llm.text import Words, utf8

LENGTH = 20
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


class Automaton:
    """Suffix automaton of the texts added to it."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.last, self.texts = 0, 0

    def add(self, item: int) -> int:
        """Append an item; the length of the longest suffix that occurred before."""
        following, link, length = self.next, self.link, self.length
        state, at = len(following), self.last
        following.append({})
        length.append(length[at] + 1)
        link.append(0)
        while at >= 0 and item not in following[at]:
            following[at][item] = state
            at = link[at]
        if at >= 0:
            target = following[at][item]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                copy = len(following)
                following.append(following[target].copy())
                length.append(length[at] + 1)
                link.append(link[target])
                link[target] = link[state] = copy
                while at >= 0 and following[at].get(item) == target:
                    following[at][item] = copy
                    at = link[at]
        self.last = state
        return length[link[state]]

    def add_text(self, items: list[int]) -> list[int]:
        """Append a text after a mark of its own; for each item what ``add`` says."""
        self.texts += 1
        self.add(-self.texts)
        return [self.add(item) for item in items]

    def matches(self, items: list[int]) -> list[int]:
        """Matching statistics: the longest match that ends at each item."""
        following, link, length = self.next, self.link, self.length
        state, size, sizes = 0, 0, []
        for item in items:
            to = following[state].get(item)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = following[state].get(item)
            if to is not None:
                state, size = to, size + 1
            sizes.append(size)
        return sizes


def matched(stretches: Stretches) -> Found:
    """Windows of the shard that occurred in an earlier stretch or place."""
    length = stretches.length
    covered = np.zeros(len(stretches.items), bool)
    left = np.zeros(len(stretches.items), bool)
    names = np.unique(stretches.items, return_inverse=True)[1].tolist()
    bounds = stretches.bounds.tolist()
    automaton = Automaton()
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        items = names[begin:end]
        seen = np.array(automaton.matches(items)[length - 1 :]) >= length
        covered[begin : begin + len(seen)] = seen
        edge = np.diff(np.concatenate(([0], (~seen).view(np.int8), [0])))
        for low, high in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            before = np.array(automaton.add_text(items[low : high + length - 1])[length - 1 :])
            covered[begin + low : begin + high] = before >= length
            left[begin + low : begin + high] = before < length
    return Found(covered, left)


def joined(words: Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words, each with a blank behind, and the texts' bounds."""
    starts, lengths = words.starts[kept], (words.ends - words.starts)[kept]
    places = np.cumsum(lengths + 1) - lengths - 1
    out = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[within + np.repeat(places, lengths)] = words.data[within + np.repeat(starts, lengths)]
    ends = np.concatenate(([0], np.cumsum(lengths + 1)))
    count = np.concatenate(([0], np.cumsum(kept)))
    return out, ends[count[words.bounds]]


def report(chunk: Chunk, covered: np.ndarray) -> pa.Table:
    """Per row of a chunk, the words removed and the digest of the rest."""
    words = Words(*utf8(chunk.table.column("text")))
    data, cuts = joined(words, ~covered)
    gone = np.concatenate(([0], np.cumsum(covered)))
    cuts = cuts.tolist()
    return pa.table(
        {
            "doc_id": chunk.table.column("doc_id"),
            "n_words": pa.array(np.diff(chunk.bounds)),
            "n_removed": pa.array(np.diff(gone[chunk.bounds])),
            "kept_sha256": pa.array(
                [hashlib.sha256(data[a : max(a, b - 1)]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.string()
            ),
        }
    )


KIND = Kind(length=LENGTH, gram=8, segment=256, within=True, items=word_items, matcher=matched)


def without_repeats(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """Words, removed words and the digest of the rest, of every row."""
    return repeats(docs, KIND, np.uint64, report, RESULT, sizes)


def remaining(chunk: Chunk, covered: np.ndarray) -> pa.Table:
    """Per row of a chunk, the words that are kept, joined, and the runs that are not."""
    data, cuts = joined(Words(*utf8(chunk.table.column("text"))), ~covered)
    cuts = cuts.tolist()
    kept = pa.array([data[a : max(a, b - 1)].tobytes().decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.string())
    return pa.table({"doc_id": chunk.table.column("doc_id"), "kept": kept, "spans": removed_spans(chunk.bounds, covered)})


def deduplicated(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """``kept`` (words joined by a blank) and ``spans`` (removed words) of every row,
    null texts being empty."""
    return repeats(docs, KIND, np.uint64, remaining, f"doc_id long, kept string, spans {SPANS}", sizes)


ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
spread AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM t),
sequences AS (
  SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS words FROM spread),
windows AS (
  SELECT doc_id, i, min((doc_id, i)) OVER (PARTITION BY hash(words)) AS first FROM sequences WHERE len(words) = 20),
covered AS (
  SELECT DISTINCT doc_id, i + k AS i FROM windows, range(20) o(k) WHERE (doc_id, i) > first),
kept AS (
  SELECT doc_id, count(*) AS m, string_agg(word, ' ' ORDER BY i) AS rest FROM spread ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(m, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)"""


@registered("op9_suffix_automaton_dedup", ORACLE)
def suffix_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read(spark, sf_dir, "documents"))

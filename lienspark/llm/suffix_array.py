"""Repeated bytes by a suffix array, sorted with bucket-pointer refinement.

A document loses every byte that is covered by a 50-byte string which also starts
in a document with a smaller id. Strings are judged on the input, overlaps count,
and no string crosses documents. Texts are taken as UTF-8 bytes.

The suffixes of a shard's stretches (see ``repeats``) are first put in buckets by
their q-gram. A bucket is refined by sorting its suffixes by the buckets of the
suffixes ``depth`` bytes later, which doubles the depth; the new bucket numbers
are what the next turn refines by, until 50 bytes are told apart. Suffixes alone
in their bucket are left out of later sorts.

Nulls and corner cases: a null text is empty and keeps the digest of no bytes; a
text shorter than 50 bytes loses nothing; a null ``doc_id`` counts as one document
after all others; rows that repeat an id are parts of one document, so they do not
cover each other; an empty table gives an empty result; only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lienspark.llm.registry import read, registered
from lienspark.llm.repeats import SPANS, Chunk, Found, Kind, Sizes, Stretches, byte_items, removed_spans, repeats

LENGTH = 50
Q = 5
# Up to so many suffixes a key of PACKED_KEY bits and a place go into one number.
PACKED_PLACE, PACKED_KEY = 21, 42
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense numbers of the keys in their order.

    Where a key and its place fit in one number those are sorted, which is several
    times faster than sorting places by key.
    """
    if len(keys) <= 1 << PACKED_PLACE and (not len(keys) or int(keys.max()) < 1 << PACKED_KEY):
        packed = np.sort(keys << np.uint64(PACKED_PLACE) | np.arange(len(keys), dtype=np.uint64))
        order = (packed & np.uint64((1 << PACKED_PLACE) - 1)).astype(np.int64)
        ordered = packed >> np.uint64(PACKED_PLACE)
    else:
        order = np.argsort(keys)
        ordered = keys[order]
    new = np.zeros(len(keys), np.int64)
    new[1:] = ordered[1:] != ordered[:-1]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def buckets(items: np.ndarray, bounds: np.ndarray, length: int, q: int = Q) -> tuple[np.ndarray, np.ndarray]:
    """Positions with ``length`` bytes left in their stretch, and bucket numbers that
    are equal exactly where those bytes are."""
    n = len(items)
    room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
    q = min(q, length)
    gram = np.zeros(n, np.uint64)
    for k in range(q):
        gram[: n - k] |= items[k:].astype(np.uint64) << np.uint64(8 * k)
    pointer = np.zeros(n, np.int64)
    held = np.flatnonzero(room >= q)
    pointer[held] = _ranks(gram[held])
    depth = q
    while depth < length:
        step = min(depth, length - depth)
        held = np.flatnonzero(room >= depth + step)
        shared = np.bincount(pointer[held], minlength=1)[pointer[held]] > 1
        more, alone = held[shared], held[~shared]
        bits = np.uint64(int(n).bit_length())
        refined = _ranks(pointer[more].astype(np.uint64) << bits | pointer[more + step].astype(np.uint64))
        count = int(refined.max()) + 1 if len(refined) else 0
        turned = np.zeros(n, np.int64)
        turned[more] = refined
        turned[alone] = count + np.arange(len(alone))
        pointer, depth = turned, depth + step
    return held, pointer[held]


def matched(stretches: Stretches) -> Found:
    """Windows of the shard that a document with a smaller id holds too."""
    n = len(stretches.items)
    covered, left = np.zeros(n, bool), np.zeros(n, bool)
    held, bucket = buckets(stretches.items, stretches.bounds, stretches.length)
    if len(held):
        order = np.argsort(bucket, kind="stable")
        spot = held[order]
        new = np.ones(len(spot), bool)
        new[1:] = bucket[order][1:] != bucket[order][:-1]
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        stretch = np.searchsorted(stretches.bounds[1:], spot, "right")
        doc = stretches.docs[stretch]
        covered[spot] = doc > doc[head][group]
        explained = np.logical_or.reduceat(stretches.first[stretch], head)[group]
        left[spot] = ~covered[spot] & ~explained
    return Found(covered, left)


def report(chunk: Chunk, covered: np.ndarray) -> pa.Table:
    """Per row of a chunk, what is removed and the digest of what is kept."""
    bounds = chunk.bounds
    opens = covered.copy()
    opens[1:] &= ~covered[:-1]
    inner = bounds[:-1][bounds[:-1] < len(covered)]
    opens[inner] = covered[inner]
    gone = np.concatenate(([0], np.cumsum(covered)))
    spans = np.concatenate(([0], np.cumsum(opens)))
    kept = np.ascontiguousarray(chunk.items[~covered])
    cuts = (bounds - gone[bounds]).tolist()
    return pa.table(
        {
            "doc_id": chunk.table.column("doc_id"),
            "n_bytes": pa.array(np.diff(bounds)),
            "n_removed": pa.array(np.diff(gone[bounds])),
            "n_spans": pa.array(np.diff(spans[bounds])),
            "kept_sha256": pa.array([hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.string()),
        }
    )


KIND = Kind(length=LENGTH, gram=24, segment=2048, within=False, items=byte_items, matcher=matched)


def without_repeats(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """Bytes, removed bytes and runs, and the digest of the rest, of every row."""
    return repeats(docs, KIND, np.uint8, report, RESULT, sizes)


def remaining(chunk: Chunk, covered: np.ndarray) -> pa.Table:
    """Per row of a chunk, the bytes that are kept and the runs that are not."""
    data = np.ascontiguousarray(chunk.items[~covered])
    cuts = np.concatenate(([0], np.cumsum(~covered)))[chunk.bounds].tolist()
    kept = pa.array([data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
    return pa.table({"doc_id": chunk.table.column("doc_id"), "kept": kept, "spans": removed_spans(chunk.bounds, covered)})


def deduplicated(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """``kept`` (bytes, since a run may end inside a character) and ``spans`` (removed
    bytes) of every row, null texts being empty."""
    return repeats(docs, KIND, np.uint8, remaining, f"doc_id long, kept binary, spans {SPANS}", sizes)


# Bytes as pairs of hexadecimal digits; windows by a hash of theirs, as runs of starts.
ORACLE = f"""
WITH t AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits, len(hex(encode(coalesce(text, '')))) // 2 AS n FROM documents),
starts AS (SELECT doc_id, digits, unnest(range(n - {LENGTH - 1})) AS i FROM t WHERE n >= {LENGTH}),
windows AS (SELECT doc_id, i, hash(substr(digits, 2 * i + 1, {2 * LENGTH})) AS key FROM starts),
firsts AS (SELECT key, min(doc_id) AS first FROM windows GROUP BY key HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT w.doc_id, w.i, lag(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS last
  FROM windows w JOIN firsts f ON w.key = f.key WHERE f.first < w.doc_id),
numbered AS (
  SELECT doc_id, i, sum(CASE WHEN last IS NULL OR i > last + {LENGTH} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM gone),
spans AS (SELECT doc_id, span, min(i) AS start, max(i) + {LENGTH} AS stop FROM numbered GROUP BY doc_id, span),
between_spans AS (
  SELECT s.doc_id, start, stop, substr(digits, 2 * coalesce(lag(stop) OVER (PARTITION BY s.doc_id ORDER BY start), 0) + 1,
    2 * (start - coalesce(lag(stop) OVER (PARTITION BY s.doc_id ORDER BY start), 0))) AS rest
  FROM spans s JOIN t ON t.doc_id = s.doc_id),
sums AS (
  SELECT doc_id, sum(stop - start) AS removed, count(*) AS spans, max(stop) AS stop, string_agg(rest, '' ORDER BY start) AS rest
  FROM between_spans GROUP BY doc_id)
SELECT t.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(rest, '') || substr(digits, 2 * coalesce(stop, 0) + 1))) AS kept_sha256
FROM t LEFT JOIN sums s ON t.doc_id = s.doc_id"""


@registered("op5_suffix_array_dedup", ORACLE)
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read(spark, sf_dir, "documents"))

"""Texts of an Arrow batch as one byte array, with words and their hashes.

Everything works on whole arrays: a batch of documents is one run of bytes with
the documents' offsets, and a word is a pair of positions in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The six bytes that part words, [\x20\x09-\x0D].
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RNG = np.random.default_rng(20240229)
BYTE_CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)

# Documents are handled in runs of about so many bytes, so that a task's arrays
# stay small whatever the size of its batch; a longer document is a run by itself.
RUN_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: none) and the n + 1 offsets of the texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if not (pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_string())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def runs(batch: pa.RecordBatch | pa.Table, column: str = "text", limit: int = RUN_BYTES) -> Iterator[pa.RecordBatch | pa.Table]:
    """Cut a batch into slices of about ``limit`` bytes of text, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """Words of a run of documents.

    ``starts`` and ``ends`` are byte positions in ``data``; the words of document
    ``d`` are those numbered ``bounds[d]`` to ``bounds[d + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        if n == 0:
            self.starts = self.ends = np.empty(0, np.int64)
            self.bounds = np.zeros(len(offsets), np.int64)
            return
        solid = ~IS_SPACE[data]
        opens = np.empty(n, bool)
        opens[0] = True
        np.logical_not(solid[:-1], out=opens[1:])
        inner = offsets[1:-1]
        inner = inner[inner < n]
        opens[inner] = True
        closes = np.empty(n, bool)
        closes[-1] = True
        np.logical_not(solid[1:], out=closes[:-1])
        closes[inner[inner > 0] - 1] = True
        self.starts = np.flatnonzero(opens & solid)
        self.ends = np.flatnonzero(closes & solid) + 1
        self.bounds = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        return span_hashes(self.data, self.starts, self.ends)

    def documents(self) -> np.ndarray:
        """The document number of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the ordered, disjoint, non-empty byte spans."""
    lengths = ends - starts
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    within = np.arange(total) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), STEP, np.uint64))
    values = BYTE_CODES[data[within + np.repeat(starts, lengths)]] * powers[within]
    return mix(np.add.reduceat(values, first))


def gram_hashes(items: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive 64-bit items, by their first position.

    The hash of a + b items is put together from those of a and of b items, so the
    work grows with the logarithm of ``size``.
    """
    if len(items) < size:
        return np.empty(0, np.uint64)
    total, done = None, 0
    part, width, power = items, 1, STEP
    while True:
        if size & width:
            total = part.copy() if total is None else total[: len(part) - done] * power + part[done:]
            done += width
        if done == size:
            return mix(total[: len(items) - size + 1])
        n = len(part) - width
        part, width = part[:n] * power + part[width:], width * 2
        power = np.uint64(int(power) ** 2 % 2**64)


def inside(bounds: np.ndarray, size: int, n: int) -> np.ndarray:
    """Whether ``size`` items from each of ``n`` positions stay in one document.

    ``bounds`` are the documents' first items; there are ``bounds[-1]`` items.
    """
    ends = np.repeat(bounds[1:], np.diff(bounds))[:n]
    return np.arange(n) + size <= ends

"""Benchmark decontamination by SimHash windows and a multi-index.

A document leaks an item if some window of as many words as the item has (or the
whole document, if it is shorter) has a weighted Jaccard similarity of 0.8 or more
with it, over 5-word shingles counted with their repeats. Words are lower-case
runs of letters and digits: ASCII punctuation parts words as white space does, and
A-Z and the capitals U+00C0 to U+00DE are folded. An item of fewer than five words
is one shingle and must occur as it is; items without a word match nothing.

Each window gets a 64-bit SimHash of its shingles. The items' fingerprints are
indexed by eight blocks of eight bits; a fingerprint within 20 bits of another
agrees with it in some block up to two bits, so probing every block's keys within
two bits finds all fingerprints within the radius. What the probe finds is then
compared exactly. Windows that share no shingle with any item are not
fingerprinted: their similarity is 0.

The benchmark is taken in blocks of ``BLOCK_ITEMS`` items, so what is sent to the
executors has a bound at any size of it.

Nulls and corner cases: a null or empty text leaks nothing; an item with a null
text is ignored; null ids are carried along; of repeated items each is reported;
repeated documents each get their rows; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.llm.registry import read, registered
from lienspark.llm.text import Words, gram_hashes, inside, mix, runs, utf8

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS = 8, 8
RADIUS = 20
NEAR_BITS = RADIUS // BLOCKS
BLOCK_ITEMS = 10_000
FILTER_BITS = 20

_PARTS = np.zeros(256, bool)
_PARTS[:0x30] = _PARTS[0x3A:0x41] = _PARTS[0x5B:0x61] = _PARTS[0x7B:0x80] = True


def folded(data: np.ndarray) -> np.ndarray:
    """Lower-case bytes, with a blank for each ASCII byte that is no letter or digit."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 0x20
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 0x20
    out[_PARTS[data]] = 0x20
    return out


def _words(column: pa.Array | pa.ChunkedArray) -> Words:
    data, offsets = utf8(column)
    return Words(folded(data), offsets)


def fingerprints(grams: np.ndarray) -> np.ndarray:
    """SimHash of each row of shingle hashes."""
    n, width = grams.shape
    bits = np.unpackbits(np.ascontiguousarray(mix(grams)).view(np.uint8).reshape(n, width, 8), axis=2)
    return np.packbits(bits.sum(axis=1, dtype=np.int32) * 2 > width, axis=1).view(np.uint64).ravel()


def weighted_jaccard(window: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> float:
    """Similarity of a window's shingles and an item's sorted, counted ones."""
    mine, times = np.unique(window, return_counts=True)
    spot = np.minimum(np.searchsorted(grams, mine), len(grams) - 1)
    common = grams[spot] == mine
    both = np.minimum(times[common], counts[spot[common]]).sum()
    return float(both / (len(window) + counts.sum() - both))


@dataclass
class Index:
    """Items of a benchmark block and the multi-index of their fingerprints."""

    ids: list
    sizes: np.ndarray
    grams: list[np.ndarray]
    counts: list[np.ndarray]
    prints: np.ndarray
    keys: np.ndarray  # distinct shingles of all items, in order
    owner_at: np.ndarray  # bounds in ``owners``, by shingle
    owners: np.ndarray  # items, by shingle
    starts: np.ndarray  # by block and key, bounds in ``listed``
    listed: list[np.ndarray]

    @classmethod
    def of(cls, ids: list, texts: list) -> Index:
        words = _words(pa.array(texts, pa.string()))
        hashes, bounds = words.hashes(), words.bounds
        kept, sizes, grams, counts, prints = [], [], [], [], []
        for i in range(len(ids)):
            mine = hashes[bounds[i] : bounds[i + 1]]
            if not len(mine):
                continue
            row = gram_hashes(mine, min(SHINGLE, len(mine)))
            kept.append(ids[i])
            sizes.append(len(mine))
            prints.append(fingerprints(row[None, :])[0])
            distinct, times = np.unique(row, return_counts=True)
            grams.append(distinct)
            counts.append(times)
        prints = np.array(prints, np.uint64)
        flat = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams]).astype(np.int64)
        order = np.lexsort((item, flat))
        keys, at = np.unique(flat[order], return_index=True)
        near = np.array([k for k in range(1 << BLOCK_BITS) if k.bit_count() <= NEAR_BITS])
        starts, listed = [], []
        for block in range(BLOCKS):
            own = (prints >> np.uint64(block * BLOCK_BITS)).astype(np.int64) & ((1 << BLOCK_BITS) - 1)
            key = (own[:, None] ^ near[None, :]).ravel()
            who = np.repeat(np.arange(len(prints)), len(near))
            by_key = np.argsort(key, kind="stable")
            listed.append(who[by_key])
            starts.append(np.searchsorted(key[by_key], np.arange((1 << BLOCK_BITS) + 1)))
        return cls(kept, np.array(sizes, np.int64), grams, counts, prints, keys, np.append(at, len(flat)), item[order], np.array(starts), listed)

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a given fingerprint and an item at most ``RADIUS`` bits apart."""
        pairs = []
        for block in range(BLOCKS):
            key = (prints >> np.uint64(block * BLOCK_BITS)).astype(np.int64) & ((1 << BLOCK_BITS) - 1)
            low, high = self.starts[block][key], self.starts[block][key + 1]
            n = high - low
            mine = np.repeat(np.arange(len(prints)), n)
            item = self.listed[block][np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
            close = np.bitwise_count(prints[mine] ^ self.prints[item]) <= RADIUS
            pairs.append(mine[close] * len(self.prints) + item[close])
        pairs = np.unique(np.concatenate(pairs))
        return pairs // len(self.prints), pairs % len(self.prints)

    def leaks(self, words: Words) -> dict[tuple[int, int], tuple[float, int, int]]:
        """Best window of each document and item: similarity, first word, words."""
        found: dict[tuple[int, int], tuple[float, int, int]] = {}
        if not self.ids:
            return found
        hashes, bounds = words.hashes(), words.bounds
        documents = words.documents()
        sizes = np.diff(bounds)
        sieve = np.zeros(1 << FILTER_BITS, bool)
        sieve[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        for size in sorted({min(SHINGLE, int(s)) for s in self.sizes}):
            grams = gram_hashes(hashes, size)
            hit = np.flatnonzero(sieve[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] & inside(bounds, size, len(grams)))
            key = np.minimum(np.searchsorted(self.keys, grams[hit]), len(self.keys) - 1)
            real = self.keys[key] == grams[hit]
            hit, key = hit[real], key[real]
            if not len(hit):
                continue
            n = self.owner_at[key + 1] - self.owner_at[key]
            spot = np.repeat(hit, n)
            item = self.owners[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.owner_at[key], n)]
            fits = np.minimum(self.sizes[item], SHINGLE) == size
            spot, item = spot[fits], item[fits]
            doc = documents[spot]
            length = np.minimum(self.sizes[item], sizes[doc])
            wanted = np.unique(np.stack((length, spot, doc), axis=1), axis=0)
            for width in np.unique(wanted[:, 0]):
                rows = wanted[wanted[:, 0] == width]
                reach = int(width) - size
                first = np.maximum(rows[:, 1] - reach, bounds[rows[:, 2]])
                last = np.minimum(rows[:, 1], bounds[rows[:, 2] + 1] - width)
                n = last - first + 1
                starts = np.unique(np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n))
                for at in range(0, len(starts), 512):
                    some = starts[at : at + 512]
                    table = grams[some[:, None] + np.arange(reach + 1)[None, :]]
                    window, near = self.within(fingerprints(table))
                    for w, i in zip(window.tolist(), near.tolist(), strict=True):
                        if min(SHINGLE, int(self.sizes[i])) != size:
                            continue
                        similarity = weighted_jaccard(table[w], self.grams[i], self.counts[i])
                        if similarity >= SIMILARITY - 1e-9:
                            d = int(documents[some[w]])
                            best = (similarity, int(bounds[d] - some[w]), int(width))
                            found[d, i] = max(found.get((d, i), best), best)
        return {(d, i): (s, -start, width) for (d, i), (s, start, width) in found.items()}


def indexes(benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> Iterator[Index]:
    """The benchmark's blocks, at most about ``block_items`` items in each."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    blocks = -(-items.count() // block_items)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    for number in range(blocks):
        rows = items.where(block == number).orderBy("item_id", "text").toArrow()
        yield Index.of(rows["item_id"].to_pylist(), rows["text"].to_pylist())


def _leaking(index: Index):
    def leaking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                found = sorted(index.leaks(_words(run.column("text"))).items())
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            run.column("doc_id").take(pa.array([d for (d, _), _ in found], pa.int64())),
                            pa.array([index.ids[i] for (_, i), _ in found], pa.int64()),
                            pa.array([s for _, (s, _, _) in found], pa.float64()),
                            pa.array([f for _, (_, f, _) in found], pa.int64()),
                            pa.array([w for _, (_, _, w) in found], pa.int64()),
                        ],
                        ["doc_id", "item_id", "similarity", "first_word", "n_words"],
                    )

    return leaking


def leaks(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Pairs of a document and an item it holds, with the best window."""
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    result = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(benchmark, block_items):
        result = result.union(docs.select("doc_id", "text").mapInArrow(_leaking(index), schema))
    return result


def keep(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` that hold no item, columns unchanged."""

    def clean(index: Index):
        def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for run in runs(batch):
                    good = np.ones(run.num_rows, bool)
                    good[[d for d, _ in index.leaks(_words(run.column("text")))]] = False
                    yield run.filter(pa.array(good))

        return passing

    for index in indexes(benchmark, block_items):
        docs = docs.mapInArrow(clean(index), docs.schema)
    return docs


@registered("op3_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))

"""Repeated runs of items (bytes or words) over all documents, found by anchors.

The question is which windows of ``length`` consecutive items of a document also
start earlier: in a document with a smaller id, or, if ``within`` is set, earlier
in the same one. It is answered exactly, without shuffling every window:

1. Documents are dealt to chunks by a hash of the id. In each window the k-gram
   with the least hash is its anchor, so equal windows have equal anchors, and
   about two in (length - k + 2) positions are anchors. Each chunk sends its distinct
   anchors, packed by hash bucket, with the first document that holds them.
2. Each bucket finds the anchors that occur again and answers every chunk that
   asked with the anchor's first document and the segment of it.
3. Each chunk cuts out the stretches of windows with such anchors and sends them to
   the shard of that document and segment; equal windows meet there. A shard finds
   equal windows by the operator's own method (a ``Matcher``).
4. The stretches of an anchor with many occurrences are dealt over several shards,
   each of which gets the first document's stretch too. What that does not explain
   is compared by 128-bit digests in buckets, after a shard has reduced it to the
   first of each kind.
5. Covered intervals go back to the chunks.

All five steps are one plan in which the exchange of the texts by chunk is used
again. No task needs more than a chunk, a bucket or a shard, whose sizes are
parameters, except a single document longer than that; the number of entries of one
anchor in a bucket is at most the number of chunks.

Rows that repeat an id are one document whose parts no window crosses, in the order
of their texts. A null id counts as one document after all others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lienspark.llm.io import text_bytes
from lienspark.llm.text import BYTE_CODES, Words, gram_hashes, inside, mix, utf8

LAST_ID = 2**63 - 1
KEY_BITS = 40


@dataclass(frozen=True)
class Sizes:
    """Bytes of text per chunk, bucket, shard and bucket of open windows, and
    occurrences per shard of an anchor.

    A chunk has ``asked`` bytes for every bucket at the least, so that what it sends to
    one is some 70 anchors and not a row for each, until it is ``widest``.
    """

    chunk: int = 1 << 20
    bucket: int = 16 << 20
    shard: int = 2 << 20
    open: int = 16 << 20
    occurrences: int = 256
    asked: int = 1 << 10
    widest: int = 4 << 20

    def chunk_of(self, total: int) -> int:
        return min(max(self.chunk, self.asked * total // self.bucket), max(self.chunk, self.widest))


@dataclass(frozen=True)
class Kind:
    """What is compared: items, window and anchor lengths, and a segment's items."""

    length: int
    gram: int
    segment: int
    within: bool
    # Texts of a column as items and the bounds of each text in them.
    items: Callable[[pa.ChunkedArray], tuple[np.ndarray, np.ndarray]]
    # Windows of a shard's stretches: see ``Stretches``.
    matcher: Callable[[Stretches], Found]


@dataclass(frozen=True)
class Stretches:
    """A shard's stretches, in order of document and start, one after the other.

    Stretch s is ``items[bounds[s] : bounds[s + 1]]`` and starts at ``starts[s]`` of
    document ``docs[s]``; ``first[s]`` tells whether that is its anchors' first
    document.
    """

    items: np.ndarray
    bounds: np.ndarray
    docs: np.ndarray
    starts: np.ndarray
    first: np.ndarray
    length: int


@dataclass(frozen=True)
class Found:
    """By position: whether the window there is covered, and whether it is known so.

    A window is ``open`` if it is not covered here and no stretch of its anchors'
    first document holds it.
    """

    covered: np.ndarray
    open: np.ndarray


# --- Anchors -----------------------------------------------------------------


def _sliding(values: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``size`` consecutive values, by their first position."""
    n = len(values) - size + 1
    width, part = 1, values
    while width * 2 <= size:
        part = pick(part[: len(part) - width], part[width:])
        width *= 2
    return pick(part[:n], part[size - width : size - width + n])


def wide(items: np.ndarray) -> np.ndarray:
    """Items as 64-bit numbers whose bits are spread."""
    return BYTE_CODES[items] if items.dtype == np.uint8 else items


def window_anchors(items: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor hash of the window at each position (0: no whole window), and
    the grams' hashes."""
    hashes = gram_hashes(wide(items), gram)
    if len(items) < length:
        return np.empty(0, np.uint64), hashes
    hashes |= np.uint64(1)
    least = _sliding(hashes, length - gram + 1, np.minimum)
    least[~inside(bounds, length, len(least))] = 0
    return least, hashes


def anchor_positions(least: np.ndarray, hashes: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Positions of the grams that are the anchor of some window."""
    if not len(least):
        return np.empty(0, np.int64)
    width = length - gram + 1
    padded = np.zeros(len(hashes) + width - 1, np.uint64)
    padded[width - 1 : width - 1 + len(least)] = least
    return np.flatnonzero(_sliding(padded, width, np.maximum) == hashes)


# --- A chunk's documents -------------------------------------------------------


class Chunk:
    """A chunk's rows in order of id and text; rows of an id are one document."""

    def __init__(self, table: pa.Table, kind: Kind):
        ids = pc.fill_null(table.column("doc_id"), LAST_ID).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        if (np.diff(ids[order]) == 0).any():
            texts = table.column("text").to_pylist()
            order = np.array(sorted(range(len(ids)), key=lambda r: (ids[r], texts[r] is not None, texts[r] or "")))
        self.table = table.take(pa.array(order))
        self.row_ids = ids[order]
        self.items, self.bounds = kind.items(self.table.column("text"))
        self.ids, first_row = np.unique(self.row_ids, return_index=True)
        self.doc_bounds = np.append(self.bounds[:-1][first_row], self.bounds[-1])

    def documents_at(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_bounds[1:], positions, "right")


def _planes(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and in-bucket key of a mixed hash.

    Anchors are the least hashes of their windows: their leading bits are mostly zero,
    and only mixed once more do they spread evenly over the buckets.
    """
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    return bucket, keys >> np.uint64(64 - KEY_BITS - bits) & np.uint64((1 << KEY_BITS) - 1)


def _join_key(low: bytes, high: bytes) -> np.ndarray:
    return np.frombuffer(low, np.uint32).astype(np.uint64) | np.frombuffer(high, np.uint8).astype(np.uint64) << np.uint64(32)


def _small(values: np.ndarray) -> np.ndarray:
    """The same numbers in the fewest bytes."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _numbers(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}" if n else np.uint8).astype(np.int64)


ASKED = "bucket int, chunk int, low binary, high binary, ids binary, doc binary, segment binary, times binary"
ANSWERED = "chunk int, bucket int, low binary, high binary, ids binary, doc binary, segment binary, dealt binary"
STRETCHED = "shard long, chunk int, doc_id long, start long, first boolean, dealt boolean, items binary"
MATCHED = "place long, ids binary, chunks binary, starts binary, ends binary, digests binary"
COVERED = "chunk int, ids binary, starts binary, ends binary"


def _schema(text: str) -> pa.Schema:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, types[kind]) for name, kind in (part.split() for part in text.split(", "))])


def _table(rows: list[tuple], text: str) -> pa.Table:
    schema = _schema(text)
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _asks(kind: Kind, bits: int):
    """Step 1: a chunk's distinct anchors, by bucket."""

    def asks(key, table):
        chunk = Chunk(table, kind)
        least, hashes = window_anchors(chunk.items, chunk.bounds, kind.length, kind.gram)
        spots = anchor_positions(least, hashes, kind.length, kind.gram)
        keys = mix(hashes[spots])
        order = np.argsort(keys, kind="stable")
        spots, keys = spots[order], keys[order]
        docs = chunk.documents_at(spots)
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(new)
        if kind.within:
            times = np.diff(np.append(at, len(keys)))
        else:
            fresh = new.copy()
            fresh[1:] |= docs[1:] != docs[:-1]
            times = np.add.reduceat(fresh.astype(np.int64), at) if len(at) else at
        keys, docs, spots = keys[at], docs[at], spots[at]
        segments = (spots - chunk.doc_bounds[docs]) // kind.segment
        bucket, small = _planes(keys, bits)
        rows = []
        cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            part = slice(cuts[b], cuts[b + 1])
            ids, doc = np.unique(docs[part], return_inverse=True)
            rows.append(
                (
                    b,
                    key[0].as_py(),
                    small[part].astype(np.uint32).tobytes(),
                    (small[part] >> np.uint64(32)).astype(np.uint8).tobytes(),
                    chunk.ids[ids].tobytes(),
                    _small(doc).tobytes(),
                    _small(segments[part]).tobytes(),
                    _small(times[part]).tobytes(),
                )
            )
        return _table(rows, ASKED)

    return asks


def _answers(occurrences: int):
    """Step 2: for each chunk, its anchors that occur again, and where first.

    ``dealt`` is the base-2 logarithm of the number of shards an anchor is dealt to.
    """

    def answers(key, table):
        keys, ids, segments, times, asker = [], [], [], [], []
        for number, row in enumerate(table.to_pylist()):
            part = _join_key(row["low"], row["high"])
            keys.append(part)
            ids.append(np.frombuffer(row["ids"], np.int64)[_numbers(row["doc"], len(part))])
            segments.append(_numbers(row["segment"], len(part)))
            times.append(_numbers(row["times"], len(part)))
            asker.append(np.full(len(part), number, np.int32))
        chunks = table.column("chunk").to_numpy()
        keys, ids, segments, times, asker = map(np.concatenate, (keys, ids, segments, times, asker))
        order = np.lexsort((ids, keys))
        keys, ids, segments, times, asker = keys[order], ids[order], segments[order], times[order], asker[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(new)
        total = np.add.reduceat(times, at)
        group = np.cumsum(new) - 1
        again = total[group] > 1
        many = np.maximum(0, np.ceil(np.log2(np.maximum(total / occurrences, 1)))).astype(np.int64)
        many[many == 1] = 0
        group = group[again]
        keys, asker = keys[again], asker[again]
        first, segment, dealt = ids[at][group], segments[at][group], many[group]
        order = np.argsort(asker, kind="stable")
        cuts = np.searchsorted(asker[order], np.arange(len(chunks) + 1))
        rows = []
        for number in np.flatnonzero(np.diff(cuts)).tolist():
            part = order[cuts[number] : cuts[number + 1]]
            names, doc = np.unique(first[part], return_inverse=True)
            rows.append(
                (
                    int(chunks[number]),
                    key[0].as_py(),
                    keys[part].astype(np.uint32).tobytes(),
                    (keys[part] >> np.uint64(32)).astype(np.uint8).tobytes(),
                    names.tobytes(),
                    _small(doc).tobytes(),
                    _small(segment[part]).tobytes(),
                    _small(dealt[part]).tobytes(),
                )
            )
        return _table(rows, ANSWERED)

    return answers


def _stretches(kind: Kind, bits: int, shards: int):
    """Step 3: a chunk's stretches of windows whose anchors occur again."""

    def stretches(key, texts, answers):
        if not texts.num_rows or not answers.num_rows:
            return _table([], STRETCHED)
        chunk = Chunk(texts, kind)
        known, first, segment, dealt = [], [], [], []
        for row in answers.to_pylist():
            part = _join_key(row["low"], row["high"])
            known.append(part | np.uint64(row["bucket"]) << np.uint64(KEY_BITS))
            first.append(np.frombuffer(row["ids"], np.int64)[_numbers(row["doc"], len(part))])
            segment.append(_numbers(row["segment"], len(part)))
            dealt.append(_numbers(row["dealt"], len(part)))
        known, first, segment, dealt = map(np.concatenate, (known, first, segment, dealt))
        order = np.argsort(known)
        known, first, segment, dealt = known[order], first[order], segment[order], dealt[order]

        least, _ = window_anchors(chunk.items, chunk.bounds, kind.length, kind.gram)
        turn = np.ones(len(least), bool)
        turn[1:] = least[1:] != least[:-1]
        starts = np.flatnonzero(turn)
        ends = np.append(starts[1:], len(least))
        bucket, small = _planes(mix(least[starts]), bits)
        wanted = small | bucket.astype(np.uint64) << np.uint64(KEY_BITS)
        spot = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        again = (known[spot] == wanted) & (least[starts] != 0)
        starts, ends, spot = starts[again], ends[again], spot[again]
        if not len(starts):
            return _table([], STRETCHED)
        rows = np.searchsorted(chunk.bounds[1:], starts, "right")
        # One window's run of equal anchors after the other is one stretch while
        # row, first document, segment and dealing stay the same.
        apart = np.ones(len(starts), bool)
        apart[1:] = (
            (starts[1:] != ends[:-1])
            | (rows[1:] != rows[:-1])
            | (first[spot][1:] != first[spot][:-1])
            | (segment[spot][1:] != segment[spot][:-1])
            | (dealt[spot][1:] != dealt[spot][:-1])
        )
        head = np.flatnonzero(apart)
        tail = np.append(head[1:], len(starts)) - 1
        begin, end, spot = starts[head], ends[tail] - 1 + kind.length, spot[head]
        doc = chunk.documents_at(begin)
        ids, at = chunk.ids[doc], begin - chunk.doc_bounds[doc]
        family = mix(mix(first[spot].view(np.uint64)) + segment[spot].astype(np.uint64)) + dealt[spot].astype(np.uint64)
        own = ids == first[spot]
        salt = mix(ids.view(np.uint64)) & (np.uint64(1) << dealt[spot].astype(np.uint64)) - np.uint64(1)
        many = dealt[spot] > 0
        shard = (mix(family + salt) % np.uint64(shards)).astype(np.int64)
        out = []
        number = key[0].as_py()
        for s in range(len(begin)):
            rest = (number, int(ids[s]), int(at[s]), bool(own[s]), bool(many[s]), chunk.items[begin[s] : end[s]].tobytes())
            if many[s] and own[s]:
                salts = np.arange(1 << int(dealt[spot[s]]), dtype=np.uint64)
                out += [(one, *rest) for one in (mix(family[s] + salts) % np.uint64(shards)).astype(np.int64).tolist()]
            else:
                out.append((int(shard[s]), *rest))
        return _table(out, STRETCHED)

    return stretches


def _runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last positions of the runs of true flags."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _equal_runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """First and behind-last rows of the runs of equal rows."""
    n = len(columns[0])
    if not n:
        return []
    turn = np.zeros(n, bool)
    turn[0] = True
    for column in columns:
        turn[1:] |= column[1:] != column[:-1]
    starts = np.flatnonzero(turn).tolist()
    return list(zip(starts, [*starts[1:], n], strict=True))


def digests(items: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every window."""
    items = wide(items)
    return gram_hashes(mix(items + np.uint64(1)), length), gram_hashes(mix(items ^ np.uint64(0x5BF03635DCB2A1E7)), length)


def _matches(kind: Kind, item_type: type, chunks: int, buckets: int):
    """Step 4: covered intervals for the chunks, open windows for the buckets."""

    def matches(key, table):
        ids, starts = table.column("doc_id").to_numpy(), table.column("start").to_numpy()
        order = np.lexsort((starts, ids))
        # A first document's stretch may come to a shard by several dealings.
        order = order[[low for low, _ in _equal_runs(ids[order], starts[order])]]
        table = table.take(pa.array(order))
        ids, starts = ids[order], starts[order]
        data, offsets = utf8(table.column("items"))
        items = np.ascontiguousarray(data).view(item_type)
        bounds = offsets // np.dtype(item_type).itemsize
        first = table.column("first").to_numpy(zero_copy_only=False)
        dealt = table.column("dealt").to_numpy(zero_copy_only=False)
        found = kind.matcher(Stretches(items, bounds, ids, starts, first, kind.length))
        owner = table.column("chunk").to_numpy()
        rows = []
        begin, end = _runs_of(found.covered)
        where = np.searchsorted(bounds[1:], begin, "right")
        # A run of covered windows may pass from one stretch to the next only if
        # their last windows touch, which they never do: a stretch ends with
        # ``length - 1`` positions without a window.
        at = starts[where] + begin - bounds[where]
        until = at + (end - begin) - 1 + kind.length
        order = np.argsort(owner[where], kind="stable")
        where, at, until = where[order], at[order], until[order]
        for low, high in _equal_runs(owner[where]):
            mine = slice(low, high)
            rows.append((int(owner[where[low]]), ids[where[mine]].tobytes(), None, at[mine].tobytes(), until[mine].tobytes(), None))
        mask = found.open.copy()
        mask[~np.repeat(dealt & ~first, np.diff(bounds))] = False
        if mask.any():
            spot = np.flatnonzero(mask)
            one, two = digests(items, kind.length)
            place = (one[spot] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            spot, place = spot[order], place[order]
            where = np.searchsorted(bounds[1:], spot, "right")
            at = starts[where] + spot - bounds[where]
            for low, high in _equal_runs(place):
                mine = slice(low, high)
                both = np.concatenate((one[spot[mine]], two[spot[mine]]))
                rows.append((chunks + int(place[low]), ids[where[mine]].tobytes(), owner[where[mine]].tobytes(), at[mine].tobytes(), None, both.tobytes()))
        return _table(rows, MATCHED)

    return matches


def _resolved(kind: Kind, chunks: int):
    """Step 4, second part: open windows of a bucket; a chunk's intervals pass."""

    def resolved(key, table):
        if key[0].as_py() < chunks:
            return pa.table({"chunk": table.column("place").cast(pa.int32()), **{n: table.column(n) for n in ("ids", "starts", "ends")}})

        def joined(name: str, item: type) -> list[np.ndarray]:
            return [np.frombuffer(x, item) for x in table.column(name).to_pylist()]

        ids, starts = np.concatenate(joined("ids", np.int64)), np.concatenate(joined("starts", np.int64))
        owner, both = np.concatenate(joined("chunks", np.int32)), joined("digests", np.uint64)
        one = np.concatenate([x[: len(x) // 2] for x in both])
        two = np.concatenate([x[len(x) // 2 :] for x in both])
        order = np.lexsort((starts, ids, two, one))
        starts, one, two, ids, owner = starts[order], one[order], two[order], ids[order], owner[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        late = ids > ids[head]
        if kind.within:
            late |= (ids == ids[head]) & (starts > starts[head])
        order = np.flatnonzero(late)
        order = order[np.argsort(owner[order], kind="stable")]
        ids, owner, starts = ids[order], owner[order], starts[order]
        rows = [
            (int(owner[low]), ids[low:high].tobytes(), starts[low:high].tobytes(), (starts[low:high] + kind.length).tobytes())
            for low, high in _equal_runs(owner)
        ]
        return _table(rows, COVERED)

    return resolved


def covered_items(chunk: Chunk, intervals: pa.Table) -> np.ndarray:
    """Step 5: which of a chunk's items lie in an interval."""
    change = np.zeros(len(chunk.items) + 1, np.int32)
    for ids, starts, ends in zip(*(intervals.column(n).to_pylist() for n in ("ids", "starts", "ends")), strict=True):
        base = chunk.doc_bounds[np.searchsorted(chunk.ids, np.frombuffer(ids, np.int64))]
        np.add.at(change, np.frombuffer(starts, np.int64) + base, 1)
        np.add.at(change, np.frombuffer(ends, np.int64) + base, -1)
    return np.cumsum(change)[:-1] > 0


SPANS = "array<struct<start: long, stop: long>>"


def removed_spans(bounds: np.ndarray, covered: np.ndarray) -> pa.ListArray:
    """Per row, the maximal runs of its covered items, from the row's first item."""
    opens, closes = covered.copy(), covered.copy()
    opens[1:] &= ~covered[:-1]
    closes[:-1] &= ~covered[1:]
    heads, ends = bounds[:-1][bounds[:-1] < len(covered)], bounds[1:][bounds[1:] > 0] - 1
    opens[heads], closes[ends] = covered[heads], covered[ends]
    start, stop = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    base = bounds[np.searchsorted(bounds[1:], start, "right")]
    runs = pa.StructArray.from_arrays([pa.array(start - base), pa.array(stop - base)], ["start", "stop"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(start, bounds).astype(np.int32)), runs)


def repeats(
    docs: DataFrame, kind: Kind, item_type: type, report: Callable[[Chunk, np.ndarray], pa.Table], schema: str, sizes: Sizes = Sizes()
) -> DataFrame:
    """``report`` of every chunk and its covered items, over all chunks."""
    total = text_bytes(docs)
    chunks = max(1, -(-total // sizes.chunk_of(total)))
    bits = max(0, (-(-total // sizes.bucket) - 1).bit_length())
    shards = max(1, -(-total // sizes.shard))
    texts = docs.select("doc_id", "text").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).cast("int"))
    by_chunk = texts.groupBy("chunk")
    asked = by_chunk.applyInArrow(_asks(kind, bits), ASKED)
    answered = asked.groupBy("bucket").applyInArrow(_answers(sizes.occurrences), ANSWERED)
    stretched = by_chunk.cogroup(answered.groupBy("chunk")).applyInArrow(_stretches(kind, bits, shards), STRETCHED)
    left = max(1, -(-total // sizes.open))
    matched = stretched.groupBy("shard").applyInArrow(_matches(kind, item_type, chunks, left), MATCHED)
    covered = matched.groupBy("place").applyInArrow(_resolved(kind, chunks), COVERED)

    def reported(key, texts, intervals):
        chunk = Chunk(texts, kind)
        return report(chunk, covered_items(chunk, intervals))

    return by_chunk.cogroup(covered.groupBy("chunk")).applyInArrow(reported, schema)


def byte_items(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(column)
    return data, offsets


def word_items(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    words = Words(*utf8(column))
    return words.hashes(), words.bounds

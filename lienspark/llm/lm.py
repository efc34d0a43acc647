"""Language model scores from an Elias-Fano n-gram trie.

Tokens are the words of the text with A-Z in lower case, then one end. Unigram
counts are exact over all learned documents: chunks of documents send their distinct
tokens, as 64-bit hashes packed by hash bucket, and get the counts back in the same
order. They give the base score (add 0.1) and the lowest order of the model.

Of the higher orders the model holds the pairs and triples that learned documents
have ``NGRAM_COUNT`` times, whatever the size of the corpus, so it grows with the
input. They are discounted by a constant, what that leaves goes to the lower order,
so that the chances of all tokens in a context sum to 1.

Held words are numbered by bucket and hash, held n-grams by bucket and key; an
n-gram's key is the number of its context and that of its word. A chunk sends its
distinct n-grams to the buckets of their keys' hashes. A bucket is a shard of the
trie and never leaves its task: words follow on the largest of the context before,
so a shard is one ascending sequence, and the contexts' first children are another;
both are Elias-Fano coded and lie in a memory map with the n-grams' codes: of the log
of the discounted count, from which that of the context's count makes the chance. The
shard finds what a chunk asks for by successor search in the context's children; the
chunk gets back which n-grams are held, their codes and their places, with which it
asks for the next order. As a shard takes n-grams by their
own hash, the words after a frequent context are spread over all shards; each sends
the context's bucket one sum, and back-off weights are answered from there. The
driver holds one count for each bucket.

A chunk is a run of the rows as they are read. It is packed once as the places of its
tokens among its distinct ones, and shuffled in that form; texts are not shuffled. An
n-gram is asked for when what it begins and ends with occurs often enough. Log weights
and chances in the lower order are sent as codes of two bytes; so a chance is within
0.04 percent of the exact one, and counts of pairs up to some 1,000 are exact. What a
step has been made of is deleted when the step is written.

Nulls and corner cases: a null text is empty, and an empty one is the end alone; a
null ``doc_id`` is not learned from and not held out; with nothing learned every
token has chance 1; repeated rows count each time; only ``doc_id`` and ``text`` are
read.
"""

from __future__ import annotations

import mmap
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.llm.elias_fano import EliasFano
from lienspark.llm.registry import read, registered
from lienspark.llm.text import Words, mix, runs, utf8
from lienspark.settings import fresh_path, session_conf
from lienspark.sinks.folders import delete_folder, folders_like

ORDER = 3
ADDED = 0.1
DISCOUNT = 0.5
# Words and longer n-grams are held from so many occurrences on.
WORD_COUNT, NGRAM_COUNT = 1, 2
# Log chances and weights are sent as codes, so many to a power of ten.
CODE = 3000.0
CHUNK_BYTES, BUCKET_BYTES = 4 << 20, 16 << 20
# Shuffle files of a step are deleted once its rows are written.
# A task writes its rows of all kinds at once, without sorting them.
KIND_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "8"}
SHORT_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
END = np.uint64(0xE4D0_0F7E_9A11_D0C5)


class Tokens:
    """Token hashes of some texts; text d has those at ``bounds[d]`` to ``bounds[d + 1]``."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        data, offsets = utf8(column)
        upper = (data >= 0x41) & (data <= 0x5A)
        words = Words(np.where(upper, data | np.uint8(0x20), data), offsets)
        n = len(offsets) - 1
        self.bounds = words.bounds + np.arange(n + 1)
        self.hashes = np.empty(self.bounds[-1], np.uint64)
        ends = self.bounds[1:] - 1
        inner = np.ones(len(self.hashes), bool)
        inner[ends] = False
        self.hashes[inner] = words.hashes()
        self.hashes[ends] = END
        self.texts = np.repeat(np.arange(n), np.diff(self.bounds))
        # Tokens in the same text before each token.
        self.depth = np.arange(len(self.hashes)) - self.bounds[:-1][self.texts]


# --- The trie ------------------------------------------------------------------


@dataclass
class Level:
    """n-grams of one length, below the parents of the level before."""

    children: EliasFano  # by parent, the place of its first child
    words: EliasFano
    chances: np.ndarray  # codes

    @classmethod
    def of(cls, parents: int, parent: np.ndarray, word: np.ndarray, chances: np.ndarray) -> Level:
        """From pairs in order of parent and word."""
        first = np.searchsorted(parent, np.arange(parents + 1))
        count = np.diff(first)
        last = np.where(count > 0, word[np.maximum(first[1:] - 1, 0)] + 1 if len(word) else 0, 0)
        base = np.cumsum(last) - last
        return cls(EliasFano.of(first), EliasFano.of(base[parent] + word if len(word) else word), chances.astype(np.int16))

    def find(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The place of each word after its parent, -1 where there is none."""
        found = np.full(len(parent), -1, np.int64)
        if not self.words.size:
            return found
        asked = np.flatnonzero((parent >= 0) & (word >= 0))
        first = self.children.access(parent[asked]).astype(np.int64)
        behind = self.children.access(parent[asked] + 1).astype(np.int64)
        some = behind > first
        asked, first, behind = asked[some], first[some], behind[some]
        base = np.where(first > 0, self.words.access(np.maximum(first - 1, 0)).astype(np.int64) + 1, 0)
        wanted = base + word[asked]
        at = self.words.successor(wanted)
        hit = at < behind
        hit[hit] = self.words.access(at[hit]).astype(np.int64) == wanted[hit]
        found[asked[hit]] = at[hit]
        return found


@dataclass
class Trie:
    """Contexts in their order (level 1), and the levels below them."""

    words: np.ndarray
    levels: list[Level]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each context, -1 if it is not held."""
        if not len(self.words):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)

    def arrays(self) -> list[np.ndarray]:
        out = [self.words]
        for level in self.levels:
            for part in (level.children, level.words):
                out += [np.array([part.size, part.top, part.width], np.int64), part.low, part.high, part.before]
            out.append(level.chances)
        return out

    def serialised(self) -> bytes:
        arrays = self.arrays()
        head = np.array([len(arrays), *(len(a) for a in arrays)], np.int64)
        kinds = np.array([np.dtype(a.dtype).num for a in arrays], np.int64)
        body = b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)
        return head.tobytes() + kinds.tobytes() + body

    @classmethod
    def mapped(cls, data: bytes) -> Trie:
        """The trie on top of a memory map that holds ``data``."""
        view = mmap.mmap(-1, len(data))
        view.write(data)
        n = int(np.frombuffer(view, np.int64, 1)[0])
        lengths = np.frombuffer(view, np.int64, n, 8)
        kinds = {np.dtype(k).num: np.dtype(k) for k in (np.uint64, np.int64, np.int16)}
        types = [kinds[int(k)] for k in np.frombuffer(view, np.int64, n, 8 + 8 * n)]
        arrays, at = [], 8 + 16 * n
        for length, kind in zip(lengths.tolist(), types, strict=True):
            arrays.append(np.frombuffer(view, kind, length, at) if length else np.empty(0, kind))
            at += -(-length * kind.itemsize // 8) * 8
        levels = []
        for low in range(1, n, 9):
            parts = [EliasFano(*map(int, arrays[k]), *arrays[k + 1 : k + 4]) for k in (low, low + 4)]
            levels.append(Level(*parts, arrays[low + 8]))
        return cls(arrays[0], levels)


@dataclass(frozen=True)
class Unigrams:
    """What all learned tokens come to."""

    total: int
    distinct: int

    def log(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + ADDED) / (self.total + ADDED * (self.distinct + 1)))


# --- Counting --------------------------------------------------------------------

# Rows of all steps. By kind, ``a``, ``b`` and ``c`` are: of a chunk, its state; of
# answers on words, counts and the numbers of held ones; of answers on n-grams, which
# are held, and of these the places in the shard (but for the last order) and the codes
# of their chances; of weights, their codes; of asks,
# keys, counts and codes of the chances in the lower order; of contexts, ranks in the
# bucket and counts; of sums, ranks, twice the discounted counts and the chances in the
# lower order; of totals, the numbers of tokens, of distinct and of held n-grams.
PARTS = "chunk long, kind int, bucket int, a binary, b binary, c binary"
UNKIND = PARTS.replace("kind int, ", "")
STATE, ANSWERS, WEIGHTS, ASKS, CONTEXTS, SUMS, TOTALS = 0, 10, 20, 30, 40, 50, 60
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _small(values: np.ndarray) -> bytes:
    """Whole numbers from 0 up, as planes of the bytes they need."""
    values = np.ascontiguousarray(values, np.uint64)
    width = -(-int(values.max()).bit_length() // 8) if len(values) else 0
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    head = np.array([len(values) << 5 | width << 1 | (len(planes) > 512)], np.uint64).tobytes()
    return head + (pa.compress(planes, codec="zstd", asbytes=True) if len(planes) > 512 else planes)


def _numbers(data: bytes) -> np.ndarray:
    head = int(np.frombuffer(data, np.uint64, 1)[0])
    n, width = head >> 5, head >> 1 & 15
    planes = pa.decompress(data[8:], n * width, codec="zstd", asbytes=True) if head & 1 else data[8:]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view(np.int64).ravel()


def _steps(values: np.ndarray) -> bytes:
    """Ascending numbers."""
    return _small(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def _ascending(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers(data).view(np.uint64))


class _Step:
    """Written rows of several kinds, of which one kind can be deleted."""

    def __init__(self, frame: DataFrame, name: str):
        self.spark, self.path = frame.sparkSession, fresh_path(frame.sparkSession, name)
        with session_conf(self.spark, SHORT_SHUFFLES | KIND_FILES):
            frame.write.partitionBy("kind").parquet(self.path)

    def of(self, kind: int) -> DataFrame:
        folder = f"{self.path}/kind={kind}"
        if not folders_like(self.spark, folder):
            return self.spark.createDataFrame([], PARTS)
        rows = self.spark.read.schema(UNKIND).parquet(folder)
        return rows.select("chunk", F.lit(kind).alias("kind"), "bucket", "a", "b", "c")

    def delete(self, *kinds: int) -> None:
        """Rows that the next step has been made of."""
        for kind in kinds:
            delete_folder(self.spark, f"{self.path}/kind={kind}")


def _parts(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * 6
    kinds = [pa.int64()] + [pa.int32()] * 2 + [pa.binary()] * 3
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["chunk", "kind", "bucket", "a", "b", "c"])


def _by_bucket(keys: np.ndarray, order: int, bits: int) -> list[tuple[int, np.ndarray]]:
    """Buckets of sorted keys, each with its keys' places in their order."""
    if not bits or not len(keys):
        return [(0, np.arange(len(keys)))] if len(keys) else []
    bucket = ((keys if order == 1 else mix(keys)) >> np.uint64(64 - bits)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[by], np.arange((1 << bits) + 1))
    return [(b, by[cuts[b] : cuts[b + 1]]) for b in np.flatnonzero(np.diff(cuts)).tolist()]


def _by_base(numbers: np.ndarray, base: np.ndarray) -> list[tuple[int, slice]]:
    """Buckets of ascending numbers, when bucket b has those from ``base[b]`` on."""
    cuts = np.searchsorted(numbers, base)
    return [(b, slice(cuts[b], cuts[b + 1])) for b in np.flatnonzero(np.diff(cuts)).tolist()]


@dataclass(frozen=True)
class Model:
    """What every task knows: limits, and by order the first number of each bucket."""

    bits: int
    least: tuple[float, ...]
    unigrams: Unigrams
    bases: tuple[np.ndarray, ...] = ()

    @property
    def word_bits(self) -> int:
        return max(1, int(self.bases[0][-1]).bit_length())

    def keys(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        return contexts.astype(np.uint64) << np.uint64(self.word_bits) | words.astype(np.uint64)

    def with_order(self, totals: list) -> Model:
        """With the numbers that follow from the held n-grams of each bucket."""
        held = np.zeros(1 << self.bits, np.int64)
        for r in totals:
            held[r["bucket"]] = np.frombuffer(r["a"], np.int64)[2]
        more = replace(self, bases=(*self.bases, np.concatenate(([0], np.cumsum(held)))))
        if len(more.bases) < ORDER and int(more.bases[-1][-1]).bit_length() + more.word_bits > 64:
            raise OverflowError("contexts and words do not fit in keys of 64 bits")
        return more


class Chunk:
    """A packed chunk with what has been answered so far."""

    def __init__(self, table: pa.Table, model: Model):
        self.model, self.rows = model, {}
        names = ("kind", "bucket", "a", "b", "c")
        for kind, bucket, *row in zip(*(table.column(n).to_pylist() for n in names), strict=True):
            if kind == STATE:
                self.ids, self.null, self.held_out, self.learned, self.bounds, back = _state(row[0])
            else:
                self.rows[kind, bucket] = row
        n = len(self.bounds) - 1
        self.texts = np.repeat(np.arange(n), np.diff(self.bounds))
        self.depth = np.arange(len(back)) - self.bounds[:-1][self.texts]
        counts, numbers = self._words()
        # By order, the count and the number (-1: not held) of the n-gram that ends at each
        # token, and the log of its discounted count where it is held.
        self.counts, self.numbers, self.taken = [counts[back]], [numbers[back]], [np.empty(0)]
        # By order of the n-grams below it, the context of each token and its log weight.
        self.contexts, self.weights = [], []

    def _words(self) -> tuple[np.ndarray, np.ndarray]:
        """As buckets are ranges of hashes, their answers are those of all words in order."""
        counts, numbers = [], []
        for b in sorted(b for kind, b in self.rows if kind == ANSWERS + 1):
            packed, steps, _ = self.rows[ANSWERS + 1, b]
            counts.append(_numbers(packed))
            numbers.append(np.full(len(counts[-1]), -1, np.int64))
            numbers[-1][counts[-1] >= self.model.least[0]] = self.model.bases[0][b] + _ascending(steps).astype(np.int64)
        return np.concatenate(counts), np.concatenate(numbers)

    def _answered(self, keys: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each key its number and the log of its discounted count, -1 and 0 if it is not held."""
        numbers, taken = np.full(len(keys), -1, np.int64), np.zeros(len(keys))
        base = self.model.bases[order - 1]
        for b, part in _by_bucket(keys, order, self.model.bits):
            bits, steps, codes = self.rows[ANSWERS + order, b]
            held = part[np.unpackbits(np.frombuffer(bits, np.uint8), count=len(part)).view(bool)]
            numbers[held] = base[b] + _ascending(steps).astype(np.int64) if steps else 0
            taken[held] = _numbers(codes) / CODE
        return numbers, taken

    def before(self, order: int, values: np.ndarray, none) -> np.ndarray:
        """Of each token, the value of the token before it in its text."""
        out = np.full(len(values), none, values.dtype)
        out[1:] = values[:-1]
        out[self.depth < order - 1] = none
        return out

    def asked(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens at the end of n-grams of held parts, their distinct keys, where each
        key is first among those tokens, and the key of each of those tokens."""
        context, word = self.before(order, self.numbers[order - 2], -1), self.numbers[0]
        # What an n-gram ends and begins with occurs as often as it does at least, so
        # no n-gram that is held is left out here.
        least = self.model.least[order - 1]
        often = (self.before(order, self.counts[order - 2], 0) >= least) & (self.counts[order - 2] >= least)
        tokens = np.flatnonzero((context >= 0) & (word >= 0) & often)
        return tokens, *np.unique(self.model.keys(context[tokens], word[tokens]), return_index=True, return_inverse=True)

    def add_chances(self, order: int) -> None:
        tokens, keys, _, back = self.asked(order)
        numbers, taken = self._answered(keys, order)
        counts = np.where(numbers >= 0, np.rint(10**taken + DISCOUNT), 0).astype(np.int64)
        for kept, found, none in ((self.counts, counts, 0), (self.numbers, numbers, -1), (self.taken, taken, 0.0)):
            kept.append(np.full(len(self.depth), none))
            kept[-1][tokens] = found[back]

    def add_weights(self, order: int) -> None:
        context = self.before(order, self.numbers[order - 2], -1)
        distinct, back = np.unique(context, return_inverse=True)
        found = np.zeros(len(distinct))
        for b, part in _by_base(distinct, self.model.bases[order - 2]):
            found[part] = (_numbers(self.rows[WEIGHTS + order, b][0]) - 32768) / CODE
        self.contexts.append(context)
        self.weights.append(found[back])

    def logs(self, order: int) -> np.ndarray:
        """Log chance of each token after up to ``order`` - 1 tokens."""
        logs = self.model.unigrams.log(self.counts[0])
        for longer in range(2, order + 1):
            of = np.maximum(self.before(longer, self.counts[longer - 2], 0), 1)
            held = self.numbers[longer - 1] >= 0
            logs = np.where(held, self.taken[longer - 1] - np.log10(of), logs + self.weights[longer - 2])
        return logs


def _packed(ids, null, held_out, learned, bounds, back) -> bytes:
    return pickle.dumps((ids, null, held_out, learned, bounds, _small(back)), 5)


def _state(data: bytes) -> tuple[np.ndarray, ...]:
    *rest, back = pickle.loads(data)
    return *rest, _numbers(back)


def _packs(bits: int, chunk_bytes: int):
    """Chunks' states, and their distinct tokens with how often the learned texts have them."""

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for run in runs(batch, limit=chunk_bytes):
                tokens = Tokens(run.column("text"))
                learned = run.column("learned").to_numpy(zero_copy_only=False)
                held_out = run.column("held_out").to_numpy(zero_copy_only=False)
                keys, back = np.unique(tokens.hashes, return_inverse=True)
                counts = np.bincount(back[learned[tokens.texts]], minlength=len(keys))
                ids = run.column("doc_id")
                null = ids.is_null().to_numpy(zero_copy_only=False)
                state = _packed(ids.fill_null(0).to_numpy(), null, held_out, learned, tokens.bounds, back)
                rows = [(chunk, ASKS + 1, b, _steps(keys[part]), _small(counts[part]), None) for b, part in _by_bucket(keys, 1, bits)]
                yield from _parts([(chunk, STATE, None, state, None, None), *rows]).to_batches()
                chunk += 1

    return packs


def _codes(logs: np.ndarray) -> bytes:
    return _small(np.clip(np.rint(logs * CODE) + 32768, 0, 65535))


def _asks(model: Model, order: int):
    """A chunk's distinct n-grams and, for their back-off weights, its contexts."""

    def asks(key, table):
        name, chunk = key[0].as_py(), Chunk(table, model)
        for shorter in range(2, order):
            chunk.add_chances(shorter)
            chunk.add_weights(shorter)
        tokens, keys, first, back = chunk.asked(order)
        counts = np.bincount(back[chunk.learned[chunk.texts[tokens]]], minlength=len(keys))
        # The chance of the word after the context without its first word.
        lower = -chunk.logs(order - 1)[tokens[first]]
        rows = [
            (name, ASKS + order, b, _steps(keys[part]), _small(counts[part]), _codes(lower[part]))
            for b, part in _by_bucket(keys, order, model.bits)
        ]
        context, first = np.unique(chunk.before(order, chunk.numbers[order - 2], -1), return_index=True)
        times = chunk.before(order, chunk.counts[order - 2], 0)[first]
        base = model.bases[order - 2]
        rows += [
            (name, CONTEXTS + order, b, _steps(context[part] - base[b]), _small(times[part]), None)
            for b, part in _by_base(context, base)
        ]
        return _parts(rows)

    return asks


def _answers(model: Model, order: int):
    """Counts and numbers for each chunk in the order it asked, the bucket's totals, and
    for each bucket of contexts what this one's n-grams take from their chances.
    Rows of contexts are passed on."""

    def answers(key, table):
        asked = pc.equal(table.column("kind"), ASKS + order)
        passed, table = table.filter(pc.invert(asked)), table.filter(asked)
        if not table.num_rows:
            return passed
        bucket, chunks = key[0].as_py(), table.column("chunk").to_pylist()
        parts = [_ascending(k) for k in table.column("a").to_pylist()]
        counts = [_numbers(c) for c in table.column("b").to_pylist()]
        keys, first, back = np.unique(np.concatenate(parts), return_index=True, return_inverse=True)
        total = np.bincount(back, np.concatenate(counts)).astype(np.int64)
        often = total >= model.least[order - 1]
        cuts = np.cumsum([0, *map(len, parts)])
        rows, sums = [], []
        if order == 1:
            place = np.cumsum(often) - 1
            for chunk, low, high in zip(chunks, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                mine = back[low:high]
                rows.append((chunk, ANSWERS + order, bucket, _small(total[mine]), _steps(place[mine][often[mine]]), None))
        else:
            bits = np.uint64(model.word_bits)
            above, word = keys >> bits, (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            contexts, parent = np.unique(above[often], return_inverse=True)
            codes = np.clip(np.rint(np.log10(total[often] - DISCOUNT) * CODE), 0, 32767)
            shard = Trie(contexts, [Level.of(len(contexts), parent, word[often], codes)])
            shard = Trie.mapped(shard.serialised())
            level = shard.levels[0]
            place = level.find(shard.ids(above), word)
            for chunk, low, high in zip(chunks, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                found = place[back[low:high]]
                held = found[found >= 0]
                steps = _steps(held) if order < ORDER else None
                rows.append((chunk, ANSWERS + order, bucket, np.packbits(found >= 0).tobytes(), steps, _small(level.chances[held])))
            lower = np.concatenate([_numbers(c) for c in table.column("c").to_pylist()])[first[often]]
            taken = np.bincount(parent, 2 * (total[often] - DISCOUNT), len(contexts))
            below = np.bincount(parent, 10 ** ((32768 - lower) / CODE), len(contexts)).astype(np.float32)
            contexts, base = contexts.astype(np.int64), model.bases[order - 2]
            sums = [
                (bucket, SUMS + order, b, _steps(contexts[part] - base[b]), _small(taken[part]), below[part].tobytes())
                for b, part in _by_base(contexts, base)
            ]
        totals = np.array([total.sum(), (total > 0).sum(), often.sum()], np.int64)
        return pa.concat_tables([passed, _parts([*rows, *sums, (None, TOTALS + order, bucket, totals.tobytes(), None, None)])])

    return answers


def _weights(order: int):
    """Log weights of the contexts each chunk has, in their order.

    With c the count of a context, its held n-grams have the chances (count -
    discount) / c. The weight is what they leave of 1 over what the lower order
    leaves to the tokens that are not among them.
    """

    def weights(key, asked, sums):
        sums = sums.sort_by("chunk")
        ranks = [_ascending(a).astype(np.int64) for a in sums.column("a").to_pylist()]
        taken = [_numbers(b) / 2 for b in sums.column("b").to_pylist()]
        below = [np.frombuffer(c, np.float32) for c in sums.column("c").to_pylist()]
        mine = [_ascending(a).astype(np.int64) for a in asked.column("a").to_pylist()]
        size = max([0, *(int(m[-1]) + 1 for m in mine)])
        at = np.concatenate([np.empty(0, np.int64), *ranks])
        taken, below = (np.bincount(at, np.concatenate([np.empty(0), *v]), size) for v in (taken, below))
        rows = []
        for chunk, rank, counts in zip(asked.column("chunk").to_pylist(), mine, asked.column("b").to_pylist(), strict=True):
            left = np.maximum(1 - taken[rank] / _numbers(counts), 1e-9)
            rest = np.maximum(1 - below[rank], 1e-9)
            rows.append((chunk, WEIGHTS + order, key[0].as_py(), _codes(np.log10(left / rest)), None, None))
        return _parts(rows)

    return weights


def _scores(model: Model):
    def scores(key, table):
        chunk = Chunk(table, model)
        for order in range(2, ORDER + 1):
            chunk.add_chances(order)
            chunk.add_weights(order)
        n = len(chunk.ids)
        return pa.table(
            {
                "doc_id": pa.array(chunk.ids, pa.int64(), mask=chunk.null),
                "held_out": pa.array(chunk.held_out),
                "n_tokens": pa.array(np.diff(chunk.bounds)),
                "n_known": pa.array(np.bincount(chunk.texts, chunk.counts[0] > 0, n).astype(np.int64)),
                "base_score": pa.array(np.bincount(chunk.texts, chunk.logs(1), n)),
                "score": pa.array(np.bincount(chunk.texts, chunk.logs(ORDER), n)),
            }
        )

    return scores


def language_scores(docs: DataFrame, word_share: float = 0.0, ngram_share: float = 0.0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row of ``docs`` its tokens, known ones, all learned tokens and both scores.

    The shares are for a model smaller than the whole one: they leave out words and
    longer n-grams that occur less often in a learned byte.
    """
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10))
    held_out, learned = F.coalesce(remainder == 0, F.lit(False)), F.coalesce(remainder != 0, F.lit(False))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"), learned.alias("learned"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    sums = texts.agg(F.sum(size).alias("all"), F.sum(F.when(F.col("learned"), size)).alias("learned")).first()
    total, learned_bytes = sums["all"] or 0, sums["learned"] or 0
    bits = max(0, (-(-total // BUCKET_BYTES) - 1).bit_length())
    least = max(float(NGRAM_COUNT), ngram_share * learned_bytes)
    model = Model(bits, (max(float(WORD_COUNT), word_share * learned_bytes), *[least] * (ORDER - 1)), Unigrams(0, 0))

    chunks = _Step(texts.mapInArrow(_packs(bits, chunk_bytes), PARTS), "chunks")
    asks, known = chunks.of(ASKS + 1), [chunks.of(STATE)]
    for order in range(1, ORDER + 1):
        if order > 1:
            asks = reduce(DataFrame.union, known).groupBy("chunk").applyInArrow(_asks(model, order), PARTS)
        answered = _Step(asks.groupBy("bucket").applyInArrow(_answers(model, order), PARTS), "answered")
        known.append(answered.of(ANSWERS + order))
        if order == 1:
            chunks.delete(ASKS + 1)
        else:
            contexts = answered.of(CONTEXTS + order).groupBy("bucket")
            taken = answered.of(SUMS + order).groupBy("bucket")
            weights = _Step(contexts.cogroup(taken).applyInArrow(_weights(order), PARTS), "weights")
            known.append(weights.of(WEIGHTS + order))
            answered.delete(CONTEXTS + order, SUMS + order)
        totals = answered.of(TOTALS + order).select("bucket", "a").collect()
        if order == 1:
            counts = [np.frombuffer(r["a"], np.int64).tolist() for r in totals]
            model = replace(model, unigrams=Unigrams(sum(c[0] for c in counts), sum(c[1] for c in counts)))
        model = model.with_order(totals)
    scored = reduce(DataFrame.union, known).groupBy("chunk").applyInArrow(_scores(model), SCORED)
    return scored.withColumn("train_tokens", F.lit(model.unigrams.total).cast("long"))


@registered("op8_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_scores(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")

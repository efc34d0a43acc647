import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lienspark.llm import suffix_array, suffix_automaton
from lienspark.llm.repeats import Sizes, _asks

SMALL = Sizes(chunk=600, bucket=1500, shard=900, open=3000, occurrences=2, widest=600)


def plain_bytes(rows):
    texts = [(d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in texts:
        for i in range(len(b) - 49):
            first[b[i : i + 50]] = min(first.get(b[i : i + 50], d), d)
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len([s for s in bytes(gone).split(b"\0") if s]), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def plain_words(rows):
    texts = sorted((d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows)
    first, out = set(), []
    for d, words in texts:
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in first:
                gone.update(range(i, i + 20))
            first.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage, base = prose(60), prose(90)
    made = [prose(rng.randint(0, 80)) for _ in range(25)]
    made += [prose(10) + passage[: rng.randint(20, 60)] + prose(10) for _ in range(12)]
    for _ in range(14):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        made.append(copy)
    made += [["again"] * 70, ["again"] * 45 + ["other"], passage + passage, base[5:24], base[5:25], [], list(base), list(base)]
    rng.shuffle(made)
    return [(1000 - 3 * i, " ".join(words)) for i, words in enumerate(made)] + [(5000, "ab" * 300), (5001, "é" * 200), (4999, "ba" * 90)]


@pytest.mark.parametrize("sizes", [Sizes(), SMALL], ids=["one task", "many small tasks"])
@pytest.mark.parametrize("operator, plain", [(suffix_array, plain_bytes), (suffix_automaton, plain_words)], ids=["bytes", "words"])
def test_against_plain_search(table, rows, operator, plain, sizes):
    found = sorted(tuple(r) for r in operator.without_repeats(table(rows), sizes).collect())
    assert found == plain(rows)


@pytest.mark.parametrize("operator", [suffix_array, suffix_automaton])
def test_awkward_rows(awkward, nothing, operator):
    found = operator.without_repeats(awkward).collect()
    assert len(found) == awkward.count()
    assert operator.without_repeats(nothing).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [(r[1], r[2], r.kept_sha256) for i in (3, 4) for r in by_id[i]] == [(0, 0, empty)] * 2
    assert by_id[2][0].n_removed == by_id[2][0][1] > 0
    assert len(by_id[None]) == 2


def test_repeated_rows(table):
    text = " ".join(f"w{i}" for i in range(40))
    twice = table([(1, text), (1, text), (2, text)])
    whole = len(text)
    assert sorted(r.n_removed for r in suffix_array.without_repeats(twice).collect()) == [0, 0, whole]
    assert sorted(r.n_removed for r in suffix_automaton.without_repeats(twice).collect()) == [0, 40, 40]


@pytest.mark.parametrize("sizes", [Sizes(), SMALL], ids=["one task", "many small tasks"])
def test_kept_texts_and_spans(table, rows, sizes):
    """What is kept has the plain search's digest, and is the text without its spans."""
    docs = table(rows + [(6000, None), (6001, "")])
    texts = dict(rows) | {6000: "", 6001: ""}
    for operator, plain in ((suffix_array, plain_bytes), (suffix_automaton, plain_words)):
        digest = {r[0]: r[-1] for r in plain(list(texts.items()))}
        removed = {r[0]: r[2] for r in plain(list(texts.items()))}
        found = operator.deduplicated(docs, sizes).collect()
        assert len(found) == len(texts) and any(len(r.spans) > 1 for r in found)
        for r in found:
            whole = texts[r.doc_id].encode() if operator is suffix_array else re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])
            kept = bytes(r.kept) if operator is suffix_array else r.kept.encode()
            assert hashlib.sha256(kept).hexdigest() == digest[r.doc_id]
            assert sum(s.stop - s.start for s in r.spans) == removed[r.doc_id]
            assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))
            gone = {i for s in r.spans for i in range(s.start, s.stop)}
            left = [x for i, x in enumerate(whole) if i not in gone]
            assert kept == (bytes(left) if operator is suffix_array else " ".join(left).encode())


@pytest.mark.parametrize("operator", [suffix_array, suffix_automaton])
def test_kept_texts_of_awkward_rows(awkward, nothing, operator):
    found = operator.deduplicated(awkward)
    digests = sorted((str(r.doc_id), hashlib.sha256(bytes(r.kept) if operator is suffix_array else r.kept.encode()).hexdigest()) for r in found.collect())
    assert digests == sorted((str(r.doc_id), r.kept_sha256) for r in operator.without_repeats(awkward).collect())
    assert operator.deduplicated(nothing).count() == 0


@pytest.mark.parametrize("operator", [suffix_array, suffix_automaton])
def test_anchors_spread_over_buckets(operator):
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(4000)) for _ in range(8)]
    table = pa.table({"doc_id": pa.array(range(8), pa.int64()), "text": texts, "chunk": pa.array([0] * 8, pa.int32())})
    asked = _asks(operator.KIND, 4)((pa.scalar(0),), table)
    held = [len(low) // 4 for low in asked.column("low").to_pylist()]
    assert asked.column("bucket").to_pylist() == list(range(16))
    assert max(held) < 1.5 * sum(held) / 16


def test_chunks_grow_with_buckets_to_a_bound():
    sizes = Sizes()
    assert [sizes.chunk_of(n << 20) >> 20 for n in (0, 1, 1 << 10, 48 << 10, 1 << 20, 1 << 30)] == [1, 1, 1, 3, 4, 4]
    assert Sizes(chunk=8 << 20).chunk_of(1 << 40) == 8 << 20


def test_buckets_are_equal_where_strings_are():
    items = np.random.default_rng(2).integers(0, 2, 900).astype(np.uint8)
    bounds = np.array([0, 300, 310, 900])
    for length in (3, 8, 13, 50):
        held, bucket = suffix_array.buckets(items, bounds, length)
        strings = [items[i : i + length].tobytes() for i in held]
        assert len(set(zip(strings, bucket.tolist()))) == len(set(strings)) == len(set(bucket.tolist()))


def test_matching_statistics():
    rng = random.Random(5)
    text = [rng.randrange(3) for _ in range(200)]
    asked = [rng.randrange(3) for _ in range(200)]
    automaton = suffix_automaton.Automaton()
    before = automaton.add_text(text)
    joined = "".join(map(str, text))
    for i, n in enumerate(before):
        longest = next(k for k in range(i + 1, -1, -1) if joined[i + 1 - k : i + 1] in joined[:i] or k == 0)
        assert n == longest
    query = "".join(map(str, asked))
    for i, n in enumerate(automaton.matches(asked)):
        assert n == next(k for k in range(i + 1, -1, -1) if query[i + 1 - k : i + 1] in joined)

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lienspark.llm.elias_fano import EliasFano
from lienspark.llm.text import Words, gram_hashes, inside, runs, utf8

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b\xa0é漢", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    words = Words(*utf8(pa.array(texts, pa.string())))
    found = [
        [words.data[words.starts[i] : words.ends[i]].tobytes().decode() for i in range(words.bounds[d], words.bounds[d + 1])]
        for d in range(len(texts))
    ]
    assert found == [WORD.findall(t or "") for t in texts]
    flat = [w for doc in found for w in doc]
    hashes = words.hashes().tolist()
    assert len(hashes) == len(flat)
    assert len(set(zip(flat, hashes))) == len(set(flat)) == len(set(hashes))


def test_grams_are_equal_where_items_are():
    items = np.random.default_rng(1).integers(0, 4, 3000).astype(np.uint64)
    for size in (1, 2, 3, 5, 8, 20, 24):
        hashes = gram_hashes(items, size)
        seen = {}
        for i, h in enumerate(hashes.tolist()):
            assert seen.setdefault(tuple(items[i : i + size].tolist()), h) == h
        assert len(set(seen.values())) == len(seen)
    assert len(gram_hashes(items[:3], 5)) == 0


def test_inside():
    assert inside(np.array([0, 3, 3, 5]), 2, 4).tolist() == [True, True, False, True]


def test_runs_hold_all_rows_and_long_ones_alone():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 5, None, "b" * 50, "c", "d"]})
    assert [r.num_rows for r in runs(batch, limit=10)] == [2, 1, 2]


@pytest.mark.parametrize("n, top", [(0, 1), (1, 0), (5, 5), (1000, 10), (1000, 1000), (500, 10**6), (777, 2**40)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top + 1, n)).astype(np.uint64)
    coded = EliasFano.of(values)
    assert (coded.access(np.arange(n)) == values).all()
    asked = np.concatenate((rng.integers(0, top + 2, 500).astype(np.uint64), values, np.array([0, top, top + 1, 3 * top + 9], np.uint64)))
    assert (coded.successor(asked) == np.searchsorted(values, asked)).all()
    if n >= 500:
        random.seed(n)
        assert coded.low.nbytes + coded.high.nbytes < values.nbytes

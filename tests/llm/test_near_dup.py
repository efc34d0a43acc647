import random
import re
from collections import Counter

import numpy as np
import pytest

from lienspark.llm import near_dup
from lienspark.llm.components import components


def weights(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def similarity(a, b):
    return sum(1 / sum(max(a[k] / a[g], b[k] / b[g]) for k in a.keys() | b.keys()) for g in a.keys() & b.keys())


def plain_classes(rows):
    bags = {d: weights(t) for d, t in rows}
    parent = {d: d for d in bags}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(bags)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (not bags[a] and not bags[b]) or (bags[a] and bags[b] and similarity(bags[a], bags[b]) >= 0.8 - 1e-9):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in ids}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(500)]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    base, other = prose(150), prose(40)
    made = [prose(rng.randint(1, 60)) for _ in range(20)]
    for edits in [0, 0, 1, 1, 2, 2, 3, 3, 4, 5, 6, 8, 10] * 3:
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        made.append(copy)
    made += [other + ["tail"], other, other[1:], ["two", "words"], ["two", "words"], ["two"], [], ["again"] * 90, ["again"] * 100, ["again"] * 200 + ["end"]]
    rng.shuffle(made)
    return [(10 * i + 3, " ".join(words)) for i, words in enumerate(made)] + [(1, "  ")]


def test_against_all_pairs(table, rows):
    found = {r.doc_id: r.class_id for r in near_dup.near_duplicates(table(rows)).collect()}
    assert found == plain_classes(rows)


def test_small_blocks_lose_nothing(table, rows, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 4)
    monkeypatch.setattr(near_dup, "BLOCK_GRAMS", 16)
    monkeypatch.setattr(near_dup, "SHARD_ROWS", 8)
    found = {r.doc_id: r.class_id for r in near_dup.near_duplicates(table(rows)).collect()}
    assert found == plain_classes(rows)


def test_probability_jaccard():
    rng = random.Random(4)
    for _ in range(50):
        a, b = (Counter(rng.choices(range(12), k=rng.randint(1, 25))) for _ in range(2))
        packed = [np.array(x) for bag in (a, b) for x in zip(*sorted(bag.items()))]
        found = near_dup.probability_jaccard(packed[0].astype(np.uint64), packed[1], packed[2].astype(np.uint64), packed[3])
        assert found == pytest.approx(similarity(a, b))


def test_block_similarities():
    rng = random.Random(7)
    bags = [Counter(rng.choices(range(30), k=rng.randint(1, 40))) for _ in range(25)]
    rows = np.array([i for i, bag in enumerate(bags) for _ in bag])
    grams, counts = (np.array([x[k] for bag in bags for x in sorted(bag.items())]) for k in (0, 1))
    small = np.array([0, 3, 11, 24])
    found = near_dup.block_similarities(small, rows, grams.astype(np.uint64), counts, 25)
    for a, i in enumerate(small):
        assert found[a] == pytest.approx([similarity(bags[i], bag) for bag in bags])
    heavy = np.where(np.arange(len(counts)) % 5 == 0, counts * 40, counts)
    bags = [Counter(dict(zip(grams[rows == i].tolist(), heavy[rows == i].tolist()))) for i in range(25)]
    most = near_dup._at_most(small, rows, grams.astype(np.uint64), heavy, 25)
    for a, i in enumerate(small):
        assert all(m >= similarity(bags[i], bag) - 1e-5 for m, bag in zip(most[a], bags))
        assert most[a][i] == pytest.approx(1, abs=1e-5)


def test_registers_agree_as_often_as_similar():
    rng = np.random.default_rng(6)
    grams = rng.integers(1, 2**63, 200).astype(np.uint64)
    left, right = np.sort(grams[:170]), np.sort(grams[30:])
    a = near_dup.signatures(np.zeros(170, np.int64), left, np.ones(170, np.int64), 1)
    b = near_dup.signatures(np.zeros(170, np.int64), right, np.ones(170, np.int64), 1)
    assert abs((a == b).mean() - 140 / 200) < 0.15


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 99), (99, 98), (7, 7), (200, 201), (200, 201)]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 98, 99: 98, 98: 98, 200: 200, 201: 200}


def test_texts_of_one_id_are_kept_apart(table):
    a, b, c = (" ".join(f"{name}{i}" for i in range(40)) for name in "abc")
    kept = near_dup.keep(table([(1, a), (1, b), (2, b), (3, c)])).collect()
    assert sorted(map(tuple, kept)) == [(1, a), (1, b), (3, c)]
    found = near_dup.near_duplicates(table([(1, a), (1, b), (2, b), (3, c)])).collect()
    assert sorted(map(tuple, found)) == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]


def test_repeated_ids_against_all_pairs(table, rows):
    """Texts dealt anew to fewer ids: no text goes unless an equal or similar one stays."""
    rng = random.Random(3)
    dealt = [(rng.randrange(25), text) for _, text in rows] + [(rng.randrange(25), text) for _, text in rows[::3]]
    dealt += dealt[:4] + [(5, None), (5, None), (None, rows[0][1]), (None, rows[0][1])]
    texts = sorted({text for _, text in dealt if text is not None})
    of_text = plain_classes(list(enumerate(texts)))
    classes = {}
    for i, text in dealt:
        if i is not None and text is not None:
            classes.setdefault(of_text[texts.index(text)], set()).add(i)
    kept = near_dup.keep(table(dealt)).collect()
    plain = [(r.doc_id, r.text) for r in kept if r.doc_id is not None and r.text is not None]
    assert sorted(of_text[texts.index(t)] for _, t in plain) == sorted(classes)
    assert all((i, t) in dealt for i, t in plain)
    assert len(kept) == len(plain) + 4
    smallest = {}
    for i, text in dealt:
        if text is not None and i is not None:
            low = min(classes[of_text[texts.index(text)]])
            smallest[i] = min(smallest.get(i, low), low)
    found = near_dup.near_duplicates(table(dealt)).collect()
    assert len(found) == len(dealt)
    assert {r.doc_id: r.class_id for r in found if r.doc_id in smallest} == smallest


def test_awkward_rows(awkward, nothing):
    found = near_dup.near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    classes = {r.doc_id: r.class_id for r in found}
    assert classes[1] == classes[2] == 1
    assert classes[3] == 3 and classes[4] == classes[5] == 4 and classes[None] is None
    assert near_dup.near_duplicates(nothing).count() == 0
    kept = near_dup.keep(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 3, 4, 6, 7, 8, 9, 10]

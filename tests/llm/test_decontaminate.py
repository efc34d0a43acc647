import random
import re
from collections import Counter

import numpy as np
import pytest

from lienspark.llm import decontaminate
from lienspark.llm.decontaminate import Index


def words(text):
    return re.findall(r"[a-zà-öø-þ0-9]+", (text or "").lower())


def bag(tokens):
    size = min(5, len(tokens))
    return Counter(tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1))


def plain(docs, items):
    found = set()
    for i, item in items:
        own = words(item)
        if not own:
            continue
        target = bag(own)
        for d, text in docs:
            tokens = words(text)
            width = min(len(own), len(tokens))
            for s in range(len(tokens) - width + 1):
                window = tokens[s : s + width]
                if width and min(5, width) == min(5, len(own)):
                    mine = bag(window)
                    if sum((mine & target).values()) / sum((mine | target).values()) >= 0.8 - 1e-9:
                        found.add((d, i))
    return found


def test_against_every_window(table):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [(i, " ".join(prose(rng.randint(5, 50)))) for i in range(30)] + [(30, "one two"), (31, "..."), (32, None), (33, "Été À Ñandú x y z")]
    docs = []
    for d in range(120):
        tokens = prose(rng.randint(0, 60))
        item = words(items[rng.randrange(30)][1])
        for _ in range(rng.choice([0, 0, 1, 2, 9])):
            item[rng.randrange(len(item))] = rng.choice(vocabulary)
        cut = rng.choice([0, 0, 3, 20])
        docs.append((d, " ".join(tokens + item[cut:] + prose(rng.randint(0, 20)))))
    docs += [(500, "so ONE, two!"), (501, "one\n**two**"), (502, "été à ñandú X y z"), (503, None), (504, "")]
    found = decontaminate.leaks(table(docs), table(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == plain(docs, items)
    assert len(found) == len({(r.doc_id, r.item_id) for r in found})
    blocks = decontaminate.leaks(table(docs), table(items, "item_id long, text string"), block_items=7).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, found))
    kept = decontaminate.keep(table(docs), table(items, "item_id long, text string"), block_items=7)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {r.doc_id for r in found}


def test_all_fingerprints_within_the_radius_are_found():
    rng = np.random.default_rng(3)
    index = Index.of(list(range(400)), [" ".join(map(str, rng.integers(0, 99, 12))) for _ in range(400)])
    asked = index.prints[rng.integers(0, 400, 300)].copy()
    for k in range(len(asked)):
        for bit in rng.choice(64, rng.integers(0, 26), replace=False):
            asked[k] ^= np.uint64(1 << int(bit))
    found = set(zip(*(x.tolist() for x in index.within(asked))))
    apart = np.bitwise_count(asked[:, None] ^ index.prints[None, :])
    assert found == set(zip(*(x.tolist() for x in np.nonzero(apart <= decontaminate.RADIUS))))


def test_awkward_rows(awkward, nothing, table):
    items = table([(1, "a null id with seven words"), (2, None), (None, "one"), (3, "")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(awkward, items).collect()}
    assert found == {(None, 1), (6, None)}
    kept = decontaminate.keep(awkward, items)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 2
    assert decontaminate.leaks(nothing, items).count() == 0
    assert decontaminate.leaks(awkward, items.where("false")).count() == 0


def test_planted_items_are_found(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = [(r.doc_id, " " + " ".join(words(r.text)) + " ") for r in docs.collect()]
    whole = {(d, r.item_id) for r in items.collect() for d, t in texts if " " + " ".join(words(r.text)) + " " in t}
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}
    assert whole and whole <= found


@pytest.mark.parametrize("text", ["", "a", "a b c d e f"])
def test_empty_benchmark_index(text):
    assert Index.of([1], [""]).ids == []
    assert Index.of([1], [text]).ids == ([1] if text else [])

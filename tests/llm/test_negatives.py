import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lienspark.llm import negatives
from lienspark_checks.compare import differences

COLUMNS = "vec_id long, embedding array<float>, label int"
ANCHOR = "vec_id % 100 = 0"


def whole(vector):
    return [max(-(2**63), min(2**63, math.floor(256 * float(np.float32(x))))) for x in vector]


def plain(rows, low=80, n_pos=5, n_neg=5):
    """All pairs, by whole numbers of any size."""
    rows = [(i, whole(v), label) for i, v, label in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]

    def score(a, b):
        return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b))))

    def order(found):
        return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0, f[2]))

    out = []
    for at, (anchor, vector, label) in enumerate(rows):
        if anchor is None or anchor % 100:
            continue
        scored = [(score(vector, v), i, k, own) for k, (i, v, own) in enumerate(rows) if k != at]
        for value, positive, _, _ in order([s for s in scored if s[3] == label])[:n_pos]:
            fitting = order([s for s in scored if s[3] != label and low * value <= 100 * s[0] <= 100 * value])
            for rank, (other, negative, _, _) in enumerate(fitting[:n_neg], 1):
                out.append((anchor, positive, rank, negative, value, other))
    return sorted(out, key=str)


def found(frame, **options):
    return sorted(map(tuple, negatives.hard_negatives(frame, F.expr(ANCHOR), **options).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    """Clusters, copies of one vector, equal scores, and rows that take no part."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 19))
    out = []
    for i in range(500):
        vector = centres[i % 6] + rng.normal(size=19) * (0.05 if i % 5 else 0.6)
        out.append((i, [float(np.float32(x)) for x in vector], i * 7 % 4))
    out += [(1000 + i, out[0][1], i % 3) for i in range(150)]
    out += [(100, out[100][1], 1), (100, out[100][1], 1), (None, out[200][1], 2), (None, out[0][1], 3)]
    out += [(2000, [], 1), (2001, [0.5, 0.25], 1), (2100, [1.0] * 25, 0), (2200, [0.0] * 19, 2)]
    bad = [float("nan"), float("inf"), -float("inf"), None]
    out += [(3000 + 100 * i, [*out[0][1][:5], b], 1) for i, b in enumerate(bad)]
    return out + [(4000, None, 1), (4100, out[0][1], None)]


@pytest.mark.parametrize("part_bytes, block", [(negatives.PART_BYTES, negatives.BLOCK_ROWS), (8000, 32)])
def test_finds_what_all_pairs_give(spark, table, rows, monkeypatch, part_bytes, block):
    monkeypatch.setattr(negatives, "PART_BYTES", part_bytes)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 3)
    expected = plain(rows)
    assert len(expected) > 50 and found(table(rows, COLUMNS)) == expected


def test_other_numbers_of_rows(table, rows):
    options = {"low": 30, "n_pos": 9, "n_neg": 2}
    assert found(table(rows, COLUMNS), low_percent=30, n_positives=9, n_negatives=2) == plain(rows, **options)


def test_components_beyond_floats(table):
    rng = random.Random(2)
    rows = [(i * 50, [rng.choice([1e30, -1e30, 3e12, 2.5e9, 1.0, -7.0]) for _ in range(4)], i % 3) for i in range(40)]
    assert found(table(rows, COLUMNS)) == plain(rows)


def test_bounds_hold_and_narrow():
    rng = np.random.default_rng(1)
    a, b = (negatives.Vectors(np.floor(256 * rng.normal(size=(n, 37)) + shift)) for n, shift in ((40, 30), (70, -10)))
    exact = a.values @ b.values.T
    widths = []
    for level in range(len(negatives.WIDTHS)):
        under, over = negatives.bounds(a, b, level)
        assert (under < exact).all() and (exact < over).all()
        pairs = np.nonzero(exact > 0)
        assert all(np.allclose(part, full[pairs]) for part, full in zip(negatives.bounds(a, b, level, pairs), (under, over)))
        widths.append((over - under).mean())
    assert widths == sorted(widths, reverse=True)


def test_smooth_vectors_are_seldom_scored_exactly(monkeypatch):
    """Where segments are even, the summaries leave few pairs to the exact score."""
    rng = np.random.default_rng(4)
    centres = np.repeat(rng.normal(size=(200, 8)), 8, axis=1)
    values = np.floor(256 * (centres[rng.integers(0, 200, 3000)] + 0.02 * rng.normal(size=(3000, 64))))
    counted = []
    exact = negatives.scores
    monkeypatch.setattr(negatives, "scores", lambda a, b, pairs: counted.append(len(pairs[0])) or exact(a, b, pairs))
    rows, anchors = negatives.Vectors(values), negatives.Vectors(values[:50])
    best = negatives.search(anchors, rows, np.ones((50, 3000), bool), [[(-np.inf, np.inf)]] * 50, 5)
    for at, (own,) in enumerate(best):
        order = np.lexsort((np.arange(3000), -(values @ values[at])))[:5]
        assert [place for _, place in own.found] == order.tolist()
    assert sum(counted) < 0.1 * 50 * 3000


def test_agrees_with_sql_on_awkward_rows(spark, table, rows):
    kept = [row for row in rows if row[0] is not None and row[1] != [] and rows.count(row) == 1]
    frame = table(kept, COLUMNS).selectExpr("*", *(f"'x' AS {n}" for n in "row part vector rank anchor score place wanted is_anchor of".split()))
    con = duckdb.connect()
    con.register("embeddings", frame.select("vec_id", "embedding", "label").toArrow())
    assert differences(negatives.hard_negatives(negatives.relabelled(frame), F.expr(ANCHOR)), con, negatives.ORACLE) is None


def test_empty_tables_and_no_anchor(table, rows):
    frame = table(rows, COLUMNS)
    assert found(frame.where("false")) == []
    assert found(frame.where("vec_id % 100 <> 0")) == []
    assert found(frame.where("label = 1")) == []
    assert found(table([(100, [], 1), (200, [], 1), (3, [], 2)], COLUMNS)) == [(100, 200, 1, 3, 0, 0), (200, 100, 1, 3, 0, 0)]

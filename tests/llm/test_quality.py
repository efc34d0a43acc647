import math
import random
import re
import zlib

import numpy as np
import pytest

from lienspark.llm import quality

SF = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = quality.quality_classifier(spark, SF).collect()
    out = [r for r in found if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in out]) > 0.98
    good = [r.predicted for r in out if labels[r.doc_id] == 1]
    assert np.mean(good) > 0.99
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)


def test_descent_reaches_the_optimum():
    """No small step from the fitted weights lowers the objective."""
    rng = np.random.default_rng(2)
    rows = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(80)]
    values = [np.full(6, 6**-0.5) for _ in rows]
    signs = np.where([(r < 12).sum() > 2 for r in rows], 1.0, -1.0)
    weights, bias = quality._descend(rows, values, signs)

    def objective(w, b):
        margins = np.array([w[r] @ v + b for r, v in zip(rows, values)])
        return (w @ w + b * b) / 2 + quality.COST * np.maximum(0, 1 - signs * margins).sum()

    best = objective(weights, bias)
    for _ in range(200):
        w = weights.copy()
        w[:30] += rng.normal(0, 0.01, 30)
        assert objective(w, bias + rng.normal(0, 0.01)) > 0.99 * best


def test_features_are_distinct_and_by_document():
    text = b"Ab ab! ab ab\n12 ### x"
    data = np.frombuffer(text + text, np.uint8)
    doc, feature = quality.features(data, np.array([0, len(text), len(text), 2 * len(text)]))
    first, last = feature[doc == 0], feature[doc == 2]
    assert not (doc == 1).any() and (first == last).all() and len(set(first.tolist())) == len(first)


def test_awkward_rows(awkward, nothing, table):
    labels = table([(1, 1, 0), (1, 0, 0), (2, 1, 0), (3, None, 0), (None, 0, 0), (8, 0, 0), (6, 0, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(awkward, labels)
    found = quality.score(awkward, model)
    assert found.count() == awkward.count() and set(awkward.columns) <= set(found.columns)
    assert all(0 <= r.score <= 1 for r in found.collect())
    empty = {r.score for r in found.collect() if r.doc_id in (3, 4)}
    assert len(empty) == 1
    assert quality.score(nothing, model).count() == 0
    assert quality.keep(awkward, model).columns == awkward.columns


@pytest.mark.parametrize("rows, share", [([], 0.5), ([(1, 1), (2, 1)], 0.75), ([(1, 0)], 1 / 3)])
def test_labels_of_one_class(awkward, table, rows, share):
    model = quality.train(awkward.dropDuplicates(["doc_id"]), table(rows, "doc_id long, quality int"))
    assert {round(r.score, 9) for r in quality.score(awkward, model).collect()} == {round(share, 9)}


def plain_features(text):
    data, found = (text or "").encode(), set()
    for i in range(len(data) - 2):
        found.add(int.from_bytes(data[i : i + 3], "little") * 2654435761 % 2**32 >> 16)
    shapes, last = [], None
    for word in re.findall(rb"[^\x20\x09-\x0D]+", data):
        kinds = (rb"[A-Z]", rb"[a-z]", rb"[0-9]", rb"[#*$%&|<>!]")
        bits = [bool(re.search(kind, word)) for kind in kinds] + [len(word) == 1, word == last]
        shapes.append(sum(bit << k for k, bit in enumerate(bits)))
        last = word
    for size in (1, 2, 3):
        for i in range(len(shapes) - size + 1):
            code = size
            for shape in shapes[i : i + size]:
                code = code << 6 | shape
            found.add(2**16 + (code * 2654435761 % 2**32 >> 18))
    return sorted(found)


def plain_model(learned):
    """Ratios, weights, bias, slope and intercept from features and labels, by loops."""
    fitted = [x for i, x in enumerate(learned) if i % 4 != 3]
    kept_out = [x for i, x in enumerate(learned) if i % 4 == 3]
    counts = {label: dict.fromkeys(range(quality.FEATURES), 1.0) for label in (0, 1)}
    for features, label in fitted:
        for f in features:
            counts[label][f] += 1
    totals = {label: sum(c.values()) for label, c in counts.items()}
    ratio = {f: math.log(counts[1][f] / totals[1] * totals[0] / counts[0][f]) for f in counts[1]}

    def scaled(features):
        norm = math.sqrt(sum(ratio[f] ** 2 for f in features))
        return {f: ratio[f] / max(norm, 1e-12) for f in features}

    rows = [(scaled(features), 1 if label else -1) for features, label in fitted]
    weights, bias, alpha = {}, 0.0, [0.0] * len(rows)
    rng = np.random.default_rng(quality.SEED)
    for _ in range(quality.EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            row, sign = rows[i]
            slack = sign * (sum(weights.get(f, 0.0) * v for f, v in row.items()) + bias) - 1
            after = min(max(alpha[i] - slack / (sum(v * v for v in row.values()) + 1), 0.0), quality.COST)
            step, alpha[i] = (after - alpha[i]) * sign, after
            for f, v in row.items():
                weights[f] = weights.get(f, 0.0) + step * v
            bias += step
            moved = max(moved, abs(step))
        if moved < 1e-3:
            break

    def margin(features):
        return sum(weights.get(f, 0.0) * v for f, v in scaled(features).items()) + bias

    good = sum(label for _, label in kept_out)
    targets = {1: (good + 1) / (good + 2), 0: 1 / (len(kept_out) - good + 2)}
    points = [(margin(features), targets[label]) for features, label in kept_out]
    return margin, points


def test_against_plain_model(table):
    """Every score of a small table beside a model of plain loops; the calibration is
    held to be the least cross entropy of the rows kept out of the fit."""
    rng = random.Random(11)
    words = ["the", "of", "and", "report", "Water", "12", "x"]
    junk = ["$$$", "BUY!", "###", "a1b2", "win", "the", "x"]
    rows = [(i, " ".join(rng.choices(words if rng.random() < (0.8 if i % 2 else 0.3) else junk, k=rng.randint(3, 25)))) for i in range(70)]
    rows += [(100, None), (101, ""), (102, "ab"), (103, " \n"), (104, "é" * 300), (3, "a second text of an id"), (None, "the report of the water")]
    docs = table(rows, "doc_id long, text string")
    labels = {i: i % 2 for i in range(70)} | {101: 0, 104: 1}
    model = quality.train(docs, table(list(labels.items()), "doc_id long, quality int"))
    learned = sorted(
        (i, tuple(plain_features(text)), labels[i]) for i, text in rows if i in labels and zlib.crc32(str(i).encode()) % 5
    )
    margin, points = plain_model([(features, label) for _, features, label in learned])

    def entropy(slope, intercept):
        chances = [1 / (1 + math.exp(-slope * m - intercept)) for m, _ in points]
        return -sum(t * math.log(p) + (1 - t) * math.log(1 - p) for p, (_, t) in zip(chances, points))

    least = entropy(model.slope, model.intercept)
    for a, b in ((0.01, 0), (-0.01, 0), (0, 0.01), (0, -0.01), (0.01, -0.01), (-0.01, 0.01)):
        assert entropy(model.slope + a, model.intercept + b) > least - 1e-9

    expected = []
    for i, text in rows:
        chance = 1 / (1 + math.exp(-model.slope * margin(plain_features(text)) - model.intercept))
        expected.append((str(i), chance))
    found = [(str(r.doc_id), r.score) for r in quality.score(docs, model).collect()]
    assert len({round(p, 3) for _, p in found}) > 30
    for (i, p), (j, q) in zip(sorted(found), sorted(expected), strict=True):
        assert i == j and p == pytest.approx(q, abs=1e-6)

import math
import random
import zlib

import numpy as np
import pytest

from lienspark.llm import language
from lienspark.llm.language import PAD, STEPS, Network

SF = "/root/testdata/sf0.01"


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    network = Network.fresh(["a", "b", "c"], hidden=4)
    network.weights = {k: w.astype(np.float64) for k, w in network.weights.items()}
    window = rng.integers(0, 256, (7, 5))
    window[4:, 0] = PAD
    label = rng.integers(0, 3, 5)

    def loss():
        real = window != PAD
        total = 0.0
        for step, chances in enumerate(network.chances(window)):
            total -= (np.log(chances[label, np.arange(5)]) * real[step]).sum()
        return total / real.sum()

    gradient = network.gradient(window, label)
    for name, weights in network.weights.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in weights.shape)
            if name.endswith("_in"):
                at = (at[0], int(rng.choice(window.ravel())))
            kept, step = weights[at], 1e-2
            weights[at] = kept + step
            above = loss()
            weights[at] = kept - step
            below = loss()
            weights[at] = kept
            assert gradient[name][at] == pytest.approx((above - below) / (2 * step), abs=2e-3)


def test_document_chances_are_the_mean_over_bytes():
    network = Network.fresh(["a", "b"])
    texts = [b"", b"x", bytes(range(200)), b"hello world " * 300]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    found = language.pooled(network, data, offsets)
    assert found[0].tolist() == [0, 0]
    for text, chances in list(zip(texts, found))[1:]:
        total = np.zeros(2)
        for low in range(0, len(text), STEPS):
            piece = np.frombuffer(text[low : low + STEPS], np.uint8).astype(np.int64)
            padded = np.full((STEPS, 1), PAD)
            padded[: len(piece), 0] = piece
            steps = list(network.chances(padded))[: len(piece)]
            total += np.sum(steps, axis=0)[:, 0]
        assert chances == pytest.approx(total / len(text), abs=1e-5)


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.language_id(spark, SF).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    right = [r.lang_pred == truth[r.doc_id] for r in found if r.held_out]
    assert len(right) > 100 and np.mean(right) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_awkward_rows(awkward, nothing):
    network = language.train(awkward)
    found = language.predict(awkward, network).collect()
    assert len(found) == awkward.count()
    assert {(r.lang_pred, r.score) for r in found if r.doc_id in (3, 4, 5, 10)} == {("und", 0.0)}
    assert {r.lang_pred for r in found if r.doc_id in (1, 2, 7)} <= {"en", "de"}
    assert language.predict(nothing, network).count() == 0
    assert language.train(nothing) is None
    assert {r.lang_pred for r in language.predict(awkward, None).collect()} == {"und"}


def plain_chances(network, text):
    """The mean over a text's bytes of the chances, one byte and unit after the other."""
    w = {name: value.astype(float).tolist() for name, value in network.weights.items()}
    hidden = len(w["forth_state"])

    def clipped(x, low):
        return min(max(x, low), 1.0)

    def read(piece, way):
        state, states = [0.0] * hidden, []
        for byte in piece:
            given = [row[byte] for row in w[f"{way}_in"]]
            gates = [clipped(given[k] + sum(a * b for a, b in zip(row, state)), 0.0) for k, row in enumerate(w[f"{way}_gates"])]
            held = [gate * old for gate, old in zip(gates[hidden:], state)]
            new = [clipped(given[2 * hidden + k] + sum(a * b for a, b in zip(row, held)), -1.0) for k, row in enumerate(w[f"{way}_state"])]
            state = [old + gate * (now - old) for old, gate, now in zip(state, gates, new)]
            states.append(state)
        return states

    data, total = text.encode(), [0.0] * len(network.languages)
    for low in range(0, len(data), STEPS):
        piece = list(data[low : low + STEPS])
        padding = [PAD] * (STEPS - len(piece))
        forth, back = read(piece, "forth"), read(padding + piece[::-1], "back")[::-1]
        for ahead, behind in zip(forth, back):
            odds = [
                sum(a * b for a, b in zip(w["forth_out"][k], ahead)) + sum(a * b for a, b in zip(w["back_out"][k], behind)) + w["out"][k][0]
                for k in range(len(total))
            ]
            whole = sum(math.exp(x) for x in odds)
            total = [t + math.exp(x) / whole for t, x in zip(total, odds)]
    return [t / len(data) for t in total]


@pytest.fixture(scope="module")
def small():
    rng = random.Random(4)
    words = {"en": "the of and water".split(), "fr": "été le où garçon".split(), "de": "über und zwölf daß".split()}
    rows = [(i, " ".join(rng.choices(words[lang], k=rng.randint(1, 40))), lang) for i, lang in enumerate(list(words) * 12)]
    return rows + [(100, None, "en"), (101, "", "fr"), (102, "12 + 3", "de"), (103, "the", None), (104, "und " * 300, "de"), (3, "le été", "en"), (None, "où", "xx")]


SCHEMA = "doc_id long, text string, lang string"


def test_against_plain_network(table, small):
    docs = table(small, SCHEMA)
    network = language.train(docs)
    expected = []
    for i, text, _ in small:
        if text and any(c.isalpha() for c in text):
            chances = plain_chances(network, text)
            expected.append((str(i), network.languages[int(np.argmax(chances))], max(chances)))
        else:
            expected.append((str(i), "und", 0.0))
    found = [(str(r.doc_id), r.lang_pred, r.score) for r in language.predict(docs, network).collect()]
    assert network.languages == ["de", "en", "fr"] and {x[1] for x in found} == {"de", "en", "fr", "und"}
    for one, two in zip(sorted(found), sorted(expected), strict=True):
        assert one[:2] == two[:2] and one[2] == pytest.approx(two[2], abs=1e-4)


def test_held_out_rows_teach_nothing(table, small):
    changed = [(i, "x" if (out := i is None or zlib.crc32(str(i).encode()) % 4 == 2) else text, "zz" if out else lang) for i, text, lang in small]
    assert changed != small
    one, two = (language.train(table(rows, SCHEMA)) for rows in (small, changed))
    assert one.languages == two.languages
    assert all((one.weights[name] == two.weights[name]).all() for name in one.weights)


def test_repeated_ids_are_learned_from_once(table, small, monkeypatch):
    """Copies of a row leave the network as it is; of two texts of an id the least teaches."""
    (i, text, lang), other = small[0], "zzz"
    assert zlib.crc32(str(i).encode()) % 4 != 2 and text < other
    drawn = []
    fit = language.train_network

    def counted(windows, labels, languages):
        drawn.append(len(windows))
        return fit(windows, labels, languages, rounds=5)

    monkeypatch.setattr(language, "train_network", counted)
    one, two = (language.train(table(rows, SCHEMA)) for rows in (small, small + [(i, text, lang)] * 500 + [(i, other, lang)]))
    assert drawn[0] == drawn[1]
    assert all((one.weights[name] == two.weights[name]).all() for name in one.weights)


def test_equal_chances_go_to_the_language_that_sorts_first(table, small):
    network = Network.fresh(["a", "b", "c"])
    for name in ("forth_out", "back_out", "out"):
        network.weights[name][:] = 0
    found = language.predict(table(small, SCHEMA), network).collect()
    assert {r.lang_pred for r in found} == {"a", "und"}

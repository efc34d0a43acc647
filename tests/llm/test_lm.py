import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lienspark.llm import lm
from lienspark.llm.lm import Level, Tokens, Trie, Unigrams


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\0"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    common = ["the", "of", "And", "a", "É"]
    out = []
    for i in range(150):
        words = [rng.choice(common) if rng.random() < 0.7 else f"w{rng.randrange(400)}" for _ in range(rng.choice([0, 1, 3, 30, 200]))]
        out.append((i, " ".join(words)))
    return out + [(500, None), (501, ""), (502, "\n")]


def counts(rows):
    found = Counter()
    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 10:
            found.update(tokens(text))
    return found


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 500])
def test_counts_and_base(table, rows, chunk_bytes):
    c = counts(rows)
    n, v = sum(c.values()), len(c)
    texts = dict(rows)
    found = lm.language_scores(table(rows), chunk_bytes=chunk_bytes).collect()
    assert len(found) == len(rows)
    for r in found:
        mine = tokens(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(mine), sum(c[t] > 0 for t in mine), n)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert r.base_score == pytest.approx(sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in mine))


def plain_score(rows, text, word_share, ngram_share):
    """The model with dictionaries in place of the trie and without codes."""
    learned = [tokens(t) for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    size = sum(len((t or "").encode()) for i, t in rows if zlib.crc32(str(i).encode()) % 10)
    c = counts(rows)
    n, v = sum(c.values()), len(c)
    alone = lambda t: (c[t] + 0.1) / (n + 0.1 * (v + 1))
    held = [{(t,): k for t, k in c.items() if k >= word_share * size}]
    for order in (2, 3):
        grams = Counter(tuple(d[i : i + order]) for d in learned for i in range(len(d) - order + 1))
        held.append({g: k for g, k in grams.items() if k >= max(2, ngram_share * size) and g[:-1] in held[-1] and g[-1:] in held[0]})

    def chance(context, word):
        if not context:
            return alone(word)
        if context not in held[len(context) - 1]:
            return chance(context[1:], word)
        if context + (word,) in held[len(context)]:
            return (held[len(context)][context + (word,)] - 0.5) / held[len(context) - 1][context]
        mine = [g[-1] for g in held[len(context)] if g[:-1] == context]
        left = 1 - sum((held[len(context)][context + (w,)] - 0.5) / held[len(context) - 1][context] for w in mine)
        return left / (1 - sum(chance(context[1:], w) for w in mine)) * chance(context[1:], word)

    mine = tokens(text)
    everything = sum(chance(("the", "of"), w) for w in [*c, "never seen"])
    return sum(math.log10(chance(tuple(mine[max(0, i - 2) : i]), t)) for i, t in enumerate(mine)), everything


def test_scores_are_those_of_the_plain_model(table, rows):
    shares = {"word_share": 2e-3, "ngram_share": 5e-4}
    found = {r.doc_id: r for r in lm.language_scores(table(rows), **shares, chunk_bytes=2000).collect()}
    for i in (0, 3, 5, 8, 13, 21, 34, 55, 89, 144, 500, 501):
        score, everything = plain_score(rows, dict(rows)[i], **shares)
        assert everything == pytest.approx(1)
        assert found[i].score == pytest.approx(score, abs=1e-3 * found[i].n_tokens + 1e-9)


def test_what_occurs_twice_is_held_at_any_size(table):
    mine = [(3, "seen rarely indeed by anyone"), (4, "seen rarely indeed by some"), (10, "seen rarely indeed by anyone")]
    filler = [(20 + i, "the same words in every line of it " * 6000) for i in range(20)]
    assert sum(len(t) for _, t in filler) > 4_000_000
    found = {r.doc_id: r for r in lm.language_scores(table(mine + filler)).collect()}
    for i, text in mine:
        score, _ = plain_score(mine + filler, text, 0, 0)
        assert found[i].score == pytest.approx(score, abs=1e-2)


def test_shards_hold_the_whole_model(table, rows, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_BYTES", 3000)
    found = {r.doc_id: r for r in lm.language_scores(table(rows), chunk_bytes=2000).collect()}
    assert len(found) == len(rows)
    for i in (0, 3, 8, 21, 55, 89, 144, 500):
        score, everything = plain_score(rows, dict(rows)[i], 0, 0)
        assert everything == pytest.approx(1)
        assert found[i].score == pytest.approx(score, abs=1e-3 * found[i].n_tokens)


@pytest.mark.parametrize("change", ["no find", "other codes"])
def test_scores_come_from_the_trie(table, rows, monkeypatch, change):
    """What the shards do not find, or hold with another code, scores otherwise."""
    plain = {r.doc_id: r.score for r in lm.language_scores(table(rows)).collect()}
    if change == "no find":
        monkeypatch.setattr(Level, "find", lambda self, parent, word: np.full(len(parent), -1, np.int64))
    else:
        of = Level.of.__func__
        monkeypatch.setattr(Level, "of", classmethod(lambda cls, n, parent, word, codes: of(cls, n, parent, word, codes + 30)))
    found = {r.doc_id: r.score for r in lm.language_scores(table(rows)).collect()}
    changed = [i for i, text in rows if abs(found[i] - plain[i]) > 1e-3]
    assert len(changed) > 0.8 * sum(len(text or "") > 20 for _, text in rows)


def test_frequent_ngrams(table):
    """Counts of which the codes are not exact."""
    rows = [(i, "all of the same " * 3000 + f"end{i % 3} of all") for i in range(12)]
    found = {r.doc_id: r for r in lm.language_scores(table(rows)).collect()}
    for i, text in rows[:3]:
        score, everything = plain_score(rows, text, 0, 0)
        assert everything == pytest.approx(1)
        assert found[i].score == pytest.approx(score, abs=1e-3 * found[i].n_tokens)


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    found = [r for r in lm.lm_scoring(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert len(found) > 50
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


def test_a_level_finds_what_it_holds():
    rng = np.random.default_rng(4)
    pairs = np.unique(rng.integers(0, 50, (600, 2)) * [1, 7], axis=0)
    level = Level.of(60, pairs[:, 0], pairs[:, 1], np.arange(len(pairs)))
    asked = np.array([(p, w) for p in range(-1, 60) for w in range(-1, 360)])
    place = {tuple(x): i for i, x in enumerate(pairs.tolist())}
    assert level.find(asked[:, 0], asked[:, 1]).tolist() == [place.get(tuple(x), -1) for x in asked.tolist()]


def test_a_mapped_trie_is_the_same():
    rng = np.random.default_rng(5)
    words = np.sort(rng.integers(0, 2**63, 40).astype(np.uint64))
    pairs = np.unique(rng.integers(0, 40, (100, 2)), axis=0)
    more = np.unique(np.stack((rng.integers(0, len(pairs), 50), rng.integers(0, 40, 50)), axis=1), axis=0)
    levels = [Level.of(40, *pairs.T, rng.integers(0, 9000, len(pairs))), Level.of(len(pairs), *more.T, rng.integers(0, 9000, len(more)))]
    trie = Trie(words, levels)
    again = Trie.mapped(trie.serialised())
    for a, b in zip(trie.arrays(), again.arrays(), strict=True):
        assert (a == b).all() and a.dtype == b.dtype


def test_tokens_of_empty_texts():
    found = Tokens(pa.array([None, "", "A b", " "], pa.string()))
    assert found.bounds.tolist() == [0, 1, 2, 5, 6]
    assert Unigrams(0, 0).log(np.array([0])).tolist() == [0.0]


def test_awkward_rows(awkward, nothing):
    found = lm.language_scores(awkward).collect()
    assert len(found) == awkward.count()
    assert {r.n_tokens for r in found if r.doc_id in (3, 4, 5)} == {1}
    assert [r.held_out for r in found if r.doc_id is None] == [False, False]
    assert lm.language_scores(nothing).count() == 0
    unlearned = lm.language_scores(awkward.where("doc_id IS NULL")).collect()
    assert {(r.train_tokens, r.n_known, r.base_score, r.score) for r in unlearned} == {(0, 0, 0.0, 0.0)}

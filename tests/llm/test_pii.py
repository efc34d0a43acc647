import hashlib
import random
import re

import numpy as np
import pytest

from lienspark.llm import pii
from lienspark.llm.boosting import boost

HARD = [
    "a@b.c_d@e.f x@@y.z a@b@c.d .@. %+-@1-.2 a@b..c@d.e",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.003.255 1..2.3.4 9.9.9.9.",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111111 4111  1111 1111 1111 4111111111111111 2",
    "+1 (803) 555-5351, +12345 +1--2 +49 30 1234567 x+4 4 4 4 4 4 4 4 4 4 4 4 4 4 4 4 4 +",
    "+1 (803) 555-5351 +1 (803) 555-5351",
    "1" * 5000 + "." + "2" * 5000,
    "a" * 3000 + "@" + "b" * 3000,
    "Ünï 😀 mail: x.y@host.example.com, 10.0.0.1!",
]


def digits(text):
    return "".join(re.findall("[0-9]", text))


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def small(part):
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255


def plain(text):
    """The patterns as they are written, in order."""
    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(small(p) for p in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15],
    }


@pytest.mark.parametrize("text", HARD)
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


def test_base_spans_of_random_texts():
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice("12 4.@+-_ab%().") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain(text)


def test_query_over_the_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    secrets = found_secrets = 0
    for r in pii.pii(spark, folder).collect():
        base = plain(texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, spans in base.items() for s, e in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(map(len, base.values()))
        every = [x for x in r.spans.split(",") if x]
        assert {x for x in joined.split(",") if x} <= set(every)
        order = [(pii.KINDS.index(k), int(s)) for k, s, _ in (x.split(":") for x in every)]
        assert order == sorted(order)
        for m in re.finditer(r'token = "([0-9a-f]{20,})"', texts[r.doc_id]):
            secrets += 1
            found_secrets += f"secret:{m.start(1)}:{m.end(1)}" in every
        if not re.search(r"[0-9@]", texts[r.doc_id]):
            assert r.spans == ""
    assert secrets and found_secrets / secrets > 0.95


def test_masking():
    text = "mail a@b.cd or call +1 (803) 555-5351 now"
    spans = [("phone", 20, 37), ("email", 5, 11)]
    assert text[20:37] == "+1 (803) 555-5351"
    assert pii.masked(text, spans) == "mail [EMAIL] or call [PHONE] now"
    assert pii.masked("abcdef", [("ip", 1, 4), ("card", 2, 5)]) == "a[IP]f"
    assert pii.masked("abc", []) == "abc"


def test_trees_learn_a_rule():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(2000, 4))
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 2] > 0)).astype(float)
    trees = boost(rows[:1500], labels[:1500])
    assert ((trees.probabilities(rows[1500:]) > 0.5) == labels[1500:]).mean() > 0.95
    assert boost(np.zeros((0, 3)), np.zeros(0)).probabilities(np.zeros((2, 3))).tolist() == [0.5, 0.5]


def test_copies_take_no_training_places(table):
    """One candidate in thousands of copies, some hundred others once: all of those asked for are drawn."""
    texts = ["write to same.person@one.example.com now"] * 3000
    texts += [f"write to person{i}@host{i % 7}.example.com, call +1 (803) 555-{1000 + i} or see 10.1.{i % 250}.{i // 250}" for i in range(400)]
    docs = table(list(enumerate(texts)))
    every = pii.drawn_candidates(docs, 10**6)
    assert len(every) == len(set(map(str, every))) > 1200
    assert len({r[2] for r in every if r[0] == "written"}) == 401
    some = pii.drawn_candidates(docs, 300)
    assert len(some) == len(set(map(str, some))) == 300
    assert sorted(map(str, some)) == sorted(map(str, pii.drawn_candidates(docs.repartition(11), 300)))


def test_a_long_span_is_described_whole(table):
    long = "a1" * 300
    (drawn,) = pii.drawn_candidates(table([(1, f"token = {long} end")]))
    g, before, span, after, label, features = drawn
    assert (g, span, after, label) == ("run", long[: pii.CUT], " e", True)
    text = f"token = {long} e"
    assert features == [float(v) for v in pii.describe(g, text, len(before), len(before) + 600)]


def test_redaction_and_awkward_rows(awkward, nothing, table):
    docs = table(
        [(i, f"word mail{i}@host{i}.example.com and 10.0.0.{i} or +1 (803) 555-{5000 + i} text") for i in range(40)] + [(99, "plain words"), (98, None)]
    )
    model = pii.train(docs)
    out = {r.doc_id: r.text for r in pii.redact(docs, model).collect()}
    assert out[7] == "word [EMAIL] and [IP] or [PHONE] text" and out[99] == "plain words" and out[98] is None
    found = pii.find(awkward, model).collect()
    assert len(found) == awkward.count()
    assert {r.base_sha256 for r in found if r.doc_id in (3, 4)} == {hashlib.sha256(b"").hexdigest()}
    redacted = pii.redact(awkward, model)
    assert redacted.columns == awkward.columns and redacted.count() == awkward.count()
    assert pii.find(nothing, pii.train(nothing)).count() == 0

import hashlib
import random

import duckdb
import pytest

from lienspark.llm import chat
from lienspark_checks.compare import differences

PIECES = ["\\", "\\\\", "a", "é\U0001f600", "\n", " ", "", *chat.MARKS, "[INST", "</", "\\</s>"]
COLUMNS = "conv_id long, turn long, role string, text string"


def some(rng, most=6):
    return "".join(rng.choice(PIECES) for _ in range(rng.randrange(most)))


def test_every_turn_comes_back():
    rng = random.Random(5)
    for _ in range(3000):
        role = rng.choice(["user", "assistant", "system", "tool", "", some(rng)])
        turns = [(role, some(rng)), ("user", some(rng)), (some(rng), some(rng))]
        out = "".join(chat.rendered(*turn)[0] for turn in turns)
        back = list(chat.parsed(out))
        assert [turn[:2] for turn in back] == turns
        assert [chat.unescaped(out[start:end]) for _, _, start, end in back] == [text for _, text in turns]


def test_only_what_conflicts_is_escaped():
    assert chat.rendered("user", "a \\ b [INST") == ("[INST]a \\ b [INST[/INST]", 6, 17)
    assert chat.rendered("user", "[INST]")[0] == "[INST]\\[INST][/INST]"
    assert chat.rendered("assistant", "ends in \\")[0] == "<s>ends in \\\\</s>"
    assert chat.rendered("tool", "<s>")[0] == "[ROLE]tool[/ROLE]\\<s>[END]"
    assert chat.rendered("[END]", "plain \\ text")[0] == "[ROLE]\\[END][/ROLE]plain \\ text[END]"


@pytest.mark.parametrize("bad", ["a", "[INST]a", "[INST]a</s>", "[INST]a[INST][/INST]", "[ROLE]a[END]", "</s>", "\\<s>a</s>"])
def test_what_the_grammar_does_not_have(bad):
    with pytest.raises(chat.Broken):
        list(chat.parsed(bad))


def plain(rows):
    """The read-back columns of rows in order of conversations and turns."""
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    out = {}
    for conv, turns in found.items():
        turns = [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1] or 0, chat.rendered(*t[2:])[0]))]
        loss = "".join(text for role, text in turns if role == "assistant")
        out[conv] = (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
            sum(len(chat.rendered(*t)[0]) for t in turns),
        )
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    roles = ["user", "assistant", "system", "tool", "Assistant", "", None, "[END]", "x\\"]
    out = [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(40)]), rng.choice(roles), rng.choice([None, some(rng, 9)])) for _ in range(400)]
    out += [(9, i, ("user", "assistant")[i % 2], "turn " * (i % 7)) for i in range(900)]
    return out + out[:5] + [(10, 0, "assistant", "x" * 30_000), (11, None, None, None)]


@pytest.mark.parametrize("chars", [1, 500, chat.PIECE_CHARS])
def test_conversations_come_back(table, rows, monkeypatch, chars):
    monkeypatch.setattr(chat, "PIECE_CHARS", chars)
    pieces = chat.format_conversations(table(rows, COLUMNS))
    expected = plain(rows)
    for found in (chat.read_back(pieces, in_order=True), chat.read_back(pieces)):
        assert {r[0]: tuple(r[1:]) for r in found.collect()} == expected
    kept = pieces.collect()
    assert max(len(r.formatted) for r in kept) <= chars + 30_010
    assert (len(kept) > len(expected)) == (chars < 1000)


def test_agrees_with_sql(table, rows):
    docs = table(rows, COLUMNS)
    con = duckdb.connect()
    con.register("conversations", docs.toArrow())
    found = chat.read_back(chat.format_conversations(chat.with_control(docs)), in_order=True)
    assert differences(found, con, chat.oracle()) is None


def test_control_empty_tables_and_clashing_columns(table, rows):
    clashing = table(rows, COLUMNS).selectExpr("*", *(f"'x' AS {n}" for n in "formatted start end piece loss n_turns id".split()))
    assert {r[0]: tuple(r[1:]) for r in chat.read_back(chat.format_conversations(clashing)).collect()} == plain(rows)
    nothing = clashing.where("false")
    assert chat.format_conversations(nothing).count() == 0
    (control,) = chat.read_back(chat.format_conversations(chat.with_control(nothing))).collect()
    assert control.conv_id == -1 and control.n_turns == 2 and control.loss_chars == len(chat.CONTROL_TEXT)
    assert control.loss_sha256 == hashlib.sha256(chat.CONTROL_TEXT.encode()).hexdigest()

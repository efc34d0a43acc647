import hashlib
import random
import re
import zlib
from itertools import groupby, product

import duckdb
import pytest

from lienspark.llm import repair
from lienspark_checks.compare import differences

COLUMNS = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


def every_edit(rows):
    """Cost and audit of each way with at most two insertions in a row, by trial."""
    per_row = {row: ["D"] if row == "D" else ["K", "D", "Ru", "Ra"] for row in rows}
    gaps = ["", "u", "a", "ua", "au"]
    found = []
    for inserted in product(gaps, repeat=len(rows) + 1):
        for edits in product(*(per_row[row] for row in rows)):
            cost, audit, roles = 0, "", ""
            for gap, row, edit in zip(inserted, [*rows, None], [*edits, None]):
                cost, audit, roles = cost + 3 * len(gap), audit + "I" * len(gap), roles + gap
                if edit is None:
                    continue
                audit += edit[0]
                roles += {"K": row.lower(), "D": ""}.get(edit, edit[1:])
                cost += {"K": 0, "D": 4, "R": 3}[edit[0]] + (3 if edit != "D" and row.isupper() else 0)
            if PATTERN.fullmatch(roles):
                found.append((cost, audit))
    return min(found)


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_search_finds_the_cheapest_and_least(length):
    for rows in product("suaxSUAD", repeat=length):
        if length < 3 or random.Random("".join(rows)).random() < 0.15:
            assert repair.cheapest("".join(rows), 0, repair.COMPLETE, True) == every_edit(rows), rows


def forward(rows):
    """Least (cost, audit) of the whole, state by state and row by row."""
    states = {0: (0, "")}

    def inserted(states):
        for _ in range(2):
            for state, (cost, audit) in list(states.items()):
                role = "a" if state == 2 else "u"
                after = repair.NEXT[state][role]
                states[after] = min(states.get(after, (9e9,)), (cost + 3, audit + "I"))
        return states

    for row in rows:
        states, before = {}, inserted(states)
        for state, (cost, audit) in before.items():
            ways = [(state, 4, "D")]
            if row != "D":
                more = 3 if row.isupper() else 0
                after = repair.NEXT[state]
                ways += [(after[row.lower()], more, "K")] if row.lower() in after else []
                ways += [(after["a" if state == 2 else "u"], more + 3, "R")]
            for to, more, edit in ways:
                states[to] = min(states.get(to, (9e9,)), (cost + more, audit + edit))
    states = inserted(states)
    return min(states[q] for q in (0, 3) if q in states)


def test_long_rows_and_chunks_agree(monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(repair, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("P", (), {"partitionId": staticmethod(lambda: 0)}))}))
    for _ in range(150):
        rows = "".join(rng.choice("uuuaaasxUAD") for _ in range(rng.randrange(1, 90)))
        expected = forward(rows)
        assert repair.cheapest(rows, 0, repair.COMPLETE, True) == expected
        cuts = sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, rng.randrange(6))))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        chunks = []
        for number, part in enumerate(parts):
            chunk = repair._Chunk(1, opens=number == 0 and rng.random() < 0.5)
            chunk.rows, chunk.first, chunk.last = list(part), "u", "u"
            chunks.append(chunk.record(number, rng.choice([None, number == len(parts) - 1])))
        ways = repair._chosen(chunks)
        audit = "".join(c["audits"][w["way"]] for c, w in zip(chunks, ways))
        assert (sum(w["cost"] for w in ways), audit) == expected


def plain(rows, damage=False):
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    if damage:
        out = []
        for conv, turn, role, text in rows:
            kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        rows = out
    found = {}

    def order(row):
        digest = hashlib.md5(f"{len(row[2])}:{row[2]}{row[3]}".encode()).hexdigest()
        return (row[0] is None, row[0] or 0, row[1] is not None, row[1] or 0, digest)

    for conv, own in groupby(sorted(rows, key=order), key=lambda r: r[0]):
        own, seen, code = list(own), set(), ""
        counts = dict.fromkeys(["blank", "duplicate", "truncated"], 0)
        for _, _, role, text in own:
            told = re.sub("[\x20\x09-\x0d]+$", "", text)
            fault = "blank" if not told else "duplicate" if (role, text) in seen else "truncated" if told[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            code += {"blank": "D", "duplicate": "D", "truncated": letter.upper()}.get(fault, letter)
        turns = [t for _, t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = forward(code)
        lines, state, left = [], 0, iter(own)
        for edit in audit:
            expected = "a" if state == 2 else "u"
            role, text = ("", "") if edit == "I" else next(left)[2:]
            if edit == "D":
                continue
            if edit in "IR":
                role = {"u": "user", "a": "assistant"}[expected]
            state = repair.NEXT[state][role[0]]
            lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found[conv] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return found


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    roles = ["user"] * 5 + ["assistant"] * 5 + ["system", "tool", "", None, "Üser", "uncle"]
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n", None, "end. \t", "ünï.", "a. ", "Yes. No"]
    out = []
    for conv in [None, *range(30)]:
        for turn in range(rng.choice([1, 2, 5, 9])):
            out.append((conv, rng.choice([turn, turn, turn, None, 3]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"{turn} words."))
    out += [(77, i, ("user", "assistant")[i % 2], f"turn {i}." if i % 9 else "cut") for i in range(2500)]
    out += [(78, 5, "user", "Same.")] * 700 + [(78, i, "user", "Same.") for i in range(300)]
    out += [(79, 1, "system", "Only system."), (80, 4, "user", ""), (81, None, None, None), (82, 0, "user", "x" * 40_000 + ".")]
    return out + out[:6]


@pytest.mark.parametrize("chunk", [3, repair.CHUNK_ROWS])
def test_repairs_agree_with_the_plain_way(table, rows, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK_ROWS", chunk)
    found = repair.repair_report(table(rows, COLUMNS).repartition(5)).collect()
    assert len(found) == len({r[0] for r in rows})
    expected = plain(rows)
    for row in found:
        assert tuple(row[1:]) == expected[row[0]], row[0]


def test_repaired_rows_read_as_they_should(table, rows):
    given = repair.values(table(rows, COLUMNS))
    made = repair.repaired(given, repair.repairs(given)).collect()
    by = {}
    for row in made:
        by.setdefault(row.conv_id, []).append(row)
    for own in by.values():
        assert [r.place for r in own] == list(range(len(own)))
        assert PATTERN.fullmatch("".join(r.role[0] for r in own))


def damaged_report(frame):
    return {tuple(r)[0]: tuple(r)[1:] for r in repair.repair_report(repair.damaged(frame)).collect()}


def test_damage_and_clashing_columns(table, rows):
    names = "kind key initial fault n copy of same seen task number way cost audit place at".split()
    frame = table(rows, COLUMNS).selectExpr("*", *(f"'x' AS {name}" for name in names))
    assert damaged_report(frame) == plain(rows, damage=True)
    assert damaged_report(frame.where("false")) == {}


def test_agrees_with_sql(spark, table, rows, tmp_path):
    few = [row for row in rows if row[0] not in (77, 78)]
    table(few, COLUMNS).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.register("conversations", table(few, COLUMNS).toArrow())
    assert differences(repair.repaired_conversations(spark, str(tmp_path)), con, repair.oracle()) is None

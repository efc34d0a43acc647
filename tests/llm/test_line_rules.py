import re

import duckdb
import pytest

from lienspark.llm import line_rules
from lienspark_checks.compare import differences

BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1} if len(words) < 500 else None
    covered = {i + k for i, w in enumerate(windows) if twice is None or w in twice for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures(awkward, table):
    texts = ["a b c a b c", "a a a a", "a b\nb a\na b\n\n \n", "#*$ %&|<> x", "x y z x y w x y z", "one\x0btwo\x0cthree\rfour"]
    frame = table([(100 + i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for docs in (frame, awkward):
        rows = docs.select("doc_id", "text").collect()
        found = line_rules.measures(docs).select(*BASE).collect()
        assert sorted(map(tuple, found), key=str) == sorted(((r.doc_id, *plain(r.text)) for r in rows), key=str)


def test_lines_above_the_limit(table):
    common, rare = "Shared  Line of the HOST here", "a rare line of seven words only"
    rows = [(i, f"{common}\n{rare} {i}\n{common}", "big") for i in range(6)]
    rows += [(10 + i, f"{common}\nsomething else {i} entirely my own", None) for i in range(3)]
    rows += [(20 + i, "shared line of the host here", "small") for i in range(2)]
    rows += [(30, f"{common} again", "same")] * 4 + [(None, f"{common} again", "same")] * 4
    docs = table(rows, "doc_id long, text string, source string")
    lines = line_rules.boilerplate(line_rules.measures(docs), documents=2).collect()
    assert sorted((r.host or "") for r in lines) == ["", "big"]
    counts = {r.doc_id: r.n_boilerplate for r in line_rules.judged(docs, documents=2).collect()}
    assert counts == {i: 12 for i in range(6)} | {10: 6, 11: 6, 12: 6, 20: 0, 21: 0, 30: 0, None: 0}


def compared(docs, con):
    found = line_rules.judged(docs)
    assert differences(found.drop("source"), con, line_rules.ORACLE) is None
    return found


def test_given_documents_agree_with_sql(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    assert compared(spark.read.parquet(path), con).where("n_boilerplate > 0").count() > 100


def test_registered_limits_reject_depleted_documents(table, tmp_path):
    """Documents just below and above each limit, as registered, beside the SQL."""
    shared = [" ".join(f"s{n}x{i}" for i in range(n)) for n in (30, 31, 60)]

    def own(doc, n):
        return " ".join(f"d{doc}w{i}" for i in range(n))

    rows = [(i, f"{own(i, 30)}\n{shared[0]}", "few") for i in range(5)]
    rows += [(10 + i, f"{own(10 + i, 60)}\n{shared[2].upper()}", "half") for i in range(6)]
    rows += [(20 + i, f"{own(20 + i, 59)}\n{shared[2]}", "more") for i in range(6)]
    rows += [(30 + i, f"{own(30 + i, 49 + i % 2)}\n{shared[1]}", "left") for i in range(6)]
    rows += [(40 + i % 5, f"{own(40 + i, 30)}\n{shared[0]}", "twice") for i in range(9)]
    rows += [(None, f"{own(50 + i, 30)}\n{shared[0]}", None) for i in range(9)]
    docs = table(rows, "doc_id long, text string, source string")
    docs.toPandas().astype({"doc_id": "Int64"}).to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    found = compared(docs, con).collect()
    assert {r.doc_id for r in found if not r.kept} == {20, 21, 22, 23, 24, 25, 30, 32, 34}
    assert not any(r.base_failed for r in found)


def test_texts_lose_the_lines_above_the_limits(table):
    common = "Shared  Line of the HOST here"
    texts = {i: f"first {i}\n{common}\n\n \nlast {i}\nshared line of the host here\n" for i in range(4)}
    texts |= {10: f"{common}", 11: "nothing shared\n", 12: None, 13: ""}
    found = line_rules.cleaned(table([(i, t, "h") for i, t in texts.items()], "doc_id long, text string, source string"), documents=2)
    left = {r.doc_id: r.text for r in found.collect()}
    assert left == {i: f"first {i}\n\n \nlast {i}\n" for i in range(4)} | {10: "", 11: "nothing shared\n", 12: None, 13: ""}


def test_awkward_rows(awkward, nothing):
    found = line_rules.judged(awkward).collect()
    assert len(found) == awkward.count()
    assert {r.base_failed for r in found if r.doc_id in (3, 4, 5, 6, 7, 10)} == {True}
    assert {r.kept for r in found if r.doc_id in (1, 2)} == {True}
    assert line_rules.judged(nothing).count() == 0


@pytest.mark.parametrize("words", [49, 50])
def test_smallest_document(table, words):
    docs = table([(1, " ".join(f"w{i}" for i in range(words)), "h")], "doc_id long, text string, source string")
    assert line_rules.judged(docs).first().base_failed == (words < 50)

import random

import duckdb
import pytest

from lienspark.llm import mixing
from lienspark_checks.compare import differences


def sources(found, docs):
    of = {}
    names = {r.doc_id: r.source for r in docs.collect()}
    for r in found:
        of.setdefault(names[r.doc_id], []).append(r)
    return of


@pytest.fixture(scope="module")
def docs(table):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        source = rng.choice(["hot"] * 5 + ["a", "b", None, "", "é", "Z"])
        rows.append((i, source, " ".join(["word"] * rng.choice([0, 1, 5, 40, 300]))))
    rows += [(1000, "tiny", "three small words"), (1001, "none", None), (1002, "none", "")]
    return table(rows, "doc_id long, source string, text string")


def test_targets_and_takings(docs):
    found = mixing.mix_sources(docs).collect()
    assert len(found) == docs.count()
    total = sum(r.size for r in found)
    by_source = sources(found, docs)
    assert sum(rows[0].target for rows in by_source.values()) == pytest.approx(total)
    capped, free = [], []
    for place, name in enumerate(sorted(by_source, key=lambda s: (s is None, (s or "").encode()))):
        rows, weight = by_source[name], place % 3 + 1
        size = sum(r.size for r in rows)
        assert {r.source_size for r in rows} == {size}
        assert rows[0].target <= 3 * size + 1e-9
        (capped if rows[0].target >= 3 * size else free).append((weight, rows[0].target, size))
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 2
        assert all(0 <= r.taken <= 3 * r.size for r in rows)
    level = {round(target / weight, 6) for weight, target, _ in free}
    assert len(level) == 1 and len(capped) >= 2
    assert all(3 * size <= weight * level.copy().pop() + 1e-6 for weight, _, size in capped)


def test_reruns_agree_and_the_seed_matters(docs):
    first, again, other = (sorted(map(tuple, mixing.mix_sources(d, s).collect())) for d, s in ((docs, "x"), (docs.repartition(7), "x"), (docs, "y")))
    assert first == again != other


def plain_seats(weights, seats):
    have = [0] * len(weights)
    for _ in range(seats):
        best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * have[i] + 1), -i))
        have[best] += 1
    return have


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 1234])
def test_apportionment_is_sainte_lague(spark, seats):
    rng = random.Random(seats)
    groups = {g: [rng.choice([0, 1, 5, 50, 1000, rng.randint(1, 9999)]) for _ in range(n)] for g, n in (("x", 1), ("y", 7), ("z", 40))}
    rows = [(g, i, w, seats, sum(ws)) for g, ws in groups.items() for i, w in enumerate(ws)]
    parties = spark.createDataFrame(rows, "g string, number int, party_weight long, seats long, weight_sum long")
    found = {(r.g, r.number): r.quota for r in mixing.apportioned(parties, ["g"]).collect()}
    for g, ws in groups.items():
        if sum(ws):
            assert [found[g, i] for i in range(len(ws))] == plain_seats(ws, seats)


def test_large_block_and_shard_numbers_agree_with_sql(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    monkeypatch.setattr(mixing, "BLOCKS", 512)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert differences(mixing.mix_sources(docs), con, mixing.oracle()) is None


def test_joins_sources_beyond_the_broadcast_bound(docs, monkeypatch):
    few = sorted(map(tuple, mixing.mix_sources(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, mixing.mix_sources(docs).collect())) == few


def test_awkward_rows(awkward, nothing):
    found = mixing.mix_sources(awkward).collect()
    assert len(found) == awkward.count()
    assert {r.size for r in found if r.doc_id in (3, 4, 5)} == {0}
    assert mixing.mix_sources(nothing).count() == 0
    blank = mixing.mix_sources(awkward.where("doc_id IN (3, 4, 5)")).collect()
    assert {(r.target, r.taken) for r in blank} == {(0.0, 0)}

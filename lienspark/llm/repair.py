"""Conversation structure repair by bidirectional Dijkstra over the edit lattice.

A conversation is repaired when the initials of its roles read ``(s?(ua)+)?``: an
optional system turn, then user and assistant in turns. Its rows are edited in
order of their turns: Keep costs 0, Rerole to user or assistant 3, Delete 4, and a
turn without text Inserted 3. Blank rows and duplicates must be deleted; a truncated
row that stays adds 3. Of the cheapest edits those are taken whose initials (the
audit) come first in ASCII order. The audit determines the repaired rows.

The lattice has a node for each number of rows done and state of the pattern. A
search from the start and one from the end, each with a heap of its own, settle
nodes by cost, and among equal costs by rows done; a node's label is its least cost
and the least audit of it. They go on until their heaps' least costs exceed the
cheapest crossing, so that all crossings of equal cost are there, and the least
concatenated audit is taken. (Equal costs between the same nodes never belong to an
audit and a longer one that begins with it, so the least parts make the least
whole.)

Rows are reduced to initial, fault and a digest, and equal ones are counted, before
they are sorted over all tasks; a conversation of any length is spread over the
tasks it falls into. A task cuts its rows into chunks of at most ``CHUNK_ROWS`` and
searches the lattice of each, from every state in which it may begin to every state
in which it may end. What then meets for a conversation are its chunks' costs: some
numbers for each chunk, from which every chunk's first and last state follow. Texts
are moved once, to be put beside the audit. The digest of a repaired conversation
is made by one task, which holds the audit and a batch of rows, because SHA-256 has
to see its bytes in order.

Nulls and corner cases: a null role or text is one space; rows without a turn come
first and count for no gap; rows of one turn are in the order of a digest of role
and text; equal rows are duplicates of the first; a role of any other initial, the
empty one too, can only be reroled or deleted; rows without an id are one
conversation; an empty table gives no rows; other columns are ignored. Roles and
texts are compared by 128-bit digests.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.llm.io import written
from lienspark.llm.registry import read, registered

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = ("su", "ua", "au")
CHUNK_ROWS = 512
KNOWN_ROWS, KNOWN_RESULTS = 64, 1 << 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

# States: nothing yet, after system, after user, after assistant.
STATES = range(4)
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
EXPECTED = "uuau"
COMPLETE = (0, 3)
ROLE_OF = {"u": "user", "a": "assistant"}
FINAL = len(STATES)


def _steps(row: str, state: int) -> Iterator[tuple[int, int, str]]:
    """State after a row, cost and edit. A row is its initial, in capitals if it is truncated, or D."""
    yield state, DELETE_COST, DELETE
    if row == DELETE:
        return
    cost = TRUNCATED_COST if row.isupper() else 0
    after = NEXT[state].get(row.lower())
    if after is not None:
        yield after, cost, KEEP
    yield NEXT[state][EXPECTED[state]], cost + REROLE_COST, REROLE


Label = tuple[int, str]
Node = tuple[int, int]


class _Search:
    """One direction: labels so far, and the heap of nodes by cost and rows done."""

    def __init__(self, ends: list[Node], rows_done):
        self.labels: dict[Node, Label] = {node: (0, "") for node in ends}
        self.rows_done = rows_done
        self.heap = [(0, rows_done(node), node) for node in ends]
        heapq.heapify(self.heap)
        self.settled: set[Node] = set()

    def settle(self) -> Node | None:
        cost, _, node = heapq.heappop(self.heap)
        if node in self.settled or self.labels[node][0] != cost:
            return None
        self.settled.add(node)
        return node

    def offer(self, node: Node, label: Label) -> bool:
        old = self.labels.get(node)
        if old is not None and old <= label:
            return False
        self.labels[node] = label
        if old is None or old[0] != label[0]:
            heapq.heappush(self.heap, (label[0], self.rows_done(node), node))
        return True


def cheapest(rows: str, start: int, goals: tuple[int, ...], insert_last: bool) -> Label | None:
    """Least cost, and least audit of it, from a state before the rows to one after them.

    Insertions stand before a row, or with ``insert_last`` after the last one.
    """
    n = len(rows)
    ahead = _Search([(0, start)], lambda node: node[0])
    back = _Search([(n, goal) for goal in goals], lambda node: n - node[0])
    best = 0 if n == 0 and start in goals else None

    def edges_from(node: Node) -> Iterator[tuple[Node, int, str]]:
        at, state = node
        if at < n or insert_last:
            yield (at, NEXT[state][EXPECTED[state]]), INSERT_COST, INSERT
        if at < n:
            for after, cost, edit in _steps(rows[at], state):
                yield (at + 1, after), cost, edit

    def edges_to(node: Node) -> Iterator[tuple[Node, int, str]]:
        at, state = node
        for before in STATES:
            if (at < n or insert_last) and NEXT[before][EXPECTED[before]] == state:
                yield (at, before), INSERT_COST, INSERT
            if at:
                for after, cost, edit in _steps(rows[at - 1], before):
                    if after == state:
                        yield (at - 1, before), cost, edit

    while ahead.heap and back.heap and (best is None or ahead.heap[0][0] + back.heap[0][0] <= best):
        forward = len(ahead.settled) <= len(back.settled)
        own, other = (ahead, back) if forward else (back, ahead)
        node = own.settle()
        if node is None:
            continue
        cost, audit = own.labels[node]
        for to, more, edit in (edges_from if forward else edges_to)(node):
            label = (cost + more, audit + edit if forward else edit + audit)
            if own.offer(to, label) and to in other.labels:
                total = label[0] + other.labels[to][0]
                best = total if best is None else min(best, total)
    if best is None:
        return None
    crossings = ((first, back.labels[node]) for node, first in ahead.labels.items() if node in back.labels)
    return best, min(first[1] + last[1] for first, last in crossings if first[0] + last[0] == best)


_known: dict[tuple[str, int, int], Label | None] = {}


def solved(rows: str, start: int, out: int) -> Label | None:
    """From a state to another, or to the end of the conversation for ``FINAL``.

    Short chunks repeat, so a task remembers their results.
    """
    key = (rows, start, out)
    if key not in _known:
        if len(_known) >= KNOWN_RESULTS:
            _known.clear()
        goals, last = (COMPLETE, True) if out == FINAL else ((out,), False)
        label = cheapest(rows, start, goals, last)
        if len(rows) > KNOWN_ROWS:
            return label
        _known[key] = label
    return _known[key]


class _Chunk:
    """Consecutive rows of one conversation in one task."""

    def __init__(self, conv: int | None, opens: bool):
        self.conv, self.opens = conv, opens
        self.rows: list[str] = []
        self.first = self.last = ""
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0}
        self.first_turn = self.last_turn = self.least_turn = None

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        if self.rows:
            self.counts["illegal"] += self.last + initial not in LEGAL
        else:
            self.first, self.first_turn = initial, turn
        if turn is not None and (not self.rows or turn != self.last_turn):
            self.counts["turns"] += 1
            self.least_turn = turn if self.least_turn is None else self.least_turn
        if fault:
            self.counts[fault] += 1
        self.last, self.last_turn = initial, turn
        self.rows.append(DELETE if fault in ("blank", "duplicate") else initial.upper() if fault else initial)

    def record(self, number: int, closes: bool | None) -> dict:
        """``closes``: whether the conversation ends here; None if it may."""
        rows = "".join(self.rows)
        costs, ranks, audits = [], [], []
        for start in STATES:
            found = []
            for out in (*STATES, FINAL):
                asked = (start == 0 or not self.opens) and (closes is None or closes == (out == FINAL))
                found.append(solved(rows, start, out) if asked else None)
            ordered = sorted({label[1] for label in found if label})
            costs += [label and label[0] for label in found]
            ranks += [label and ordered.index(label[1]) for label in found]
            audits += [label and label[1] for label in found]
        ends = {"first": self.first, "last": self.last, "first_turn": self.first_turn, "last_turn": self.last_turn, "least_turn": self.least_turn}
        place = {"conv_id": self.conv, "task": TaskContext.get().partitionId(), "number": number}
        return place | ends | self.counts | {"costs": costs, "ranks": ranks, "audits": audits}


_COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
_CHUNK_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("task", pa.int32()), ("number", pa.int64()), ("first", pa.string()), ("last", pa.string())]
    + [(name, pa.int64()) for name in ("first_turn", "last_turn", "least_turn", *_COUNTS)]
    + [("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]
)
_CHUNK_DDL = (
    "conv_id long, task int, number long, first string, last string, first_turn long, last_turn long, least_turn long, "
    + ", ".join(f"{name} long" for name in _COUNTS)
    + ", costs array<long>, ranks array<long>, audits array<string>"
)


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk, number, met = None, 0, 0
    for batch in batches:
        out: list[dict] = []

        def close(closes: bool | None, out=out) -> None:
            nonlocal number
            out.append(chunk.record(number, closes))
            number += 1

        for conv, turn, initial, fault, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "n")), strict=True):
            if chunk is None or chunk.conv != conv:
                if chunk is not None:
                    close(True)
                chunk, met = _Chunk(conv, opens=met > 0), met + 1
            for copy in range(n):
                if len(chunk.rows) == CHUNK_ROWS:
                    close(False)
                    chunk = _Chunk(conv, opens=False)
                chunk.add(turn, initial, fault if fault == "blank" or not copy else "duplicate")
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, _CHUNK_SCHEMA)
                out.clear()
        if out:
            yield pa.RecordBatch.from_pylist(out, _CHUNK_SCHEMA)
    if chunk is not None:
        yield pa.RecordBatch.from_pylist([chunk.record(number, None)], _CHUNK_SCHEMA)


def _chosen(chunks: list[dict]) -> list[dict]:
    """First and last state of each chunk of a conversation on its cheapest, least way."""
    wide = FINAL + 1
    still: list[list[int | None]] = []
    for place, chunk in reversed(list(enumerate(chunks))):
        onward = []
        for start in STATES:
            costs = chunk["costs"][start * wide : (start + 1) * wide]
            if place == len(chunks) - 1:
                onward.append(costs[FINAL])
            else:
                ways = [c + t for c, t in zip(costs[:FINAL], still[-1], strict=True) if c is not None and t is not None]
                onward.append(min(ways, default=None))
        still.append(onward)
    still.reverse()
    state, out, before = 0, [], None
    for place, chunk in enumerate(chunks):
        at = state * wide
        to = FINAL
        if place < len(chunks) - 1:
            costs, ranks = chunk["costs"][at : at + FINAL], chunk["ranks"][at : at + FINAL]
            after = still[place + 1]
            ways = [s for s in STATES if costs[s] is not None and after[s] is not None and costs[s] + after[s] == still[place][state]]
            to = min(ways, key=lambda s: ranks[s])
        own = {name: chunk[name] for name in ("conv_id", "task", "number", "least_turn", "last_turn", *_COUNTS)}
        if before is not None:
            own["illegal"] += before["last"] + chunk["first"] not in LEGAL
            own["turns"] -= chunk["first_turn"] is not None and chunk["first_turn"] == before["last_turn"]
        out.append(own | {"way": at + to, "cost": chunk["costs"][at + to]})
        state, before = to, chunk
    return out


_WAY_SCHEMA = pa.schema([("conv_id", pa.int64()), ("task", pa.int32())] + [(n, pa.int64()) for n in ("number", "least_turn", "last_turn", *_COUNTS, "way", "cost")])
_WAY_DDL = "conv_id long, task int, number long, least_turn long, last_turn long, " + ", ".join(f"{name} long" for name in (*_COUNTS, "way", "cost"))


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for batch in batches:
        out: list[dict] = []
        for chunk in batch.to_pylist():
            if held and held[0]["conv_id"] != chunk["conv_id"]:
                out += _chosen(held)
                held = []
            held.append(chunk)
        if out:
            yield pa.RecordBatch.from_pylist(out, _WAY_SCHEMA)
    if held:
        yield pa.RecordBatch.from_pylist(_chosen(held), _WAY_SCHEMA)


def _identity() -> Column:
    """A digest of role and text."""
    return F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))


def values(rows: DataFrame) -> DataFrame:
    """The four columns, with one space for a missing role or text."""
    texts = (F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name) for name in ("role", "text"))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *texts)


def faults(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn counted, each with its first fault: ``conv_id turn key initial fault n``."""
    told = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        "conv_id",
        "turn",
        _identity().alias("key"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x")).alias("initial"),
        F.when(told == "", "blank").when(F.substring(told, -1, 1).isin(*ENDS), "").otherwise("truncated").alias("fault"),
    )
    counted = written(narrow.groupBy("conv_id", "turn", "key", "initial", "fault").agg(F.count("*").alias("n")), "rows")
    # Only what stands in several turns has a later copy to mark.
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    repeated = (
        counted.where("fault <> 'blank'")
        .groupBy(F.col("conv_id").alias("of"), F.col("key").alias("same"))
        .agg(F.min(turn).alias("seen"), F.max(turn).alias("last"))
        .where("seen <> last")
        .select("of", "same", "seen")
    )
    found = counted.join(repeated, (counted.key == repeated.same) & counted.conv_id.eqNullSafe(repeated.of), "left")
    later = F.col("seen").isNotNull() & (turn > F.col("seen"))
    return found.select("conv_id", "turn", "key", "initial", F.when(later, "duplicate").otherwise(F.col("fault")).alias("fault"), "n")


def repairs(rows: DataFrame) -> DataFrame:
    """Per conversation: ``conv_id gaps blank duplicate truncated illegal cost audit``."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "key"]
    sorted_rows = faults(rows).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    chunks = written(sorted_rows.mapInArrow(_chunked, _CHUNK_DDL), "chunks")
    ways = chunks.drop("audits").repartition("conv_id").sortWithinPartitions("conv_id", "task", "number").mapInArrow(_ways, _WAY_DDL)
    audits = chunks.select(F.col("task").alias("in_task"), F.col("number").alias("at"), "audits")
    told = ways.join(audits, (F.col("task") == F.col("in_task")) & (F.col("number") == F.col("at")))
    part = F.struct("task", "number", F.get("audits", F.col("way").cast("int")).alias("audit"))
    sums = [F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated", "illegal", "cost")]
    gaps = F.max("last_turn") - F.min("least_turn") + 1 - F.sum("turns")
    by_conversation = told.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).alias("gaps"), *sums, F.sort_array(F.collect_list(part)).alias("parts"))
    audit = F.array_join(F.transform("parts", lambda p: p.audit), "")
    return by_conversation.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", audit.alias("audit"))


_REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's audit, then its rows in order, to its repaired rows."""
    conv = audit = None
    at = place = state = 0

    def inserted() -> Iterator[dict]:
        nonlocal at, place, state
        while audit is not None and at < len(audit) and audit[at] == INSERT:
            expected = EXPECTED[state]
            yield {"conv_id": conv, "place": place, "role": ROLE_OF[expected], "text": ""}
            at, place, state = at + 1, place + 1, NEXT[state][expected]

    for batch in batches:
        out: list[dict] = []
        for of, own, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")), strict=True):
            if own is not None:
                out += inserted()
                conv, audit, at, place, state = of, own, 0, 0, 0
                continue
            out += inserted()
            edit, at = audit[at], at + 1
            if edit == DELETE:
                continue
            initial = role[:1]
            if edit == REROLE:
                initial = EXPECTED[state]
                role = ROLE_OF[initial]
            out.append({"conv_id": conv, "place": place, "role": role, "text": text})
            place, state = place + 1, NEXT[state][initial]
        if out:
            yield pa.RecordBatch.from_pylist(out, _REPAIRED)
    left = list(inserted())
    if left:
        yield pa.RecordBatch.from_pylist(left, _REPAIRED)


def repaired(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """The rows after the edits: ``conv_id place role text``.

    The rows of a conversation lie in one partition, in order of ``place``.
    """
    none = F.lit(None)
    texts = rows.select("conv_id", F.lit(1).alias("kind"), "turn", _identity().alias("key"), none.cast("string").alias("audit"), "role", "text")
    audits = repairs.select(
        "conv_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("key"), "audit", none.cast("string").alias("role"), none.cast("string").alias("text")
    )
    together = audits.union(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "key")
    return together.mapInArrow(_repaired, "conv_id long, place long, role string, text string")


_DIGEST = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, conv = None, None
    for batch in batches:
        out: list[dict] = []
        for of, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")), strict=True):
            if place == 0:
                if digest is not None:
                    out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
                digest, conv = hashlib.sha256(), of
            digest.update(f"{'' if place == 0 else chr(10)}{role}:{text}".encode())
        if out:
            yield pa.RecordBatch.from_pylist(out, _DIGEST)
    if digest is not None:
        yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": digest.hexdigest()}], _DIGEST)


def digests(repaired_rows: DataFrame) -> DataFrame:
    """SHA-256 of ``role:text`` lines of what ``repaired`` returns, in its order."""
    return repaired_rows.mapInArrow(_digested, "conv_id long, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults, by a checksum of conversation and turn."""
    ids = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn"))
    kind = F.crc32(F.concat_ws(":", *ids).cast("binary")) % 20
    hurt = values(rows).withColumn("kind", kind).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return hurt.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repair_report(rows: DataFrame) -> DataFrame:
    """``repairs``, and the digest of the repaired rows."""
    rows = values(rows)
    found = written(repairs(rows), "repairs")
    made = digests(repaired(rows, found)).withColumnRenamed("conv_id", "of")
    told = found.join(made, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    return told.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)))


# CRC-32 of an ASCII text, bit by bit.
_CRC32_SQL = (
    "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({}, ''), lambda x: CAST(ord(x) AS BIGINT))), "
    "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), CAST(4294967295 AS BIGINT))"
)


def oracle(conversations: str = "conversations") -> str:
    """DuckDB text: for each row in turn, the least cost and audit of every state."""
    steps, ends = [], []
    for start in STATES:
        state, cost, audit, lines = start, 0, "", ""
        for _ in range(3):
            for row in (*"suaxSUAX", DELETE):
                for after, more, edit in _steps(row, state):
                    role = ROLE_OF[EXPECTED[state]] if edit == REROLE else ""
                    steps.append(f"({start}, '{row}', {after}, {cost + more}, '{audit + edit}', '{lines}', '{edit}', '{role}')")
            if state in COMPLETE:
                ends.append(f"({start}, {cost}, '{audit}', '{lines}')")
            lines += f"{ROLE_OF[EXPECTED[state]]}:|"
            state, cost, audit = NEXT[state][EXPECTED[state]], cost + INSERT_COST, audit + INSERT
    blank = " || ".join(f"chr({ord(c)})" for c in SPACE)
    lists = {name: ", ".join(f"'{value}'" for value in of) for name, of in (("ends", ENDS), ("legal", LEGAL))}
    return f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC32_SQL.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM {conversations}),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '{ENDS}', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM given WHERE kind <> 0),
told AS (
  SELECT *, substr(role, 1, 1) AS initial, rtrim(text, {blank}) AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS spot FROM damaged),
faulty AS (
  SELECT *, CASE WHEN said = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY spot) > 1 THEN 'duplicate'
    WHEN right(said, 1) NOT IN ({lists["ends"]}) THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY spot) || initial AS pair FROM told),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(CASE WHEN fault = 'blank' THEN 1 END) AS blank, count(CASE WHEN fault = 'duplicate' THEN 1 END) AS duplicate,
    count(CASE WHEN fault = 'truncated' THEN 1 END) AS truncated,
    count(CASE WHEN spot > 1 AND pair NOT IN ({lists["legal"]}) THEN 1 END) AS illegal FROM faulty GROUP BY conv_id),
coded AS (
  SELECT conv_id, spot, role, text, CASE WHEN fault IN ('blank', 'duplicate') THEN 'D' ELSE
    CASE WHEN fault = 'truncated' THEN upper(letter) ELSE letter END END AS code
  FROM (SELECT *, CASE WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'x' END AS letter FROM faulty)),
steps(state, code, after, cost, audit, lines, edit, role) AS (VALUES {", ".join(steps)}),
ends(state, cost, audit, lines) AS (VALUES {", ".join(ends)}),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS spot, 0 AS state, 0 AS cost, '' AS audit, '' AS lines FROM counts
  UNION ALL
  SELECT conv_id, spot, state, cost, audit, lines FROM (
    SELECT w.conv_id, c.spot, s.after AS state, w.cost + s.cost AS cost, w.audit || s.audit AS audit,
      w.lines || replace(s.lines, '|', chr(10)) || CASE s.edit WHEN 'D' THEN '' WHEN 'K' THEN c.role || ':' || c.text || chr(10)
        ELSE s.role || ':' || c.text || chr(10) END AS lines,
      row_number() OVER (PARTITION BY w.conv_id, s.after ORDER BY w.cost + s.cost, w.audit || s.audit) AS choice
    FROM walk w JOIN coded c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND c.spot = w.spot + 1
      JOIN steps s ON s.state = w.state AND s.code = c.code) WHERE choice = 1),
finished AS (
  SELECT w.conv_id, w.cost + e.cost AS cost, w.audit || e.audit AS audit, w.lines || replace(e.lines, '|', chr(10)) AS lines,
    row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + e.cost, w.audit || e.audit) AS choice
  FROM walk w JOIN counts c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.spot = c.n JOIN ends e ON e.state = w.state)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(left(lines, greatest(0, length(lines) - 1)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM {conversations}) i
  LEFT JOIN counts c ON i.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN (SELECT * FROM finished WHERE choice = 1) f ON i.conv_id IS NOT DISTINCT FROM f.conv_id"""


@registered("op11_conversation_repair", oracle())
def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    report = repair_report(damaged(rows)).withColumnRenamed("conv_id", "of")
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    counts = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256")]
    return ids.join(report, F.col("conv_id").eqNullSafe(F.col("of")), "left").select("conv_id", *counts, *texts)

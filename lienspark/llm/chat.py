"""Chat formatting checked by a grammar round trip.

A conversation is formatted as its turns one after the other, each an opening mark,
the text and a closing mark:

    system      <<SYS>>text<</SYS>>
    user        [INST]text[/INST]
    assistant   <s>text</s>
    any other   [ROLE]role[/ROLE]text[END]

``parsed`` reads this grammar from left to right. In a text, a backslash before a
mark or before another backslash stands for what follows it; any other backslash
is itself, and a mark that does not close the text is an error. A turn is first
rendered as it is and parsed again. If what comes back is not the turn, the
backslashes and marks of the text (then of the role, then of both) get a backslash
in front until it is. A turn's rendering ends where its closing mark is read, so
what holds for each turn by itself holds for the turns in a row, and every turn is
rendered where its row is read, whatever the length of its conversation.

``format_conversations`` returns the conversations in pieces of about
``PIECE_CHARS`` characters, cut between turns, with the spans of each piece that
count for the loss: the assistant's texts without their marks. ``read_back`` parses
pieces again. Both pass a conversation's rows on as they come and hold one piece of
it at a time; a digest over a whole conversation is made by one task, because
SHA-256 has to see its bytes in order.

Nulls and corner cases: a null role or text is an empty one; a role is compared as
it is, so ``Assistant`` is another role; turns without a number come first, and
turns of one number in the order of their rendering; repeated rows are repeated
turns; rows without a conversation's id are one conversation; an empty table gives
no pieces; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.llm.registry import read, registered

TEMPLATE = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]", "[END]")
LEARNED = "assistant"
MARKS = [*(mark for marks in TEMPLATE.values() for mark in marks), *OTHER]
PIECE_CHARS = 1 << 20

_MARK = "|".join(map(re.escape, MARKS))
_TOKEN = re.compile(rf"\\(\\|{_MARK})|({_MARK})")
_CONTROL = re.compile(rf"(\\|{_MARK})")
_ROLES = {marks[0]: role for role, marks in TEMPLATE.items()}

CONTROL_ID = -1
CONTROL_TEXT = "</s>[INST] ok [/INST]"


class Broken(ValueError):
    """A text that the grammar does not have."""


def _field(formatted: str, start: int, close: str) -> tuple[str, int, int]:
    """The unescaped text from ``start``, where it ends, and where its mark ends."""
    parts, done = [], start
    for token in _TOKEN.finditer(formatted, start):
        parts.append(formatted[done : token.start()])
        if token[2] == close:
            return "".join(parts), token.start(), token.end()
        if token[2]:
            raise Broken(f"{token[2]} at {token.start()}")
        parts.append(token[1])
        done = token.end()
    raise Broken(f"no {close} after {start}")


def parsed(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """Role and text of every turn, and the span of its escaped text."""
    at = 0
    while at < len(formatted):
        opening = _TOKEN.match(formatted, at)
        if opening is None or opening[2] not in (*_ROLES, OTHER[0]):
            raise Broken(f"no turn at {at}")
        at = opening.end()
        if opening[2] == OTHER[0]:
            role, _, at = _field(formatted, at, OTHER[1])
            close = OTHER[2]
        else:
            role = _ROLES[opening[2]]
            close = TEMPLATE[role][1]
        start = at
        text, end, at = _field(formatted, start, close)
        yield role, text, start, end


def unescaped(text: str) -> str:
    return _TOKEN.sub(lambda token: token[1] or token[2], text)


def _joined(role: str, text: str, of_role: str) -> str:
    if of_role in TEMPLATE:
        opening, close = TEMPLATE[of_role]
        return f"{opening}{text}{close}"
    return f"{OTHER[0]}{role}{OTHER[1]}{text}{OTHER[2]}"


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """A turn that parses to itself, and the span of its text."""
    escapes = [(value, _CONTROL.sub(r"\\\1", value)) for value in (role, text)]
    for role_try, text_try in product(*escapes):
        formatted = _joined(role_try, text_try, role)
        try:
            turns = list(parsed(formatted))
        except Broken:
            continue
        if [turn[:2] for turn in turns] == [(role, text)]:
            return formatted, *turns[0][2:]
    raise AssertionError("an escaped turn always parses to itself")


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roles, texts = (batch.column(name).to_pylist() for name in ("role", "text"))
        turns = [rendered(role, text) for role, text in zip(roles, texts, strict=True)]
        starts = [start if role == LEARNED else -1 for role, (_, start, _) in zip(roles, turns, strict=True)]
        columns = [batch.column("conv_id"), batch.column("turn"), pa.array([t[0] for t in turns], pa.string())]
        columns += [pa.array(starts, pa.int64()), pa.array([t[2] for t in turns], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "formatted", "start", "end"])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_PIECES = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("formatted", pa.string()), ("loss", _SPANS)])


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered turns to pieces. A piece ends with its conversation or when it is long enough."""
    held: list[str] = []
    spans: list[dict] = []
    chars = piece = 0
    current: tuple = ()

    def taken() -> dict:
        nonlocal held, spans, chars, piece
        out = {"conv_id": current[0], "piece": piece, "formatted": "".join(held), "loss": spans}
        held, spans, chars, piece = [], [], 0, piece + 1
        return out

    for batch in batches:
        out: list[dict] = []
        for conv, formatted, start, end in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "formatted", "start", "end")), strict=True):
            if current != (conv,) or chars >= PIECE_CHARS:
                if held:
                    out.append(taken())
                if current != (conv,):
                    current, piece = (conv,), 0
            if start >= 0:
                spans.append({"start": chars + start, "end": chars + end})
            held.append(formatted)
            chars += len(formatted)
        if out:
            yield pa.RecordBatch.from_pylist(out, _PIECES)
    if held:
        yield pa.RecordBatch.from_pylist([taken()], _PIECES)


def format_conversations(rows: DataFrame) -> DataFrame:
    """Per piece of a conversation: ``conv_id piece formatted loss``.

    The pieces of a conversation are numbered from 0 and lie in one partition, in
    order; joined they are the formatted conversation.
    """
    values = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("role", "text")),
    )
    turns = values.mapInArrow(_render, "conv_id long, turn long, formatted string, start long, end long")
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "formatted")
    return ordered.mapInArrow(_assemble, "conv_id long, piece long, formatted string, loss array<struct<start: long, end: long>>")


_READ = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


class _Reading:
    """What has been read of one conversation."""

    def __init__(self, conv: int | None):
        self.conv = conv
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans: list[dict]) -> None:
        for role, text, _, _ in parsed(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for span in spans:
            text = unescaped(formatted[span["start"] : span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.formatted_chars += len(formatted)

    def row(self) -> dict:
        return {
            "conv_id": self.conv,
            "n_turns": self.n_turns,
            "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.formatted_chars,
        }


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current: _Reading | None = None
    for batch in batches:
        out: list[dict] = []
        for conv, formatted, spans in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss")), strict=True):
            if current is None or current.conv != conv:
                if current is not None:
                    out.append(current.row())
                current = _Reading(conv)
            current.add(formatted, spans)
        if out:
            yield pa.RecordBatch.from_pylist(out, _READ)
    if current is not None:
        yield pa.RecordBatch.from_pylist([current.row()], _READ)


def read_back(pieces: DataFrame, in_order: bool = False) -> DataFrame:
    """Turns, and text under the loss spans, of every formatted conversation.

    ``in_order`` is for pieces as ``format_conversations`` returns them; pieces
    that were written in between are brought together again.
    """
    if not in_order:
        pieces = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return pieces.select("conv_id", "formatted", "loss").mapInArrow(_read, schema)


def with_control(rows: DataFrame) -> DataFrame:
    """The four columns of ``rows``, and a conversation whose texts are made of marks."""
    columns = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    control = rows.sparkSession.range(2).select(
        F.lit(CONTROL_ID).cast("long"), "id", F.expr("IF(id = 0, 'user', 'assistant')"), F.lit(CONTROL_TEXT)
    )
    return columns.union(control)


def oracle(conversations: str = "conversations") -> str:
    """DuckDB text for the read-back columns of a table."""
    conflict = rf"\\(\\|{_MARK})|{_MARK}|\\$"

    def escaped(name: str) -> str:
        return f"CASE WHEN regexp_matches({name}, '{conflict}') THEN regexp_replace({name}, '(\\\\|{_MARK})', '\\\\\\1', 'g') ELSE {name} END"

    known = " ".join(f"WHEN '{role}' THEN '{a}' || text_out || '{b}'" for role, (a, b) in TEMPLATE.items())
    order = "ORDER BY turn NULLS FIRST, formatted"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {conversations}
  UNION ALL SELECT {CONTROL_ID}, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT {CONTROL_ID}, 1, 'assistant', '{CONTROL_TEXT}'),
escaped AS (SELECT *, {escaped("role")} AS role_out, {escaped("text")} AS text_out FROM turns),
rendered AS (
  SELECT *, CASE role {known} ELSE '{OTHER[0]}' || role_out || '{OTHER[1]}' || text_out || '{OTHER[2]}' END AS formatted FROM escaped)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = '{LEARNED}' THEN length(text) ELSE 0 END), 0) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = '{LEARNED}' THEN text ELSE '' END, '' {order})) AS loss_sha256,
  CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM rendered GROUP BY conv_id"""


@registered("op13_chat_formatting", oracle())
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(format_conversations(with_control(read(spark, sf_dir, "conversations"))), in_order=True)

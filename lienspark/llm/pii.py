"""Personal data: candidate spans, scored by boosted trees, above plain patterns.

Base spans follow fixed patterns (email, ip, card, phone), leftmost and without
overlap within a kind. High-recall generators then propose further spans that may
overlap: addresses written with (at) and (dot), dotted and spaced numbers, long
mixed runs of letters and digits. Gradient-boosted trees score each candidate from
its format and context; candidates at or above a threshold calibrated on rows kept
out of the fit are taken, the likeliest first, unless they overlap a base span or
one taken before. Long mixed runs have the kind ``secret``.

The trees learn from at most ``TRAIN_ROWS`` candidates of the documents, chosen by
a hash. A candidate counts as personal data if it is a base span, or a run that
a word for a credential assigns; their variations (without the leading country
code, with a wrong check digit, with a part out of range) are learned with them.

Nulls and corner cases: a null text is empty; an empty text has no spans; a null
``doc_id`` is carried along; repeated rows get equal results; without candidates
to learn from only base spans are found. Positions are code points, the end
exclusive.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lienspark.llm.boosting import Boosted, boost
from lienspark.llm.io import written
from lienspark.llm.registry import read, registered
from lienspark.llm.text import runs, utf8

KINDS = ("email", "ip", "card", "phone", "secret")
TRAIN_ROWS = 20_000
PRECISION = 0.98
SEED = 11

# Fixed patterns of the base spans.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_WRITTEN = re.compile(
    r"[\w.+%-]{1,64}\s?(?:@|\(at\)|\[at\])\s?[\w-]{1,64}(?:\s?(?:\.|\(dot\)|\[dot\])\s?[\w-]{1,64}){1,8}", re.IGNORECASE
)
_DOTTED = re.compile(r"(?<![0-9.])[0-9]+(?:\.[0-9]+){2,7}")
_NUMBER = re.compile(r"\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){5,}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
_CREDENTIAL = re.compile(r"(?:token|key|secret|password|passwd|pwd|auth|credential)s?[\"']?\s*[=:]+\s*[\"']?$", re.IGNORECASE)
_CONTEXT = (
    re.compile(r"token|key|secret|passw|pwd|auth|credential", re.IGNORECASE),
    re.compile(r"tel|phone|call|fax|mobil", re.IGNORECASE),
    re.compile(r"card|visa|credit|payment", re.IGNORECASE),
    re.compile(r"mail|contact", re.IGNORECASE),
    re.compile(r"\bip\b|host|server|address", re.IGNORECASE),
)
GENERATORS = ("written", "dotted", "number", "run")
CANDIDATE = ["generator", "before", "span", "after", "label", "features"]
# Signs of a span that training keeps as text.
CUT = 256

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    """Whether the check digit of a number is right."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[Span]:
    spans, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            spans.append((start, done))
        at = text.find("@", max(at + 1, done))
    return spans


def _in_range(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of the fixed patterns, by kind."""
    return {
        "email": _emails(text),
        "ip": [m.span() for m in _IP.finditer(text) if all(map(_in_range, m[0].split(".")))],
        "card": [m.span() for m in _CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)],
        "phone": [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15] if "+" in text else [],
    }


def candidates(text: str) -> list[tuple[str, int, int]]:
    """What the generators propose: generator, start and end; spans may overlap."""
    found = []
    lowered = text.lower()
    if "@" in text or "(at)" in lowered or "[at]" in lowered:
        found += [("written", *m.span()) for m in _WRITTEN.finditer(text)]
    found += [("dotted", *m.span()) for m in _DOTTED.finditer(text)]
    found += [("number", *m.span()) for m in _NUMBER.finditer(text)]
    for m in _RUN.finditer(text):
        if any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0]):
            found.append(("run", *m.span()))
    return found


def _entropy(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def describe(generator: str, text: str, start: int, end: int) -> list[float]:
    """Format and context features of a candidate."""
    span, before, after = text[start:end], text[max(0, start - 32) : start], text[end : end + 2]
    digits = _digits(span)
    parts = re.split(r"[^0-9A-Za-z]+", span.strip("()+"))
    numbers = [int(p[:6]) for p in parts if p[:6].isdecimal() and p.isascii()]
    hexed = sum(c in "0123456789abcdefABCDEF" for c in span)
    return [
        *(float(generator == g) for g in GENERATORS),
        float(len(span)),
        float(len(digits)),
        float(sum(c.isalpha() for c in span)) / len(span),
        float(sum(c.isupper() for c in span)) / len(span),
        hexed / len(span),
        _entropy(span),
        float(len(parts)),
        float(len(parts[0])),
        float(len(parts[-1])),
        float(max(numbers, default=0)),
        float(bool(digits) and luhn(digits)),
        float(span.startswith("+")),
        float("@" in span),
        float("(" in span),
        float(before[-1:] in ("'", '"')),
        float(bool(re.search(r"[=:]\s?[\"']?$", before))),
        float(before[-1:].isalnum() or before[-1:] in ("-", "_", ".", "/")),
        float(after[:1].isalnum() or after[:1] in ("-", "_", "/")),
        *(float(bool(c.search(before))) for c in _CONTEXT),
    ]


def _kind(generator: str, span: str) -> str:
    if generator == "number":
        return "card" if len(_digits(span)) >= 13 else "phone"
    return {"written": "email", "dotted": "ip", "run": "secret"}[generator]


def _overlaps(span: Span, others: list[Span]) -> bool:
    return any(span[0] < end and start < span[1] for start, end in others)


@dataclass(frozen=True)
class Model:
    trees: Boosted
    threshold: float

    def spans(self, text: str, base: dict[str, list[Span]]) -> list[tuple[str, int, int]]:
        """Base spans and taken candidates, by kind as listed and then by start."""
        taken = [(k, *s) for k, spans in base.items() for s in spans]
        proposed = candidates(text)
        if proposed:
            held = [s for spans in base.values() for s in spans]
            free = [c for c in proposed if not _overlaps(c[1:], held)]
            if free:
                chances = self.trees.probabilities(np.array([describe(g, text, s, e) for g, s, e in free]))
                for chance, (g, s, e) in sorted(zip(chances.tolist(), free, strict=True), key=lambda x: (-x[0], x[1][1:], x[1][0])):
                    if chance >= self.threshold and not _overlaps((s, e), held):
                        held.append((s, e))
                        taken.append((_kind(g, text[s:e]), s, e))
        return sorted(taken, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def _worth_reading(run: pa.RecordBatch) -> np.ndarray:
    """Rows whose text has a digit, an at sign or a bracketed (at): others have no span."""
    data, offsets = utf8(run.column("text"))
    telling = ((data >= 0x30) & (data <= 0x39)) | (data == 0x40)
    if len(data) > 3:
        folded = data | np.uint8(0x20)
        opens = (data[:-3] == 0x28) | (data[:-3] == 0x5B)
        telling[:-3] |= opens & (folded[1:-2] == 0x61) & (folded[2:-1] == 0x74)
    count = np.concatenate(([0], np.cumsum(telling)))
    return np.flatnonzero(count[offsets[1:]] > count[offsets[:-1]])


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates with the label the patterns and the credential words give them.

    A long span is cut, with the features of the whole one beside it.
    """
    for batch in batches:
        for run in runs(batch):
            rows = {}
            texts = run.column("text")
            for r in _worth_reading(run).tolist():
                text = texts[r].as_py()
                sure = {s for spans in base_spans(text).values() for s in spans}
                for g, s, e in candidates(text):
                    before, after = text[max(0, s - 32) : s], text[e : e + 2]
                    label = (s, e) in sure or (g == "run" and bool(_CREDENTIAL.search(before)))
                    features = describe(g, before + text[s:e] + after, len(before), len(before) + e - s) if e - s > CUT else None
                    rows[g, before, text[s:e][:CUT], after, label, features and tuple(features)] = None
            if rows:
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                columns[5] = pa.array([key[5] for key in rows], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(columns, CANDIDATE)


def _variations(rows: list[tuple[str, str, str, str, bool]]) -> list[tuple[str, str, str, str, bool]]:
    """Rows made from the found ones: as likely and as unlikely forms of them."""
    rng, more = random.Random(SEED), []
    for generator, before, span, after, label in rows:
        if not label:
            continue
        if generator == "number" and span.startswith("+"):
            bare = re.sub(r"^\+[0-9]{1,3}[ .-]?", "", span)
            if len(_digits(bare)) >= 7 and bare[0] in "(0123456789" and not bare.isdecimal():
                more.append((generator, before, bare, after, True))
            more.append((generator, before, f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}", after, False))
        elif generator == "number":
            wrong = span[:-1] + str((int(span[-1]) + rng.randint(1, 9)) % 10)
            more.append((generator, before, wrong, after, False))
            more.append((generator, before, str(rng.randint(10**6, 10**12)), after, False))
        elif generator == "dotted":
            parts = span.split(".")
            parts[rng.randrange(len(parts))] = str(rng.randint(256, 999))
            more.append((generator, before, ".".join(parts), after, False))
            more.append((generator, before, ".".join(parts[:3]), after, False))
        elif generator == "written" and "@" in span:
            more.append((generator, before, span.replace("@", " (at) ").replace(".", " (dot) "), after, True))
        elif generator == "run":
            more.append((generator, "", "".join(rng.choice("aeiounrtslm") for _ in range(len(span))) + str(rng.randint(1, 99)), after, False))
            more.append((generator, before[:-12], span, after, True))
    return more


def drawn_candidates(docs: DataFrame, rows: int = TRAIN_ROWS) -> list[tuple]:
    """At most ``rows`` distinct candidates of all texts, chosen by a hash of what they are.

    Copies count once, whatever their number, before anything is counted or drawn.
    """
    schema = "generator string, before string, span string, after string, label boolean, features array<double>"
    found = docs.select("text").where("text IS NOT NULL").mapInArrow(_samples, schema).distinct()
    found = written(found, "candidates")
    draw = F.xxhash64(*CANDIDATE)
    # The hash leaves about twice the rows asked for, so that no task sorts more.
    share = min(1.0, 2 * rows / max(found.count(), 1))
    unit = F.shiftrightunsigned(draw, 11).cast("double") / 2.0**53
    return [tuple(r) for r in found.where(unit <= share).orderBy(draw, *CANDIDATE).limit(rows).collect()]


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Trees and threshold, from at most ``rows`` distinct candidates chosen by a hash."""
    drawn = sorted(drawn_candidates(docs, rows), key=lambda r: (r[:5], r[5] or []))
    made = _variations([r[:5] for r in drawn])
    if not drawn:
        return Model(boost(np.zeros((0, 1)), np.zeros(0)), 2.0)
    table = np.array(
        [
            features or describe(g, before + span + after, len(before), len(before) + len(span))
            for g, before, span, after, _, features in [*drawn, *((*row, None) for row in made)]
        ]
    )
    labels = np.array([row[4] for row in [*drawn, *made]], np.float64)
    kept_out = np.random.default_rng(SEED).random(len(labels)) < 0.25
    trees = boost(table[~kept_out], labels[~kept_out])
    return Model(trees, _threshold(trees.probabilities(table[kept_out]), labels[kept_out]))


def _threshold(chances: np.ndarray, labels: np.ndarray) -> float:
    """Lowest chance, from one half up, above which ``PRECISION`` of the rows are right."""
    order = np.argsort(-chances, kind="stable")
    right = np.cumsum(labels[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero((right >= PRECISION) & (chances[order] >= 0.5))
    return float(chances[order][good[-1]]) if len(good) else 0.9


def _hex(parts: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(_joined(parts).encode()).hexdigest()


def _joined(parts: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in parts)


def _found(model: Model):
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                counts = np.zeros((4, run.num_rows), np.int64)
                digests, spans = [_hex([])] * run.num_rows, [""] * run.num_rows
                texts = run.column("text")
                for r in _worth_reading(run).tolist():
                    text = texts[r].as_py()
                    base = base_spans(text)
                    counts[:, r] = [len(base[k]) for k in KINDS[:4]]
                    digests[r] = _hex([(k, *s) for k in KINDS[:4] for s in base[k]])
                    spans[r] = _joined(model.spans(text, base))
                yield pa.RecordBatch.from_arrays([run.column("doc_id"), *map(pa.array, counts), pa.array(digests), pa.array(spans)], names)

    return found


def find(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: base counts, the digest of the base spans, and all spans as text."""
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(_found(model), schema)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping ones, the first."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with every span masked; ``n_chars`` follows the text where it is there."""

    def redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch):
                changed = {}
                texts = run.column("text")
                for r in _worth_reading(run).tolist():
                    text = texts[r].as_py()
                    spans = model.spans(text, base_spans(text))
                    if spans:
                        changed[r] = masked(text, spans)
                if changed:
                    at = run.schema.get_field_index("text")
                    run = run.set_column(at, run.schema.field(at), pa.array([changed.get(r, texts[r].as_py()) for r in range(run.num_rows)], texts.type))
                yield run

    out = docs.mapInArrow(redacted, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out.select(*docs.columns)


@registered("op10_pii")
def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return find(docs, train(docs))

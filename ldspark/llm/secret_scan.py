"""Secrets in texts: patterns of known shapes, and literals that end up under a sensitive name.

Source and configuration lines are lexed into names and the literals or names they are given, constants are
propagated through later assignments and concatenations, and a literal is scored by the most sensitive name it
reaches and by how random it looks.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_text, text_of

KINDS = ("assign", "access", "hex", "named")
# The base patterns, over UTF-8 bytes.
_ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# Parts of names and how sensitive they are.
SENSITIVE = {
    "password": 1.0,
    "passwd": 1.0,
    "passphrase": 1.0,
    "pwd": 0.9,
    "secret": 1.0,
    "token": 0.9,
    "apikey": 1.0,
    "api_key": 1.0,
    "accesskey": 1.0,
    "access_key": 1.0,
    "privatekey": 1.0,
    "private_key": 1.0,
    "credential": 0.8,
    "auth": 0.6,
}
PLACEHOLDERS = ("changeme", "example", "placeholder", "redacted", "your", "xxxx", "todo", "none", "null", "true", "false")
LEAST_SCORE = 0.5
LEAST_LENGTH = 6

_NAME = rb"[A-Za-z_][A-Za-z0-9_.\-]*"
_STRING = rb"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'"
# name, an operator, and operands joined by +; each operand a quoted literal or a bare word
_STATEMENT = re.compile(
    rb"(?<![A-Za-z0-9_.\-])[\"']?(?P<name>" + _NAME + rb")[\"']?[ \t]*(?P<operator>:=|=>|\+=|[:=])[ \t]*(?P<value>(?:" + _STRING + rb"|[^\s\"',;{}()\[\]+#]+)"
    rb"(?:[ \t]*\+[ \t]*(?:" + _STRING + rb"|" + _NAME + rb"))*)"
)
_OPERAND = re.compile(_STRING + rb"|[^\s\"'+]+(?:\+[^\s\"'+]+)*")
_CANDIDATE = tuple(sorted({part.encode() for part in SENSITIVE}))


def sensitivity(name: str) -> float:
    """The weight of the most sensitive part of a name; zero without one."""
    flat = name.lower().replace("-", "_").replace(".", "_")
    joined = flat.replace("_", "")
    return max((w for part, w in SENSITIVE.items() if part in flat or part in joined), default=0.0)


def randomness(literal: str) -> float:
    """From 0 to 1: entropy of the characters against that of as many different ones, at most 16."""
    if len(literal) < LEAST_LENGTH or any(p in literal.lower() for p in PLACEHOLDERS):
        return 0.0
    if literal[:1] in "$<{" or re.fullmatch(r"[0-9.:/-]{1,10}|https?://\S*", literal):
        return 0.0
    n = len(literal)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    return min(1.0, entropy / math.log2(min(n, 16)))


def base_spans(raw: bytes) -> list[tuple[int, int, str]]:
    """Byte spans of the base patterns, leftmost and non-overlapping per kind."""
    found = []
    lower = raw.lower()
    if any(word in lower for word in _ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(raw) if len(m.group(2)) >= 6]
    if b"AKIA" in raw:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(raw)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(raw)]
    return found


class _Constant:
    """What a name was given: literals of its own and the constants it was put together from.

    A constant is looked into once per weight above those it was reached with, so chains of any length and names that
    use them any number of times cost no more than their statements.
    """

    __slots__ = ("spans", "parts", "weight")

    def __init__(self) -> None:
        self.spans: list[tuple[int, int]] = []
        self.parts: list[_Constant] = []
        self.weight = 0.0

    def reached(self, weight: float) -> Iterator[tuple[int, int]]:
        todo = [self]
        while todo:
            one = todo.pop()
            if one.weight < weight:
                one.weight = weight
                yield from one.spans
                todo += one.parts


def named_literals(raw: bytes) -> list[tuple[int, int, float]]:
    """Byte spans and scores of literals that reach a sensitive name.

    An operand that is a bare word naming an earlier constant stands for that constant's literals, as does the name
    itself before ``+=``; any other bare word is itself a literal, as in configuration files.
    """
    lower = raw.lower()
    if not (b"=" in raw or b":" in raw) or not any(part in lower for part in _CANDIDATE):
        return []
    constants: dict[str, _Constant] = {}
    best: dict[tuple[int, int], float] = {}
    for m in _STATEMENT.finditer(raw):
        name, begin = m.group("name").decode(), m.start("value")
        made = _Constant()
        if m.group("operator") == b"+=" and name in constants:
            made.parts.append(constants[name])
        for operand in _OPERAND.finditer(m.group("value")):
            text = operand.group()
            start, end = begin + operand.start(), begin + operand.end()
            if text[:1] in b"\"'" and len(text) > 1:
                made.spans.append((start + 1, end - 1))
            elif (known := constants.get(text.decode(errors="replace"))) is not None:
                made.parts.append(known)
            else:
                made.spans.append((start, end))
        constants[name] = made
        weight = sensitivity(name)
        if weight:
            for span in made.reached(weight):
                score = weight * randomness(raw[slice(*span)].decode(errors="replace"))
                if score >= LEAST_SCORE:
                    best[span] = max(score, best.get(span, 0.0))
    return [(*span, score) for span, score in best.items()]


def _code_points(raw: bytes, spans: list[tuple]) -> dict[int, int]:
    """Code point offset of every byte offset that a span uses, in one walk over the text."""
    offsets, at, points = {}, 0, 0
    for byte in sorted({x for s in spans for x in s[:2]}):
        points += len(raw[at:byte].decode())
        offsets[byte], at = points, byte
    return offsets


def scan(text: str) -> tuple[int, int, int, str, str, float]:
    raw = text.encode()
    base = base_spans(raw)
    named = named_literals(raw)
    spans = base + [(a, b, "named") for a, b, _ in named]
    where = _code_points(raw, spans)
    rank = {kind: i for i, kind in enumerate(KINDS)}

    def told(some: list[tuple[int, int, str]]) -> str:
        return ",".join(f"{k}:{where[a]}:{where[b]}" for a, b, k in sorted(some, key=lambda s: (s[0], rank[s[2]], s[1])))

    kinds = Counter(k for *_, k in base)
    return (
        kinds["assign"],
        kinds["access"],
        kinds["hex"],
        hashlib.sha256(told(base).encode()).hexdigest(),
        told(spans),
        max((score for *_, score in named), default=0.0),
    )


RESULT = {"n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(), "base_sha256": pa.string(), "spans": pa.string(), "named_score": pa.float64()}


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, counts of the base kinds, ``base_sha256``, ``spans`` and ``named_score``, one row per row.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind; base spans are whole
    matches, those of kind ``named`` are the literal without its quotes. A map without a shuffle. Null text counts
    as empty: no spans, and the digest of the empty string. An empty table gives no rows; rows and identifiers may
    repeat; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = {pa.int64(): "bigint", pa.string(): "string", pa.float64(): "double"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(t) for t in batch.column("text").to_pylist()]
            columns = list(zip(*rows)) if rows else [[]] * len(RESULT)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(c, t) for c, t in zip(columns, RESULT.values())]], names=["id", *RESULT]
            )

    schema = f"id {kind}, " + ", ".join(f"{n} {names[t]}" for n, t in RESULT.items())
    return map_text(docs, {"id": F.col(id_col), "text": text_of(text_col)}, run, schema)

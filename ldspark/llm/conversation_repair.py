"""Repair of the structure of conversations by the cheapest edits.

Rows are dealt by conversation and sorted by turn, and Python reads them as a stream: the state of a dynamic
program is carried from batch to batch, and each row leaves one small number to walk back by. A conversation of any
length is a bounded state, four bytes a row, and its messages once, both in a temporary file beyond a few megabytes.

A repaired conversation has messages whose roles' initials are ``(s?(ua)+)?``. Its edits, one letter each: K keeps a
row, R gives it the role user or assistant, D deletes it, I inserts an empty message of either role.
"""

from __future__ import annotations

import hashlib
import struct
import sys
from array import array
from collections.abc import Callable, Iterator
from tempfile import SpooledTemporaryFile

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import quoted, ready

BLANKS = " \t\n\x0b\x0c\r"
ENDINGS = (".", "!", "?")
REROLE, DELETE, INSERT, UNREPAIRED = 3, 4, 3, 3
SPILL_BYTES = 8 << 20
ROWS_PER_BATCH = 4096
MOST = (1 << 63) - 1

# States: nothing yet, after s, after u, after a. The role a state asks for next, and where that leads.
_NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_TOKENS = [letters + edit for letters in ("", "I", "II") for edit in "DKR"]
_CODE = {token: code for code, token in enumerate(_TOKENS)}
_END_INSERTS = {0: 0, 1: 2, 2: 1, 3: 0}

State = tuple  # per state a pair of cost above the least and rank of its edits so far, or None
START: State = ((0, 0), None, None, None)


class Automaton:
    """The dynamic program, a step of it kept per state and kind of row.

    A state's value is the cost of its cheapest edits so far and their place in ASCII order among the states' edits.
    Edits up to a row end in that row's letter and hold as many such letters as rows, so none is the beginning of
    another and their order stays whatever follows. Costs are told above the least one, and a state that another one
    beats in all that can follow is left out, so the values that occur are few.
    """

    def __init__(self) -> None:
        self.back: list[list] = []
        self._steps: dict[tuple, tuple[State, int, int]] = {}

    def step(self, state: State, row: tuple[str, bool, bool]) -> tuple[State, int, int]:
        """The state after a row of an initial, to be deleted or not, truncated or not; what the least cost grew by;
        the number of the step in ``back``."""
        known = self._steps.get((state, row))
        if known is None:
            known = self._steps[state, row] = self._made(state, row)
        return known

    def _made(self, state: State, row: tuple[str, bool, bool]) -> tuple[State, int, int]:
        initial, deleted, truncated = row
        best: dict[int, tuple[int, int, str, int]] = {}

        def offer(after: int, cost: int, rank: int, token: str, before: int) -> None:
            if after not in best or (cost, rank, token) < best[after][:3]:
                best[after] = (cost, rank, token, before)

        for before, value in enumerate(state):
            if value is None:
                continue
            cost, rank = value
            at = before
            for letters in ("", "I", "II"):
                if letters:
                    at, cost = _NEXT[at][1], cost + INSERT
                offer(at, cost + DELETE, rank, letters + "D", before)
                if not deleted:
                    more = cost + (UNREPAIRED if truncated else 0)
                    offer(_NEXT[at][1], more + REROLE, rank, letters + "R", before)
                    if (at, initial) in _KEPT:
                        offer(_KEPT[at, initial], more, rank, letters + "K", before)
        # after s and after a the same may follow; nothing yet is at most one deletion of an s better than after a
        if 3 in best:
            for other, margin in ((1, 0), (0, DELETE)):
                if other in best and best[other][0] > best[3][0] + margin:
                    del best[other]
        least = min(value[0] for value in best.values())
        order = sorted(best, key=lambda s: best[s][1:3])
        after = tuple((best[s][0] - least, order.index(s)) if s in best else None for s in range(4))
        self.back.append([(best[s][3], _CODE[best[s][2]]) if s in best else None for s in range(4)])
        return after, least, len(self.back) - 1

    @staticmethod
    def end(state: State) -> tuple[int, int]:
        """The state that the cheapest edits end in before the last insertions, and what its cost is above the least."""
        ways = [(value[0] + INSERT * _END_INSERTS[s], value[1], s) for s, value in enumerate(state) if value is not None]
        above, _, last = min(ways)
        return last, above


class Conversation:
    """One conversation in the order of its rows; ``add`` each, then read ``edits`` and ``report``."""

    def __init__(self, key: str | None, automaton: Automaton, spill_bytes: int = SPILL_BYTES) -> None:
        self.key, self.automaton = key, automaton
        self.state, self.cost, self.rows = START, 0, 0
        self.steps, self.messages = SpooledTemporaryFile(spill_bytes), SpooledTemporaryFile(spill_bytes)
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.initial: str | None = None
        self.first_turn = self.last_turn = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, copy: bool) -> None:
        if turn is not None and (self.last_turn is None or turn != self.last_turn):
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        initial, told = role[:1], text.rstrip(BLANKS)
        fault = "blank" if not told else "duplicate" if copy else "truncated" if not told.endswith(ENDINGS) else None
        if fault:
            self.counts[fault] += 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.initial = initial
        kind = (initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated")
        self.state, grown, step = self.automaton.step(self.state, kind)
        self.cost += grown
        self.rows += 1
        self.steps.write(struct.pack("<I", step))
        r, t = role.encode(), text.encode()
        self.messages.write(struct.pack("<II", len(r), len(t)) + r + t)

    def _walk_back(self) -> tuple[int, int]:
        """Overwrite each row's step by the code of its edits, from the last to the first."""
        state, above = self.automaton.end(self.state)
        last, at, back = state, self.rows, self.automaton.back
        while at:
            start = max(0, at - 65536)
            self.steps.seek(4 * start)
            codes = array("I", self.steps.read(4 * (at - start)))
            if sys.byteorder == "big":
                codes.byteswap()
            for i in range(len(codes) - 1, -1, -1):
                state, codes[i] = back[codes[i]][state]
            if sys.byteorder == "big":
                codes.byteswap()
            self.steps.seek(4 * start)
            self.steps.write(codes.tobytes())
            at = start
        return last, above

    def edits(self) -> Iterator[tuple[str, str, str]]:
        """``edit, role, text`` in order; a deleted row has its own role and text."""
        last, above = self._walk_back()
        self.cost += above
        state = 0
        self.steps.seek(0)
        self.messages.seek(0)
        for _ in range(self.rows):
            token = _TOKENS[struct.unpack("<I", self.steps.read(4))[0]]
            r, t = struct.unpack("<II", self.messages.read(8))
            role, text = self.messages.read(r).decode(), self.messages.read(t).decode()
            for _ in token[:-1]:
                name, state = _NEXT[state]
                yield "I", name, ""
            if token[-1] == "K":
                state = _KEPT[state, role[:1]]
            elif token[-1] == "R":
                role, state = _NEXT[state]
            yield token[-1], role, text
        for _ in range(_END_INSERTS[last]):
            name, state = _NEXT[state]
            yield "I", name, ""

    @property
    def gaps(self) -> int:
        if self.first_turn is None:
            return 0
        return min(self.last_turn - self.first_turn + 1 - self.turns, MOST)

    def close(self) -> None:
        self.steps.close()
        self.messages.close()


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
MESSAGE = "place bigint, edit string, role string, text string"
_NAMES = {schema: [field.split()[0] for field in schema.split(", ")] for schema in (REPORT, MESSAGE)}


def _report(conversation: Conversation) -> Iterator[tuple]:
    audit, digest, started = bytearray(), hashlib.sha256(), False
    for edit, role, text in conversation.edits():
        audit += edit.encode()
        if edit != "D":
            digest.update((("\n" if started else "") + f"{role}:{text}").encode())
            started = True
    counts = conversation.counts
    yield conversation.key, conversation.gaps, *counts.values(), conversation.cost, audit.decode(), digest.hexdigest()


def _messages(conversation: Conversation) -> Iterator[tuple]:
    for place, (edit, role, text) in enumerate(conversation.edits()):
        yield conversation.key, place, edit, role, text


def _streamed(batches: Iterator[pd.DataFrame], made: Callable, names: list[str], spill_bytes: int) -> Iterator[pd.DataFrame]:
    automaton = Automaton()
    current: Conversation | None = None
    out: list[tuple] = []

    def frame() -> pd.DataFrame:
        rows = out[:]
        out.clear()
        return pd.DataFrame(rows, columns=["conversation", *names])

    def ended(conversation: Conversation) -> Iterator[pd.DataFrame]:
        size = 0
        for row in made(conversation):
            out.append(row)
            size += len(row[-1])
            if len(out) >= ROWS_PER_BATCH or size >= spill_bytes:
                size = 0
                yield frame()
        conversation.close()

    for batch in batches:
        columns = [batch[c].tolist() for c in ("conversation", "gone", "has_turn", "turn", "role", "text", "copy")]
        for key, gone, has_turn, turn, role, text, copy in zip(*columns):
            key = key if isinstance(key, str) else None  # pandas may write a null as not a number
            if current is None or key != current.key:
                if current is not None:
                    yield from ended(current)
                current = Conversation(key, automaton, spill_bytes)
            if not gone:
                current.add(turn if has_turn else None, role, text, copy)
    if current is not None:
        yield from ended(current)
    if out:
        yield frame()


def _dealt(
    rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, gone: Column
) -> DataFrame:
    """Rows by conversation and turn, each told whether its role and text were there before; one shuffle."""
    plain = rows.select(
        F.col(quoted(conv_col)).cast("string").alias("conversation"),
        gone.alias("gone"),
        F.col(quoted(turn_col)).isNotNull().alias("has_turn"),
        F.coalesce(F.col(quoted(turn_col)).cast("long"), F.lit(0)).alias("turn"),
        F.when(gone, "").otherwise(F.coalesce(F.col(quoted(role_col)), F.lit(" "))).alias("role"),
        F.when(gone, "").otherwise(F.coalesce(F.col(quoted(text_col)), F.lit(" "))).alias("text"),
    )
    same = Window.partitionBy("conversation", "gone", "role", "text").orderBy("has_turn", "turn")
    return (
        plain.repartition("conversation")
        .withColumn("copy", F.row_number().over(same) > 1)
        .sortWithinPartitions("conversation", "has_turn", "turn", "role", "text", "copy")
    )


def _run(rows: DataFrame, made: Callable, schema: str, conv_col, turn_col, role_col, text_col, gone, spill_bytes) -> DataFrame:
    ready(rows.sparkSession)
    dealt = _dealt(rows, conv_col, turn_col, role_col, text_col, F.lit(False) if gone is None else gone)
    names = _NAMES[schema]
    stream = dealt.mapInPandas(
        lambda batches: _streamed(batches, made, names, spill_bytes), f"conversation string, {schema}"
    )
    key = F.col("conversation").cast(rows.schema[conv_col].dataType).alias(conv_col)
    return stream.select(key, *names)


def audit_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    gone: Column | None = None,
    spill_bytes: int = SPILL_BYTES,
) -> DataFrame:
    """One row per conversation: its identifier, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost``, ``audit``, ``repaired_sha256``.

    * Rows are taken by turn, null turns first; equal turns by role and text, so the result is the same however the
      rows arrive. Rows without a conversation are one conversation of their own. A null role or text is one space.
    * A row's first fault counts: blank, duplicate (role and text of an earlier row), truncated (the last character
      that is no white space ends no sentence). ``illegal`` counts neighbours whose roles' initials are not su, ua
      or au, ``gaps`` the turns missing between the first and the last.
    * ``audit`` has the letters of the cheapest edits, the least in ASCII order where several are; blank and duplicate
      rows are deleted, and a truncated row that stays costs 3 more. ``repaired_sha256`` is the digest of the repaired
      ``role:text`` lines.
    * Rows marked ``gone`` only name their conversation, which is in the result if it has no other rows too: zeros,
      an empty audit and the digest of the empty text. An empty table gives no rows; other columns are not read.
    * One conversation is one task's stream, as its digest is over its whole text in order; what the task holds is
      bounded by ``spill_bytes``, whatever the conversation's length.
    """
    return _run(rows, _report, REPORT, conv_col, turn_col, role_col, text_col, gone, spill_bytes)


def repair_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    gone: Column | None = None,
    spill_bytes: int = SPILL_BYTES,
) -> DataFrame:
    """The edits of :func:`audit_conversations` as rows: the conversation, ``place``, ``edit``, ``role``, ``text``.

    The repaired conversation is the rows whose edit is not D, by place; those of edit D are the rows left out.
    """
    return _run(rows, _messages, MESSAGE, conv_col, turn_col, role_col, text_col, gone, spill_bytes)


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Conversations with faults put in by a hash of identifier and turn, and ``gone`` for the rows taken out.

    Of 20 remainders, 0 takes the row out, 1 empties its text, 2 removes the ends of its sentences, 3 repeats it,
    4 makes it the user's. Nulls count as one space.
    """
    key = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col)]
    kind = F.crc32(F.concat(key[0], F.lit(":"), key[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    marked = rows.select(
        conv_col,
        turn_col,
        kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
    )
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.withColumn("copy", F.explode(times)).select(
        conv_col, turn_col, "role", "text", (F.col("kind") == 0).alias("gone")
    )

import functools
import hashlib
import os
import random
import sys
import zlib

import duckdb
import pytest

from ldspark.llm import conversation_repair as r
from ldspark.llm.queries import ORACLE

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_check import compare  # noqa: E402

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        told = text.rstrip(r.BLANKS)
        out.append(
            "blank" if not told else "duplicate" if (role, text) in seen else "" if told[-1] in ".!?" else "truncated"
        )
        seen.add((role, text))
    return out


def cheapest(rows):
    """Cost and edits by trying every edit at every row, from the front."""
    kinds = faults(rows)

    @functools.lru_cache(None)
    def best(i, state, inserted):
        ways = [(0, "")] if i == len(rows) and state in (0, 3) else []

        def go(price, letter, j, after, more=0):
            cost, letters = best(j, after, more)
            ways.append((price + cost, letter + letters))

        if inserted < 3:
            for role in "ua":
                if role in NEXT[state]:
                    go(3, "I", i, NEXT[state][role], inserted + 1)
        if i < len(rows):
            go(4, "D", i + 1, state)
            if kinds[i] not in ("blank", "duplicate"):
                more = 3 if kinds[i] == "truncated" else 0
                for role in "ua":
                    if role in NEXT[state]:
                        go(3 + more, "R", i + 1, NEXT[state][role])
                if rows[i][0][:1] in NEXT[state]:
                    go(more, "K", i + 1, NEXT[state][rows[i][0][:1]])
        return min(ways, default=(10**9, ""))

    return best(0, 0, 0)


def repaired(rows, audit):
    out, state, left = [], 0, iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(left)
        if letter == "D":
            continue
        if letter != "K":
            role = NAMES["a" if state == 2 else "u"]
        state = NEXT[state][role[:1]]
        out.append((role, text))
    return out


def damaged(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            yield conv, turn, role, text


def expected(rows):
    out = {}
    after = list(damaged(rows))
    for conv in {row[0] for row in rows}:
        own = sorted((x for x in after if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2], x[3]))
        turns = [x[1] for x in own if x[1] is not None]
        messages = [x[2:] for x in own]
        kinds = faults(messages)
        cost, audit = cheapest(tuple(messages))
        lines = "\n".join(f"{a}:{b}" for a, b in repaired(messages, audit))
        out[conv] = (
            conv,
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(messages, messages[1:])),
            cost,
            audit,
            hashlib.sha256(lines.encode()).hexdigest(),
        )
    return out


def made(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["system" if turn == 0 else "user", "user", "assistant", "assistant", "tool"])
            text = rng.choice(["Yes.", "No!", "what", f"said {rng.random()}?", " \t", "Line.\n", "Ä end.", "no end"])
            rows.append((conv, turn + (rng.random() < 0.1), role, text))
    rows += [(None, 1, "user", "Nobody's."), (None, None, None, None), (500, None, "user", None), (500, 3, "", "x."), (501, 1, "user", "")]
    rows += [(502, 5, "user", "Same.")] * 4 + [(503, 0, "user", "y" * 200_000 + "."), (503, 9, "assistant", "z.")]
    return rows + rows[:7]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_trying_every_edit(spark, seed):
    rows = made(seed)
    random.Random(seed).shuffle(rows)
    frame = spark.createDataFrame([(*x, "c", True, 1, "a") for x in rows], SCHEMA + ", copy STRING, gone BOOLEAN, place INT, audit STRING")
    found = r.audit_conversations(r.damage(frame.repartition(3)), gone=r.F.col("gone")).collect()
    assert {x.conv_id: tuple(x) for x in found} == expected(rows)
    assert len(found) == len({x[0] for x in rows})


def test_messages_are_those_of_the_digest(spark):
    damaged_rows = r.damage(spark.createDataFrame(made(3), SCHEMA))
    reports = {x.conv_id: x for x in r.audit_conversations(damaged_rows, gone=r.F.col("gone")).collect()}
    messages = {}
    for x in r.repair_conversations(damaged_rows, gone=r.F.col("gone")).collect():
        messages.setdefault(x.conv_id, []).append(x)
    for conv, report in reports.items():
        own = sorted(messages.get(conv, []), key=lambda x: x.place)
        assert "".join(x.edit for x in own) == report.audit
        lines = "\n".join(f"{x.role}:{x.text}" for x in own if x.edit != "D")
        assert hashlib.sha256(lines.encode()).hexdigest() == report.repaired_sha256


def test_giant_conversation_spills_and_stays_the_same(spark):
    """One conversation of many rows, held in files from the first hundred bytes on."""
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice([f"said {t}.", f"cut {t}", ""])) for t in range(20_000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    (spilled,) = r.audit_conversations(frame, spill_bytes=100).collect()
    (held,) = r.audit_conversations(frame).collect()
    assert spilled == held and len(held.audit) >= 20_000
    state = 0
    for role, _ in repaired([x[2:] for x in rows], held.audit):
        assert role[:1] in ("u", "a")
        state += 1
    assert state % 2 == 0


def test_values_stay_few():
    """However long a conversation, the dynamic program meets a bounded number of states."""
    automaton, rng = r.Automaton(), random.Random(6)
    sizes = []
    for _ in range(2):
        conversation = r.Conversation("x", automaton)
        for turn in range(20_000):
            conversation.add(turn, rng.choice(["system", "user", "assistant", "x"]), rng.choice(["a.", "b", ""]), rng.random() < 0.2)
        sizes.append(len(automaton.back))
    assert sizes[1] < 2_000 and sizes[1] - sizes[0] < 50


def test_no_rows_and_no_turns(spark):
    assert r.audit_conversations(r.damage(spark.createDataFrame([], SCHEMA)), gone=r.F.col("gone")).collect() == []
    (lone,) = r.audit_conversations(spark.createDataFrame([(1, None, "user", "Hi.")], SCHEMA)).collect()
    assert (lone.gaps, lone.cost, lone.audit) == (0, 3, "KI")
    (wide,) = r.audit_conversations(
        spark.createDataFrame([(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b.")], SCHEMA)
    ).collect()
    assert wide.gaps == 2**63 - 1 and wide.audit == "KK"


def test_equals_sql(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.createDataFrame(made(4), SCHEMA).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")

    def query(session, _):
        return r.audit_conversations(r.damage(session.read.parquet(path)), gone=r.F.col("gone"))

    assert compare(spark, con, "op11", query, ORACLE["op11_conversation_repair"], path) is None

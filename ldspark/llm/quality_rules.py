"""Quality rules as a bitmask ledger.

One pass measures every text. Each rule is evaluated once over the measurements and leaves one bit. Policies are
versions of a bit mask over the stored ledger, so a new policy, and what each rule adds to it, needs no text.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import ready, text_of, unpack, whole_row

MEASURES = {
    "n_words": "words",
    "word_chars": "code points within words",
    "n_symbols": "characters of #*$%&|<>",
    "n_lines": "lines with a word",
    "n_dup_lines": "lines with a word that equal an earlier line",
    "n_repeat_words": "words inside three-word windows that the text holds twice or more",
    "n_distinct_words": "distinct words",
    "n_stops": "words that end in . , ; : ! or ?",
    "n_lettered": "words with a letter",
}
_LETTERS = bytes(b for b in range(256) if chr(b).isascii() and chr(b).isalpha() or b >= 128)
_NOT_LETTERS = bytes(b for b in range(256) if b not in _LETTERS)


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    found = Counter(windows)
    repeated = 0
    if len(found) < len(windows):
        marked = bytearray(n)
        for i, window in enumerate(windows):
            if found[window] > 1:
                marked[i : i + 3] = b"\1\1\1"
        repeated = sum(marked)
    distinct = set(words)
    times = Counter(words) if len(distinct) < n else dict.fromkeys(words, 1)
    return (
        n,
        len(b"".join(words).decode()),
        sum(raw.count(c) for c in b"#*$%&|<>"),
        len(lines),
        len(lines) - len(set(lines)),
        repeated,
        len(distinct),
        sum(c for w, c in times.items() if w[-1] in b".,;:!?"),
        sum(c for w, c in times.items() if w.translate(None, _NOT_LETTERS)),
    )


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for a document that breaks the rule; it never gives null."""

    bit: int
    name: str
    fails: Column


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


def _share(part: str, percent: float, whole: str) -> tuple[Column, Column]:
    return F.col(part) * 100, F.col(whole) * percent


def default_rules() -> list[Rule]:
    """Bits are never used for another rule; a changed rule takes a new bit."""
    n = F.col("n_words")
    some = n > 0

    def over(part, percent, whole="n_words"):
        left, right = _share(part, percent, whole)
        return left > right

    def under(part, percent, whole="n_words"):
        left, right = _share(part, percent, whole)
        return left < right

    return [
        Rule(0, "few_words", n < 50),
        Rule(1, "repeated_windows", over("n_repeat_words", 50)),
        Rule(2, "symbols", over("n_symbols", 10)),
        Rule(3, "repeated_lines", over("n_dup_lines", 40, "n_lines")),
        Rule(4, "word_length", some & (under("word_chars", 300) | over("word_chars", 1000))),
        Rule(5, "few_stops", some & under("n_stops", 2)),
        Rule(6, "few_distinct_words", some & under("n_distinct_words", 5)),
        Rule(7, "few_letters", some & under("n_lettered", 70)),
    ]


POLICIES = (
    Policy("base-1", ("few_words", "repeated_windows")),
    Policy("strict-1", ("few_words", "repeated_windows", "symbols", "repeated_lines", "word_length", "few_stops", "few_distinct_words", "few_letters")),
)


def _measured(texts: pa.Array) -> pa.Array:
    columns = list(zip(*[measure(t) for t in texts.to_pylist()])) or [[]] * len(MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(MEASURES))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """``row`` (all columns of the input), ``id``, the measurements and ``failed``, a long with the bit of every
    broken rule. One row per row.

    A map without a shuffle: a text is in memory once. Null text counts as empty and breaks the rule of few
    words; an empty table gives no rows; repeated rows and identifiers are judged each; other columns are carried.
    """
    ready(docs.sparkSession)
    measured = F.arrow_udf(_measured, "struct<" + ", ".join(f"{m}: bigint" for m in MEASURES) + ">")
    bits = F.lit(0).cast("long")
    for rule in rules or default_rules():
        bits = bits.bitwiseOR(F.when(rule.fails, F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return (
        docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("id"), measured(text_of(text_col)).alias("m"))
        .select("row", "id", "m.*")
        .withColumn("failed", bits)
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """The rows of :func:`judged` without the document: what is stored, and what policies and ablations read."""
    return judged(docs, id_col, text_col, rules).drop("row")


def drop_failing(docs: DataFrame, policy: Policy, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that break no rule of the policy, with their columns."""
    return unpack(judged(docs, id_col, text_col).where(passes(policy)), "row", docs.columns)


def policy_mask(policy: Policy, rules: list[Rule] | None = None) -> int:
    bits = {r.name: 1 << r.bit for r in rules or default_rules()}
    return sum(bits[name] for name in dict.fromkeys(policy.rules))


def passes(policy: Policy, rules: list[Rule] | None = None) -> Column:
    """True for ledger rows that break no rule of the policy."""
    return F.col("failed").bitwiseAND(F.lit(policy_mask(policy, rules))) == 0


def ablations(ledger_rows: DataFrame, policies: tuple[Policy, ...] = POLICIES, rules: list[Rule] | None = None) -> DataFrame:
    """For every policy and each of its rules: ``version``, ``rule``, ``kept`` (documents the policy keeps),
    ``broken`` (documents that break the rule), ``kept_without`` (documents kept if the rule were not there).

    The ledger is first counted by its bits, at most two to the number of rules, so only that small table meets
    the policies.
    """
    rules = rules or default_rules()
    counts = ledger_rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    names = {r.name: 1 << r.bit for r in rules}
    masks = [
        F.struct(F.lit(p.version).alias("version"), F.lit(name).alias("rule"), F.lit(policy_mask(p, rules)).alias("mask"), F.lit(names[name]).alias("bit"))
        for p in policies
        for name in dict.fromkeys(p.rules)
    ]
    each = counts.select("failed", "n", F.explode(F.array(*masks)).alias("m")).select("failed", "n", "m.*")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    failed, mask, bit = F.col("failed"), F.col("mask"), F.col("bit")
    return each.groupBy("version", "rule").agg(
        total(failed.bitwiseAND(mask) == 0).alias("kept"),
        total(failed.bitwiseAND(bit) != 0).alias("broken"),
        total(failed.bitwiseAND(mask.bitwiseAND(F.bitwise_not(bit))) == 0).alias("kept_without"),
    )

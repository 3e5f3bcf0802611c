"""Licences in texts, by a positional index of rare licence words.

The rarest words of each template are posted with their positions. All of them that a file has are looked up; a
posting votes for the place where its template would start, and places with the votes of enough words are verified
word by word and by the template's key phrases.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_text, text_of

_BLANK = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, letters and non-ASCII characters."""
    return text.encode().lower().translate(_BLANK).split()


@dataclass(frozen=True)
class Template:
    """``labels`` hold where the words of ``text`` stand in about their order and all ``keys`` stand within."""

    labels: tuple[str, ...]
    text: str
    keys: tuple[str, ...]


# The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Public licence notices.
TEMPLATES = (
    Template(("mit",), "Released under the MIT License", ("mit license",)),
    Template(
        ("mit",),
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software",
        ("permission is hereby granted free of charge", "sublicense"),
    ),
    Template(("apache", "apache-2.0"), "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template(
        ("apache",),
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
        ("as is basis without warranties or conditions",),
    ),
    Template(
        ("gpl", "gpl-3.0"),
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        ("gpl",),
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version",
        ("gnu general public license as published by the free software foundation",),
    ),
    Template(
        ("bsd",),
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(("cc-by-nc-4.0",), "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
)
POSTED = 5
COVERAGE = 0.8
SLACK = 3
PHRASE_SCORE = 0.5


class Index:
    """Postings of the templates' words, and their inverse document frequencies."""

    def __init__(self, templates: tuple[Template, ...], frequencies: dict[bytes, int] | None = None, n_docs: int = 0):
        self.templates = templates
        self.words = [words_of(t.text) for t in templates]
        self.keys = [[words_of(k) for k in t.keys] for t in templates]
        self.vocabulary = {word for words in self.words for word in words}
        frequencies = frequencies or {}
        self.idf = {w: math.log((n_docs + 1) / (frequencies.get(w, 0) + 1)) for w in self.vocabulary}
        # Only a template's rarest words are posted, and a place needs most of them.
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.needed = []
        for t, words in enumerate(self.words):
            rare = set(sorted(set(words), key=lambda w: (-self.idf[w], w))[:POSTED])
            self.needed.append((len(rare) + 1) // 2)
            for q, word in enumerate(words):
                if word in rare:
                    self.postings[word].append((t, q))

    def matches(self, words: list[bytes]) -> dict[int, tuple[float, int]]:
        """Of every template that is verified somewhere: its best coverage and where it starts."""
        places: dict[bytes, list[int]] = defaultdict(list)
        postings = self.postings
        if postings.keys().isdisjoint(words):
            return {}
        for i, word in enumerate(words):
            if word in postings:
                places[word].append(i)
        votes: dict[tuple[int, int], set[bytes]] = defaultdict(set)
        for word, held in places.items():
            for t, q in postings[word]:
                for i in held:
                    votes[t, i - q].add(word)
        found: dict[int, tuple[float, int]] = {}
        for t, start in sorted(votes):
            voters = votes[t, start]
            # Words put in or left out move the rest by a few places; their votes count together.
            for d in range(1, SLACK + 1):
                for near in (start - d, start + d):
                    if (t, near) in votes:
                        voters = voters | votes[t, near]
            if len(voters) < self.needed[t]:
                continue
            covered = self._coverage(t, start, words)
            if covered >= COVERAGE and covered > found.get(t, (0.0, 0))[0] and self._has_keys(t, start, words):
                found[t] = covered, max(start, 0)
        return found

    def _coverage(self, t: int, start: int, words: list[bytes]) -> float:
        """Share of the template's words met in order, each within a few places of where it should stand."""
        template, shift, met = self.words[t], 0, 0
        for q, word in enumerate(template):
            for d in sorted(range(-SLACK, SLACK + 1), key=lambda d: (abs(d - shift), d)):
                i = start + q + d
                if 0 <= i < len(words) and words[i] == word and d >= shift - 1:
                    met, shift = met + 1, d
                    break
        return met / len(template)

    def _has_keys(self, t: int, start: int, words: list[bytes]) -> bool:
        window = b" ".join([b"", *words[max(0, start - SLACK) : start + len(self.words[t]) + SLACK], b""])
        return all(b" ".join([b"", *key, b""]) in window for key in self.keys[t])


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """Start and label of every place where a base phrase stands, in order."""
    found = []
    if b"license" in words:
        for phrase, label in PHRASES.items():
            parts = words_of(phrase)
            last, n = parts[-1], len(parts)
            found += [
                (i - n + 1, label)
                for i, word in enumerate(words)
                if word == last and i >= n - 1 and words[i - n + 1 : i + 1] == parts
            ]
    return sorted(found)


RESULT = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, templates string"
)


def scan(text: str, index: Index) -> tuple:
    words = words_of(text)
    base = base_places(words)
    matched = index.matches(words)
    base_labels = {label for _, label in base}
    labels = base_labels | {label for t in matched for label in index.templates[t].labels}
    score = max([c for c, _ in matched.values()] + [PHRASE_SCORE] * bool(base), default=0.0)
    where = ",".join(f"{t}@{start}" for t, (_, start) in sorted(matched.items()))
    return (
        len(words),
        len(base),
        base[0][0] if base else None,
        base[-1][0] if base else None,
        ",".join(sorted(base_labels)),
        ",".join(sorted(labels)),
        score,
        where,
    )


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text_col: str = "text") -> tuple[dict[bytes, int], int]:
    """How many of all documents hold each licence word, and how many there are.

    Counted in tasks and summed; what reaches the driver is one row per word of the templates, whatever the input.
    """
    vocabulary = Index(templates).vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column("text").to_pylist():
                held.update(vocabulary.intersection(words_of(text)))
        names = [b"", *held]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array([rows, *held.values()], pa.int64())], names=["word", "n"]
        )

    counted = map_text(docs, {"text": text_of(text_col)}, count, "word binary, n bigint")
    sums = {bytes(r["word"]): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return sums, sums.pop(b"", 0)


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES
) -> DataFrame:
    """``id`` and the columns of ``RESULT``, one row per row; two scans, no shuffle of texts.

    ``labels`` are those of the base phrases and of every verified template; ``templates`` lists number and first
    word of the latter. ``score`` is the best coverage of a verified template, one half where only a base phrase
    stands, else zero. Null text counts as empty: no words, no labels, score zero. An empty table gives no rows;
    rows and identifiers may repeat; other columns are not read.
    """
    frequencies, n_docs = document_frequencies(docs, templates, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, {RESULT}"
    types = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    fields = [f.split() for f in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, frequencies, n_docs)
        for batch in batches:
            rows = [scan(t, index) for t in batch.column("text").to_pylist()]
            columns = list(zip(*rows)) if rows else [[]] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(c, types[kind]) for c, (_, kind) in zip(columns, fields)]],
                names=["id", *[name for name, _ in fields]],
            )

    return map_text(docs, {"id": F.col(id_col), "text": text_of(text_col)}, run, schema)

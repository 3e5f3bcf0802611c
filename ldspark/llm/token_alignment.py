"""Alignment of the tokens of two tokenizers over the same texts, and how often their ids stand over each other.

Both tokenizers tell where their tokens lie: the first in characters, the second by the spans of its result's proto
message. Ends that both have are coarse cuts. Between two cuts, tokens that end inside a character, or one byte after
the other, are told apart by their decoded bytes.

A text is cut into words at spaces and line breaks that follow something else. Neither tokenizer has a token over
such a place, nor looks across it, so words are aligned each for itself, and those met lately are kept.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_text, text_of, write_scratch

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
META = "▁"
B_BITS = 15
WORD = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")
# letters, then marks; neither tokenizer has a token of both, but for an apostrophe that the first reads with a letter
_MARKED = re.compile(r"""([ \n][A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]+)""")
_CROSSING = re.compile(rf"[^{META}]{META}|\n|[A-Za-zÀ-ÖØ-öø-ÿ][!-&(-/:-@\[-`{{-~]")
KEPT_WORDS = 200_000
LONGEST_KEPT = 48
TOGETHER = 1000
BATCH_CHARACTERS = 1 << 20
HOT_PAIRS = 1 << 18


def byte_letters() -> dict[str, int]:
    """The characters byte-level vocabularies write bytes as: printable ones as themselves, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_ends(coarse: np.ndarray, lengths: np.ndarray, inside: np.ndarray) -> np.ndarray | None:
    """Where tokens end, in bytes: as the spans tell, but by decoded lengths for tokens that end ``inside`` a
    character. None where spans and lengths differ."""
    decoded = np.cumsum(lengths)
    ends = np.where(inside, decoded, coarse)
    return ends if np.array_equal(ends, decoded) else None


def overlaps(a_ids: np.ndarray, a_ends: np.ndarray, b_ids: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``cuts`` where tokens of both sides end, and the linked ids: between two neighbouring ends lies one token of
    each side, and two tokens that overlap do so in one such stretch."""
    stretches = np.union1d(a_ends, b_ends)
    return np.intersect1d(a_ends, b_ends, assume_unique=True), a_ids[np.searchsorted(a_ends, stretches)], b_ids[np.searchsorted(b_ends, stretches)]


class Aligner:
    """Aligns texts word by word; keeps the results of up to twice ``kept`` words and as many parts of words."""

    def __init__(self, a_path: str, b_path: str, kept: int = KEPT_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.a_bytes[number] = bytes([letters[c] for c in token]) if all(c in letters for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace(META, " ").encode() for i, name in enumerate(names)
        ]
        if len(self.a_bytes) > 1 << 31 - B_BITS or len(self.b_bytes) > 1 << B_BITS:
            raise ValueError("vocabularies too large for a pair of ids in 31 bits")
        plain = [n for i, n in enumerate(names) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        if json.loads(self.a.to_str())["pre_tokenizer"]["type"] != "ByteLevel" or any(map(_CROSSING.search, plain)):
            raise ValueError("tokens of these vocabularies may lie over the places texts are cut at")
        self.a_lengths = np.array([len(x) for x in self.a_bytes], "i8")
        self.b_lengths = np.array([len(x) for x in self.b_bytes], "i8")
        self.kept = kept
        self.words: dict[str, tuple | None] = {}
        self.parts: dict[str, tuple | None] = {}
        self.older_words: dict[str, tuple | None] = {}
        self.older_parts: dict[str, tuple | None] = {}

    def _spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and ends in bytes of both sides over a text that begins with a space; None where they are not its bytes."""
        raw = text.encode()
        encoding = self.a.encode(text, add_special_tokens=False)
        stops = np.array([stop for _, stop in encoding.offsets], "i8")
        if len(raw) > len(text):
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            at = np.zeros(len(points) + 1, "i8")
            np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), out=at[1:])
            stops = at[stops]
        # the second puts a space before what it gets
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        a_ids, b_ids = np.array(encoding.ids, "i8"), np.array([p.id for p in pieces], "i8")
        if b"".join([self.a_bytes[i] for i in a_ids]) != raw or b"".join([self.b_bytes[i] for i in b_ids]) != raw:
            return None
        told = np.array([p.end for p in pieces], "i8") + 1
        # within a character the first side tells the character's end for all, the second its start for all but the last
        a_ends = byte_ends(stops, self.a_lengths[a_ids], np.append(stops[1:] == stops[:-1], False))
        b_ends = byte_ends(told, self.b_lengths[b_ids], np.insert(told[1:] == told[:-1], 0, False))
        return None if a_ends is None or b_ends is None else (a_ids, a_ends, b_ids, b_ends)

    def _together(self, parts: list[str], carrier: str) -> list[tuple | None]:
        """Each part's count of first ids, codes of linked pairs and text of groups, from one text of all after a
        carrier. Where the bytes differ the parts are looked at one by one, so only those at fault have no result."""
        spans = self._spans(carrier + "".join(parts))
        if spans is None:
            return [None] if len(parts) == 1 else [made for part in parts for made in self._together([part], carrier)]
        a_ids, a_ends, b_ids, b_ends = spans
        cuts, first, second = overlaps(*spans)
        codes = (first << B_BITS | second).astype("<i4")
        stretches = np.union1d(a_ends, b_ends)
        bounds = np.cumsum([len(carrier.encode()), *[len(p.encode()) for p in parts]])
        if not np.isin(bounds, cuts, assume_unique=True).all():
            raise ValueError("a token lies over a place the text is cut at")
        # tokens in the order of groups, the first side's before the second's, each with what stands before it
        group = np.concatenate([2 * np.searchsorted(cuts, a_ends), 2 * np.searchsorted(cuts, b_ends) + 1])
        order = np.argsort(group, kind="stable")
        group, ids = group[order], np.concatenate([a_ids, b_ids])[order].tolist()
        begins = np.insert(group[1:] != group[:-1], 0, True)
        before = np.where(begins, 1 + group % 2, 0).tolist()
        named = [",;|"[k] + str(i) for k, i in zip(before, ids)]
        token_at = np.searchsorted(group, 2 * np.searchsorted(cuts, bounds) + 2).tolist()
        a_at = np.searchsorted(a_ends, bounds, "right").tolist()
        code_at = (4 * np.searchsorted(stretches, bounds, "right")).tolist()
        data = codes.tobytes()
        return [
            (a_at[k + 1] - a_at[k], data[code_at[k] : code_at[k + 1]], "".join(named[token_at[k] : token_at[k + 1]])[1:])
            for k in range(len(parts))
        ]

    def _new_parts(self, parts: list[str]) -> None:
        plain, marks, odd = [], [], []
        for part in parts:
            (odd if part[-1:].isspace() else plain if part[0] in " \n" else marks).append(part)
        for i in range(0, len(plain), TOGETHER):
            some = plain[i : i + TOGETHER]
            self.parts.update(zip(some, self._together(some, " a")))
        for part in odd:
            self.parts[part] = self._together([part], " a")[0]
        for part in marks:
            self.parts[part] = self._together([part], " a")[0]

    def _new_words(self, words: list[str]) -> None:
        cut = []
        for word in words:
            found = _MARKED.fullmatch(word)
            cut.append(found.groups() if found else (word,))
        missing = []
        for part in {part for parts in cut for part in parts}:
            if part not in self.parts:
                if part in self.older_parts:
                    self.parts[part] = self.older_parts[part]
                else:
                    missing.append(part)
        self._new_parts(missing)
        for word, parts in zip(words, cut):
            if len(parts) == 1:
                self.words[word] = self.parts[word]
                continue
            head, tail = (self.parts[part] for part in parts)
            self.words[word] = head and tail and (head[0] + tail[0], head[1] + tail[1], head[2] + ";" + tail[2])

    def texts(self, texts: list[str]) -> list[tuple]:
        """Per text ``n_a, n_b, n_groups, n_links, groups``, the distinct pairs and how often each occurs."""
        cut = [WORD.findall(" " + t) if t and META not in t else [] for t in texts]
        missing = []
        for word in set().union(*cut) if cut else ():
            if word not in self.words:
                if word in self.older_words:
                    self.words[word] = self.older_words[word]
                else:
                    missing.append(word)
        self._new_words(missing)
        known = self.words
        out = [self._one([known[word] for word in words]) for words in cut]
        for word in missing:
            if len(word) > LONGEST_KEPT:
                known.pop(word)
                found = _MARKED.fullmatch(word)
                for part in found.groups() if found else (word,):
                    self.parts.pop(part, None)
        if len(known) > self.kept:
            self.older_words, self.words = known, {}
        if len(self.parts) > self.kept:
            self.older_parts, self.parts = self.parts, {}
        return out

    @staticmethod
    def _one(words: list[tuple | None]) -> tuple:
        if not words or None in words:
            return 0, 0, 0, 0, "", np.empty(0, "i4"), np.empty(0, "i4")
        n_a = sum([w[0] for w in words])
        codes = np.frombuffer(b"".join([w[1] for w in words]), "<i4")
        groups = ";".join([w[2] for w in words])
        n_groups = groups.count(";") + 1
        pairs, times = np.unique(codes, return_counts=True)
        # every stretch ends where a token of either side does, and both do at the end of each group
        return n_a, len(codes) + n_groups - n_a, n_groups, len(codes), groups, pairs, times.astype("i4")


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def align_documents(
    docs: DataFrame, a_path: str | None = None, b_path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row: ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``, ``pairs``, ``times``.

    ``groups`` is text: ids of the first tokenizer, ``|``, ids of the second, between places where tokens of both
    end, joined by ``;``. ``pairs`` are the distinct linked ids, the first's above the second's 15 bits, and ``times``
    how many links each has. The first tokenizer reads the text after a space, the second puts one before it itself.
    Null and empty texts, and those whose tokens' bytes differ from the text, have no tokens. A map without a
    shuffle; rows and identifiers may repeat, an empty table gives no rows, other columns are not read.
    """
    a_path = a_path or public_tokenizers.path(A_FILE)
    b_path = b_path or public_tokenizers.path(B_FILE)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
    types = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int32())] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(a_path, b_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            start = 0
            while start < len(texts):
                stop, size = start, 0
                while stop < len(texts) and (stop == start or size < BATCH_CHARACTERS):
                    size, stop = size + len(texts[stop]), stop + 1
                columns = list(zip(*work.texts(texts[start:stop])))
                ids = batch.column("id").slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns, types)], names=["id", *names])
                start = stop

    schema = f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs array<int>, times array<int>"
    return map_text(docs, {"id": F.col(id_col), "text": text_of(text_col)}, run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, documents, best``: how many rows hold a linked pair, and whether that is the most its first id has.

    The most per first id is a table of at most one row per id of the first vocabulary, so it may be broadcast.
    """
    counts = write_scratch(
        aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("documents")), "pair-counts"
    )
    first = F.shiftright("pair", B_BITS)
    most = counts.groupBy(first.alias("first_id")).agg(F.max("documents").alias("most"))
    joined = counts.join(F.broadcast(most), first == F.col("first_id"))
    return joined.select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def link_sums(aligned: DataFrame, key: str, counts: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``key, n_best, count_sum``: a row's links over the pairs that are best for their first id, and the sum of
    all links' counts. ``key`` tells the rows apart; rows without links are not in the result.

    Pairs in more than one ``hot_pairs``-th of all places are fewer than that many, whatever the data, so they are
    broadcast and summed per row without a shuffle. Only what rare pairs a row has is shuffled to be joined, and no
    key of that join has more than that share of the places.
    """
    counts = write_scratch(counts, "pair-table")
    total = counts.agg(F.sum("documents").alias("n")).scalar()
    hot = F.col("documents") > total / F.lit(float(hot_pairs))
    entries = aligned.select(key, F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    listed = counts.where(hot)
    common = entries.join(F.broadcast(listed), "pair")
    rare = entries.join(F.broadcast(listed.select("pair")), "pair", "left_anti").join(counts.where(~hot), "pair")
    n_best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
    count_sum = F.sum(F.col("documents") * F.col("times")).alias("count_sum")
    parts = [part.groupBy(key).agg(n_best, count_sum) for part in (common, rare)]
    return parts[0].union(parts[1]).groupBy(key).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_corpus(
    docs: DataFrame, a_path: str | None = None, b_path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row: ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``,
    ``groups_sha256``, as :func:`align_documents` and :func:`link_sums` have them.

    Every row counts as a document, also where identifiers repeat or are null; the rows are numbered once they are
    written. The digest of a row without tokens is the empty text.
    """
    aligned = align_documents(docs, a_path, b_path, id_col, text_col)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    kept = aligned.select(
        F.monotonically_increasing_id().alias("place"), "id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times"
    )
    stored = write_scratch(kept, "aligned")
    sums = link_sums(stored, "place", pair_counts(stored))
    joined = stored.drop("pairs", "times").join(sums, "place", "left")
    return joined.select(
        "id", "n_a", "n_b", "n_groups", "n_links",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")],
        "groups_sha256",
    )

"""Hierarchical packing of token ids into sequences of several lengths.

Documents are routed by their length to tiers of context size, each tier is packed, the room left in long windows
is filled from shorter tiers, and full windows are dealt to step groups of an equal number of tokens.
"""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import map_text, text_of

TIERS = (128, 256, 512, 1024)
STEP_TOKENS = 16384
END = 0
RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"
SPECIAL = {"<|endoftext|>": 50256}
PIECE = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "tier bigint, step_group bigint"
)
_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(ranks_path: str | None = None) -> tiktoken.Encoding:
    """The byte-level BPE of byte_bpe_50k, read from its list of ranks, once per worker.

    The ids are those of the tokenizers library for byte_bpe_50k.json, special strings included; this reader of
    the same vocabulary takes a fifth of the time.
    """
    path = ranks_path or public_tokenizers.path(RANKS)
    if path not in _encodings:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encodings[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _encodings[path]


_slow: dict[str, object] = {}


def token_ids(codec: tiktoken.Encoding, text: str, json_path: str) -> list[int]:
    """The ids of a text; by the tokenizers library where the fast reader gives up, as on white space of a million
    characters."""
    try:
        return codec.encode(text, allowed_special="all")
    except ValueError:
        if json_path not in _slow:
            from tokenizers import Tokenizer

            _slow[json_path] = Tokenizer.from_file(json_path)
        return _slow[json_path].encode(text, add_special_tokens=False).ids


class _Piece:
    """A run of one document's ids that has no place yet."""

    __slots__ = ("doc", "ids", "start", "total")

    def __init__(self, doc, ids, start, total):
        self.doc, self.ids, self.start, self.total = doc, ids, start, total

    def cut(self, n: int) -> tuple["_Piece", "_Piece"]:
        return _Piece(self.doc, self.ids[:n], self.start, self.total), _Piece(self.doc, self.ids[n:], self.start + n, self.total)


def _split(pieces: list[_Piece], length: int) -> tuple[list[_Piece], list[_Piece]]:
    taken = []
    for i, piece in enumerate(pieces):
        if len(piece.ids) > length:
            head, rest = piece.cut(length)
            return [*taken, *([head] if length else [])], [rest, *pieces[i + 1 :]]
        taken.append(piece)
        length -= len(piece.ids)
    return taken, []


class Packer:
    """Packs the documents of one partition; holds at most a few windows' worth of pieces per tier.

    ``add`` routes a document and gives the pieces of the windows that became full; ``finish`` gives the rest, and
    cuts the one window it cannot fill into lengths that are powers of two.
    """

    def __init__(self, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS, first: int = 0, waiting: int = 64):
        self.tiers = sorted(tiers)
        self.longest = self.tiers[-1]
        self.step_tokens, self.next, self.waiting = step_tokens, first, waiting
        self.queues = {t: deque() for t in self.tiers}
        self.step: dict[int, tuple[int, int]] = {}
        self.next_step = first

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        total, at = len(ids), 0
        while total - at >= self.longest:
            yield from self._emit([_Piece(doc, ids[at : at + self.longest], at, total)], self.longest)
            at += self.longest
        if at < total:
            rest = _Piece(doc, ids[at:], at, total)
            self._route(rest)
        tier = self.longest
        while len(self.queues[tier]) > self.waiting:
            yield from self._emit(self._window(tier), tier)
        for tier in self.tiers[:-1]:
            # Shorter tiers keep more, as fillers; beyond that they make windows of their own size.
            while len(self.queues[tier]) > 4 * self.waiting:
                yield from self._emit(self._window(tier), tier)

    def finish(self) -> Iterator[tuple]:
        for tier in reversed(self.tiers):
            while self.queues[tier]:
                pieces = self._window(tier)
                left = sum(len(p.ids) for p in pieces)
                while left:
                    length = min(tier, 1 << (left.bit_length() - 1)) if left < tier else tier
                    taken, pieces = _split(pieces, length)
                    yield from self._emit(taken, length)
                    left -= length

    def _route(self, piece: _Piece) -> None:
        n = len(piece.ids)
        self.queues[next(t for t in self.tiers if n <= t)].append(piece)

    def _window(self, tier: int) -> list[_Piece]:
        """One window of this tier: its next piece, then fillers of the same and shorter tiers, the longest that
        fit first, and a cut of the next piece for what is left."""
        pieces = [self.queues[tier].popleft()]
        gap = tier - len(pieces[0].ids)
        for fill in [t for t in reversed(self.tiers) if t <= tier]:
            queue = self.queues[fill]
            for _ in range(min(len(queue), 8)):
                if 0 < len(queue[0].ids) <= gap:
                    pieces.append(queue.popleft())
                    gap -= len(pieces[-1].ids)
                else:
                    queue.rotate(-1)
        for fill in [t for t in self.tiers if t <= tier]:
            while gap and self.queues[fill]:
                piece = self.queues[fill].popleft()
                if len(piece.ids) > gap:
                    piece, rest = piece.cut(gap)
                    self._route(rest)
                pieces.append(piece)
                gap -= len(piece.ids)
        return pieces

    def _emit(self, pieces: list[_Piece], tier: int) -> Iterator[tuple]:
        group, used = self.step.get(tier, (0, 0))
        if used + tier > self.step_tokens or used == 0:
            group, used = self.next_step, 0
            self.next_step += 1
        self.step[tier] = group, used + tier
        offset = 0
        for p in pieces:
            n = len(p.ids)
            yield p.doc, p.start, n, zlib.crc32(p.ids.tobytes()), p.total, self.next, offset, tier, group
            offset += n
        self.next += 1


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    ranks_path: str | None = None,
    json_path: str | None = None,
) -> DataFrame:
    """One row per piece: ``id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset``, ``tier``, ``step_group``.

    Every document is its ids and then id 0; null text is empty, so it is that one id. Whole documents are placed
    where they fit, and only what fills a window's last gap is cut. All windows are full; a partition's last one is cut
    into powers of two, so nothing is padded. A partition packs what it reads, so nothing is shuffled and a lost task
    packs the same rows to the same windows again. ``ranks_path`` and ``json_path`` hold one vocabulary in two forms. Repeated rows and identifiers are packed each; an empty table gives no rows; other
    columns are not read. ``sequence_id`` and ``step_group`` carry the partition in their upper bits.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, slow = encoding(ranks_path), json_path or public_tokenizers.path(VOCABULARY)
        packer = Packer(tiers, step_tokens, TaskContext.get().partitionId() << 33)
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]

        def made(rows, id_type):
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:]]], names=names
            )

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            rows = []
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*token_ids(codec, text, slow), END], dtype="<u4")
                rows.extend(packer.add(doc, ids))
            yield made(rows, id_type)
        if id_type is not None:
            yield made(list(packer.finish()), id_type)

    return map_text(docs, {"id": F.col(id_col), "text": text_of(text_col)}, run, f"id {kind}, {PIECE}")

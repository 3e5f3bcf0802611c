"""Scores of texts by two models learned from the corpus: words counted, and causal self-attention on subwords.

Both learn from the training rows. Word counts cover all of them; the attention model starts from the counts of
all subwords and learns from every window of every training text once, each in one of the rounds. Partitions train apart from the same weights, and the weights are averaged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import attention
from .common import map_text, ready, text_of, write_scratch
from .packing import SPECIAL, encoding

FOLDS, HELD_OUT = 7, 2
INPUTS, OUTPUTS, OTHERS = 768, 192, 256
END_ID = SPECIAL["<|endoftext|>"]
IDS = END_ID + 1
STORED_ID = np.dtype("<u2")  # holds all of them
FREQUENT_SHARE = 2_000_000
ROUNDS, TRAIN_SHARE, LEAST_CHARACTERS = 2, 64, 80
RATE, BATCH_WINDOWS, SCORED_WINDOWS = 0.02, 48, 64
WAITING_IDS = 1 << 18
KEPT_WORDS = 300_000
COUNTED_WORDS = 400_000
_END = b"\n"
_tables: dict[str, np.ndarray] = {}


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def _space_first() -> np.ndarray:
    """Whether the bytes of each id start with a space, as those of a word's first id do."""
    if "space" not in _tables:
        codec = encoding()
        _tables["space"] = np.array([i != END_ID and codec.decode_single_token_bytes(i)[:1] == b" " for i in range(IDS)])
    return _tables["space"]


def encode_words(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the words, each with a space before it, and where each word's start. One call encodes them
    together, since a word's ids do not depend on its neighbours."""
    ids = np.array(encoding().encode_ordinary(" " + " ".join([w.decode() for w in words])), "<i4")
    starts = np.flatnonzero(_space_first()[ids])
    if len(starts) != len(words):
        raise AssertionError("a word's ids do not start with a space")
    return ids, starts


class Words:
    """The words a task has met, each looked up once: its subword ids, and its log10 by counts if it is frequent.

    Up to ``KEPT_WORDS`` words and those of one call are kept; then it starts over.
    """

    def __init__(self, logs: dict[bytes, float] | None = None, end_log: float = 0.0):
        self.frequent, self.end_log = logs or {}, end_log
        self._restart()

    def _restart(self) -> None:
        # The end of a text is entry 0, under a name that no word can have.
        self.index = {_END: 0}
        self.pieces = [np.array([END_ID], "<i4").tobytes()]
        self.logs, self.sizes = np.full(1 << 16, self.end_log), np.ones(1 << 16, np.int64)

    def _learn(self, new: list[bytes]) -> None:
        ids, starts = encode_words(new)
        starts = starts * 4
        raw, ends = ids.tobytes(), np.append(starts[1:], len(ids) * 4)
        first = len(self.pieces)
        self.pieces += [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        self.index.update(zip(new, range(first, len(self.pieces)), strict=True))
        while len(self.pieces) > len(self.logs):
            self.logs, self.sizes = np.tile(self.logs, 2), np.tile(self.sizes, 2)
        self.sizes[first : len(self.pieces)] = (ends - starts) // 4
        self.logs[first : len(self.pieces)] = [self.frequent.get(w, np.nan) for w in new]

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """The entry of each word, new ones made first."""
        if len(self.index) > KEPT_WORDS:
            self._restart()
        found = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            self._learn(list(dict.fromkeys([words[i] for i in missing])))
            found[missing] = [self.index[words[i]] for i in missing]
        return found

    def ids(self, entries: np.ndarray) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, entries.tolist())), "<i4")


def flattened(texts: list[list[bytes]]) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts, each text closed by its end, and where each text starts."""
    flat: list[bytes] = []
    starts = []
    for words in texts:
        starts.append(len(flat))
        flat += words
        flat.append(_END)
    return flat, np.array(starts, np.int64)


def subwords(texts: list[list[bytes]], words: Words) -> list[np.ndarray]:
    """For each text's words the ids of their subwords, each word with a space before it, and the end id."""
    flat, starts = flattened(texts)
    entries = words.look_up(flat)
    lengths = np.add.reduceat(words.sizes[entries], starts)
    return np.split(words.ids(entries), np.cumsum(lengths)[:-1])


@dataclass(frozen=True)
class Classes:
    """Which input row, output class and, in class 0, second class each id has. The most frequent ids have their
    own; all others share row or class 0 and are told apart by their counts."""

    inputs: np.ndarray
    outputs: np.ndarray
    others: np.ndarray
    within: np.ndarray
    output_bias: np.ndarray
    other_bias: np.ndarray

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> "Classes":
        ranked = np.lexsort((np.arange(len(counts)), -counts))
        inputs, outputs, others = (np.zeros(len(counts), np.int32) for _ in range(3))
        # Input row INPUTS stands for what lies before the text.
        inputs[ranked[: INPUTS - 1]] = np.arange(1, INPUTS)
        outputs[ranked[: OUTPUTS - 1]] = np.arange(1, OUTPUTS)
        others[ranked[OUTPUTS - 1 : OUTPUTS + OTHERS - 2]] = np.arange(1, OTHERS)
        rest = (outputs == 0) & (others == 0)
        smoothed = counts + 1.0
        within = np.where(rest, np.log(smoothed / smoothed[rest].sum()), 0.0)
        totals = np.bincount(outputs, smoothed, OUTPUTS)
        second = np.bincount(others[outputs == 0], smoothed[outputs == 0], OTHERS)
        return cls(inputs, outputs, others, within, np.log(totals / totals.sum()), np.log(second / second.sum()))

    def fresh_weights(self) -> dict[str, np.ndarray]:
        return attention.fresh(INPUTS + 1, self.output_bias, self.other_bias)


def _batches(ids: np.ndarray, lengths: np.ndarray, classes: Classes):
    """Of the windows of texts, given by all their ids and their lengths, the inputs, target ids, positions and
    validity."""
    at, inside = attention.windows(lengths)
    seen = np.empty(len(ids), np.int32)
    seen[1:] = classes.inputs[ids[:-1]]
    seen[np.cumsum(lengths) - lengths] = INPUTS
    scored, live = at[:, attention.CONTEXT :], inside[:, attention.CONTEXT :]
    return np.where(inside, seen[at], INPUTS), ids[scored], scored, live


def score_texts(ids: np.ndarray, lengths: np.ndarray, classes: Classes, weights: dict[str, np.ndarray]) -> np.ndarray:
    """Log10 probability of each text; every text has its end at least."""
    x, targets, scored, live = _batches(ids, lengths, classes)
    each = classes.within[ids]
    for i in range(0, len(x), SCORED_WINDOWS):
        part = slice(i, i + SCORED_WINDOWS)
        found = attention.log_probabilities(weights, x[part], classes.outputs[targets[part]], classes.others[targets[part]])
        mask = live[part].ravel()
        each[scored[part].ravel()[mask]] += found[mask]
    return np.add.reduceat(each, np.cumsum(lengths) - lengths) / np.log(10)


def of_round(lengths: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """Numbers of the windows that a round learns from. A text's windows are dealt over the rounds in turn, from a
    place told by the text's length, so every window is in just one round, however rows are ordered."""
    per_text = -(-lengths // attention.STRIDE)
    nth = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    return np.flatnonzero((nth + np.repeat(lengths, per_text)) % rounds == turn)


def learn(
    texts: list[np.ndarray], classes: Classes, adam: attention.Adam, rng: np.random.Generator, turn: int = 0, rounds: int = 1
) -> int:
    """One pass over the round's windows of the texts in a seeded order; how many positions it learned from."""
    lengths = np.array([len(t) for t in texts], np.int64)
    x, targets, _, live = _batches(np.concatenate(texts), lengths, classes)
    chosen = of_round(lengths, turn, rounds)
    order = rng.permutation(chosen)
    for i in range(0, len(order), BATCH_WINDOWS):
        part = order[i : i + BATCH_WINDOWS]
        gradient, _ = attention.gradients(
            adam.weights, x[part], classes.outputs[targets[part]], classes.others[targets[part]], live[part]
        )
        adam.step(gradient)
    return int(live[chosen].sum())


def _in_chunks(batch_texts: list[str], size: int = 1 << 20) -> Iterator[list[list[bytes]]]:
    """Word lists of texts, of about a megabyte of text at a time."""
    chunk, held = [], 0
    for text in batch_texts:
        chunk.append(words_of(text))
        held += len(text)
        if held >= size:
            yield chunk
            chunk, held = [], 0
    if chunk:
        yield chunk


def held_out(id_col: str) -> Column:
    """Rows the models do not learn from; a null identifier counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def count_words(training: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` (bytes), ``n`` over all rows; the null word counts the ends of texts. Counted in tasks, in parts of
    bounded size, before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(held: Counter, ends: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([*held, None], pa.binary()), pa.array([*held.values(), ends], pa.int64())], names=["word", "n"]
            )

        held, ends = Counter(), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(words_of(text))
                ends += 1
                if len(held) > COUNTED_WORDS:
                    yield made(held, ends)
                    held, ends = Counter(), 0
        yield made(held, ends)

    counted = map_text(training, {"text": text_of(text_col)}, run, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


def _texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of them, one after the other, and how many each row has."""
    if not len(column):
        return np.empty(0, STORED_ID), np.empty(0, np.int64)
    offsets = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return raw.view(STORED_ID), np.diff(offsets) // STORED_ID.itemsize


def count_subwords(rows: DataFrame) -> np.ndarray:
    """How often each subword id stands in the rows' ``ids``; one sum per id of the vocabulary reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(IDS, np.int64)
        for batch in batches:
            totals += np.bincount(_texts_of(batch.column("ids"))[0], minlength=IDS)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], names=["i", "n"])

    sums = rows.select("ids").mapInArrow(run, "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(IDS, np.int64)
    for row in sums:
        counts[row["i"]] = row["n"]
    return counts


def a_part(text: Column, turn: int) -> list[Column]:
    """The run of characters that a text gives in a round, and whether it has the text's start and end. It is a
    fixed share of the text at a place told by its length, and never less than a few words of what there is.
    Training reads whole texts and does not use it; a test still holds it."""
    length = F.length(text)
    n = F.greatest(F.floor(length / TRAIN_SHARE), F.lit(LEAST_CHARACTERS))
    at = F.pmod(F.xxhash64(length, F.lit(turn)), F.greatest(length - n + 1, F.lit(1)))
    piece = F.substring(text, (at + 1).cast("int"), n.cast("int"))
    return [piece.alias("text"), (at == 0).alias("first"), (at + n >= length).alias("last")]


def train_round(
    training: DataFrame, classes: Classes, weights: dict[str, np.ndarray], turn: int, text_col: str = "text", ids_col: str | None = None
) -> dict[str, np.ndarray]:
    """One round: every partition trains on the round's windows of its texts, and the weights are averaged by how much
    each has seen. Only the average, a list as long as the weights, reaches the driver. Texts are looked up unless
    ``ids_col`` holds their ids."""
    start = attention.flatten(weights)
    sizes = INPUTS + 1, OUTPUTS, OTHERS

    def texts_of(batch: pa.RecordBatch, words: Words) -> Iterator[np.ndarray]:
        if ids_col is not None:
            ids, lengths = _texts_of(batch.column("ids"))
            yield from np.split(ids, np.cumsum(lengths)[:-1]) if len(lengths) else ()
            return
        for chunk in _in_chunks(batch.column("text").to_pylist()):
            yield from subwords(chunk, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        adam = attention.Adam(attention.unflatten(start.copy(), *sizes), RATE)
        rng, words, seen, waiting, n_waiting = np.random.default_rng(turn), Words(), 0, [], 0
        for batch in batches:
            for ids in texts_of(batch, words):
                waiting.append(ids)
                n_waiting += len(ids)
                if n_waiting > WAITING_IDS:
                    seen += learn(waiting, classes, adam, rng, turn, ROUNDS)
                    waiting, n_waiting = [], 0
        if waiting:
            seen += learn(waiting, classes, adam, rng, turn, ROUNDS)
        if seen:
            flat = attention.flatten(adam.weights).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(seen)]), pa.array([flat], pa.list_(pa.float64()))], names=["seen", "w"]
            )

    read = {"text": text_of(text_col)} if ids_col is None else {"ids": F.col(ids_col)}
    trained = map_text(training, read, run, "seen double, w array<double>")
    mean = (
        trained.select("seen", F.posexplode("w").alias("i", "w"))
        .groupBy("i")
        .agg((F.sum(F.col("seen") * F.col("w")) / F.sum("seen")).alias("w"))
        .collect()
    )
    if not mean:
        return weights
    flat = np.zeros(len(start))
    for row in mean:
        flat[row["i"]] = row["w"]
    return attention.unflatten(flat, *sizes)


def score_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``; one row per row.

    Tokens are words and an end. ``base_score`` is the log10 probability by counts with one added; words that are
    frequent in training (at most two million by how that is set) are looked up from a broadcast, all others meet
    their counts in a join, one row per text and word. ``score`` is the log10 probability of the text's subwords
    and end by the attention model, from overlapping windows over the whole text.

    Null text counts as empty: one token, the end. An empty table gives no rows; without training rows all words
    are unknown and the model is untrained. Rows and identifiers may repeat; other columns are not read.
    """
    spark = docs.sparkSession
    ready(spark)
    training = docs.where(~held_out(id_col))
    counts = write_scratch(count_words(training, text_col), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    frequent = counts.where(F.col("word").isNotNull() & (F.col("n") * FREQUENT_SHARE >= total))
    known = frequent.toArrow()
    ends = sum(r["n"] for r in counts.where("word IS NULL").collect())

    smoothing = total + distinct + 1
    # Logarithms are taken here, so that a worker holds one dictionary.
    logs = [math.log10((n + 1) / smoothing) for n in known.column("n").to_pylist()]
    shared = spark.sparkContext.broadcast(dict(zip(known.column("word").to_pylist(), logs)))
    kind = docs.schema[id_col].dataType.simpleString()

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shared.value, math.log10((ends + 1) / smoothing))
        for batch in batches:
            n_tokens, n_known, base, rare, times, ids = [], [], [], [], [], []
            # Equal texts of a batch are looked up once.
            texts = batch.column("text").dictionary_encode()
            for chunk in _in_chunks(texts.dictionary.to_pylist()):
                flat, starts = flattened(chunk)
                entries = words.look_up(flat)
                lengths = np.add.reduceat(words.sizes[entries], starts)
                stored = words.ids(entries).astype(STORED_ID)
                ids.extend(part.tobytes() for part in np.split(stored, np.cumsum(lengths)[:-1]))
                counted = words.logs[entries]
                unknown = np.isnan(counted)
                n_tokens.extend(map(len, chunk))
                base.extend(np.add.reduceat(np.where(unknown, 0.0, counted), starts))
                places = np.flatnonzero(unknown)
                cuts = np.searchsorted(places, [*starts[1:], len(flat)])
                places, begin = places.tolist(), 0
                for cut, n in zip(cuts.tolist(), map(len, chunk)):
                    held = Counter([flat[i] for i in places[begin:cut]])
                    n_known.append(n - (cut - begin))
                    rare.append(list(held))
                    times.append(list(held.values()))
                    begin = cut
            made = [
                pa.array([n + 1 for n in n_tokens], pa.int64()),
                pa.array([n + (ends > 0) for n in n_known], pa.int64()),
                pa.array(base, pa.float64()),
                pa.array(rare, pa.list_(pa.binary())),
                pa.array(times, pa.list_(pa.int32())),
                pa.array(ids, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), *[column.take(texts.indices) for column in made]],
                names=["id", "held_out", "n_tokens", "n_known", "base", "rare", "times", "ids"],
            )

    told = f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double"
    looked = map_text(
        docs,
        {"id": F.col(id_col), "held_out": held_out(id_col), "text": text_of(text_col)},
        looked_up,
        f"{told}, rare array<binary>, times array<int>, ids binary",
    )
    # Words are looked up once; both rounds and the scores read the ids that are written here. Rows are numbered before
    # they are written, so that the numbers stay with them.
    rows = write_scratch(looked.withColumn("row", F.monotonically_increasing_id()), "looked-up")
    shared.unpersist()

    learned = rows.where("NOT held_out")
    classes = Classes.from_counts(count_subwords(learned))
    weights = classes.fresh_weights()
    for turn in range(ROUNDS):
        weights = train_round(learned, classes, weights, turn, ids_col="ids")
    model = spark.sparkContext.broadcast((classes, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, weights = model.value
        for batch in batches:
            # Equal texts of a batch are scored once.
            texts = batch.column("ids").dictionary_encode()
            ids, lengths = _texts_of(texts.dictionary)
            found, first, start = [], 0, 0
            held = np.cumsum(lengths)
            while first < len(lengths):
                last = max(first + 1, int(np.searchsorted(held, start + WAITING_IDS, "right")))
                found.append(score_texts(ids[start : held[last - 1]], lengths[first:last], classes, weights))
                first, start = last, held[last - 1]
            scores = pa.array(np.concatenate([np.empty(0), *found]), pa.float64()).take(texts.indices)
            kept = [name for name in batch.schema.names if name != "ids"]
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in kept], scores], names=[*kept, "score"])

    scored = rows.select("row", "id", "held_out", "n_tokens", "n_known", "base", "ids").mapInArrow(
        score, f"row bigint, {told}, score double"
    )
    scored = write_scratch(scored, "scored")
    model.unpersist()
    log_count = F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(smoothing)))
    tails = (
        rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("t"))
        .select("row", F.col("t.rare").alias("word"), F.col("t.times").alias("times"))
        .join(counts.where(F.col("word").isNotNull() & (F.col("n") * FREQUENT_SHARE < total)), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * log_count).alias("tail"),
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(F.lit(0))).alias("tail_known"),
        )
    )
    return scored.join(tails, "row", "left").select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail", F.lit(0.0))).alias("base_score"),
        "score",
    )

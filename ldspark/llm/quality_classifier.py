"""Quality of texts by gradient-boosted trees over statistics of the text.

One pass measures every text; a measurement is kept as one of 1024 steps of its scale. How often each step occurs is
counted over all documents and gives the thresholds trees may split at. Trees are grown from histograms of gradients
per threshold on a sample of labelled rows, flattened into arrays of one entry per node, and all rows of a batch walk
down all trees at once.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_text, quoted, ready, text_of, write_scratch

STEPS = 1024
SAMPLE_ROWS = 50_000
QUANTILES, EVEN_CUTS = 64, 32
BYTE_CLASSES = {
    "upper": range(0x41, 0x5B),
    "lower": range(0x61, 0x7B),
    "digit": range(0x30, 0x3A),
    "space": (0x20, *range(0x09, 0x0E)),
    "stop": b".,;:!?",
    "mark": b"#*$%&|<>@^~=+_\\/",
    "bracket": b"()[]{}\"'`-",
    "other": range(0x80, 0x100),
}
FEATURES = (
    "words", "characters", "word_length", "longest_word", "line_length", "distinct_words", "most_frequent_word",
    "word_entropy", "repeated_neighbours", "repeated_triples", "repeated_lines", "stop_words", "bare_marks", "capitalised",
    "byte_entropy", "compression", *BYTE_CLASSES,
)
_MASKS = np.zeros((256, len(BYTE_CLASSES)))
for _k, _bytes in enumerate(BYTE_CLASSES.values()):
    _MASKS[list(_bytes), _k] = 1


def _log(x: float, most: float) -> float:
    return min(1.0, math.log1p(x) / math.log1p(most))


def _word_shares(raw: bytes) -> list[float]:
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * 14
    lines = [line for line in raw.split(b"\n") if line.strip()]
    times = Counter(words)
    triples = Counter(zip(words, words[1:], words[2:]))
    counts = np.fromiter(times.values(), float, len(times))
    entropy = float(-(counts / n * np.log2(counts / n)).sum())
    return [
        _log(n, 1e6),
        _log(len(raw), 1e7),
        _log(sum(map(len, words)) / n, 200),
        _log(max(map(len, times)), 1e5),
        _log(n / len(lines), 1e4),
        len(times) / n,
        float(counts.max()) / n,
        entropy / max(1.0, math.log2(n)),
        sum(a == b for a, b in zip(words, words[1:])) / n,
        sum(c for c in triples.values() if c > 1) / n,
        1 - len(set(lines)) / len(lines),
        sum(c for w, c in times.items() if w[-1:] in b".,;:!?") / n,
        sum(c for w, c in times.items() if not w.isalnum() and not w.strip(b"#*$%&|<>@^~=+_\\/-.,;:!?")) / n,
        sum(c for w, c in times.items() if w[:1].isupper()) / n,
    ]


def statistics(texts: list[str]) -> np.ndarray:
    """One row per text, one column per feature, as steps of its scale; shares are told finer near zero."""
    out = np.zeros((len(texts), len(FEATURES)))
    counts = np.zeros((len(texts), 256))
    for k, text in enumerate(texts):
        raw = text.encode()
        out[k, :14] = _word_shares(raw)
        if raw:
            counts[k] = np.bincount(np.frombuffer(raw, "u1"), minlength=256)
            out[k, 15] = min(1.0, len(zlib.compress(raw, 1)) / len(raw))
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    share = counts / total
    out[:, 14] = -(share * np.log2(np.where(share > 0, share, 1))).sum(1) / 8
    out[:, 16:] = share @ _MASKS
    out[:, 5:] = np.sqrt(np.clip(out[:, 5:], 0, 1))
    return np.rint(np.clip(out, 0, 1) * (STEPS - 1)).astype("i2")


def thresholds(histogram: np.ndarray) -> list[np.ndarray]:
    """Per feature the steps a tree may split after, by how often each step occurs: at quantiles and evenly between
    the first and the last step that occur."""
    out = []
    for counts in histogram:
        (found,) = np.nonzero(counts)
        if len(found) < 2:
            out.append(np.empty(0, "i2"))
            continue
        upto = np.cumsum(counts)
        marks = np.searchsorted(upto, upto[-1] * np.arange(1, QUANTILES) / QUANTILES)
        even = np.linspace(found[0], found[-1], EVEN_CUTS + 1)[1:-1].astype(int)
        cuts = np.unique(np.concatenate([marks, even]))
        out.append(cuts[(cuts >= found[0]) & (cuts < found[-1])].astype("i2"))
    return out


@dataclass(frozen=True)
class Forest:
    """Complete binary trees in arrays: ``feature`` and ``cut`` per tree and inner node, ``value`` per tree and leaf.

    The children of node ``i`` are ``2 i + 1``, for steps up to the cut, and ``2 i + 2``. A node that is not split
    has a cut no step is above.
    """

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def margin(self, steps: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        rows, tree = np.arange(len(steps))[:, None], np.arange(trees)[None, :]
        node = np.zeros((len(steps), trees), "i4")
        for _ in range((inner + 1).bit_length() - 1):
            node = 2 * node + 1 + (steps[rows, self.feature[tree, node]] > self.cut[tree, node])
        return self.base + self.value[tree, node - inner].sum(1)

    def score(self, steps: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(steps), -50, 50)))


def best_split(
    bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, node: np.ndarray, nodes: int, cuts: list[np.ndarray], l2: float, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Feature and cut of largest gain per node, from one histogram of gradients per feature; -1 where none gains."""
    gain, feature, place = np.full(nodes, 1e-9), np.full(nodes, -1), np.zeros(nodes, int)
    for f, own in enumerate(cuts):
        if not len(own):
            continue
        width = len(own) + 1
        key = node * width + bins[:, f]
        g = np.bincount(key, gradient, nodes * width).reshape(nodes, width).cumsum(1)
        h = np.bincount(key, hessian, nodes * width).reshape(nodes, width).cumsum(1)
        (gl, hl), (gt, ht) = (g[:, :-1], h[:, :-1]), (g[:, -1:], h[:, -1:])
        gained = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
        gained[(hl < least) | (ht - hl < least)] = 0
        at = gained.argmax(1)
        best = gained[np.arange(nodes), at]
        better = best > gain
        gain[better], feature[better], place[better] = best[better], f, at[better]
    return feature, place


def grow(
    steps: np.ndarray, label: np.ndarray, cuts: list[np.ndarray], trees: int = 80, depth: int = 4, rate: float = 0.15, l2: float = 1.0, least: float = 2.0
) -> Forest:
    """Trees for 0/1 labels by the logistic loss. Without rows of both labels there are none, and the score of any
    text is the labels' share, a half without rows."""
    positive = float(label.sum())
    base = math.log((positive + 1) / (len(label) - positive + 1))
    inner = (1 << depth) - 1
    feature, cut = np.zeros((trees, inner), "i4"), np.full((trees, inner), STEPS, "i4")
    value = np.zeros((trees, inner + 1))
    if not 0 < positive < len(label):
        return Forest(base, feature, cut, value)
    bins = np.column_stack([np.searchsorted(own, steps[:, f]) for f, own in enumerate(cuts)])
    margin = np.full(len(label), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - label, p * (1 - p)
        node = np.zeros(len(label), int)
        for level in range(depth):
            nodes, first = 1 << level, (1 << level) - 1
            split, place = best_split(bins, gradient, hessian, node, nodes, cuts, l2, least)
            right = np.zeros(len(label), bool)
            for k in np.flatnonzero(split >= 0):
                feature[t, first + k], cut[t, first + k] = split[k], cuts[split[k]][place[k]]
                right |= (node == k) & (bins[:, split[k]] > place[k])
            node = 2 * node + right
        g, h = np.bincount(node, gradient, inner + 1), np.bincount(node, hessian, inner + 1)
        value[t] = -rate * g / (h + l2)
        margin += value[t, node]
    return Forest(base, feature, cut, value)


def _bucket(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``steps``, an array of one short per feature; null text counts as empty. One row per row, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = statistics(batch.column("text").to_pylist())
            rows = pa.ListArray.from_arrays(np.arange(len(steps) + 1, dtype="i4") * len(FEATURES), pa.array(steps.ravel(), pa.int16()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), rows], names=["id", "steps"])

    return map_text(docs, {"id": F.col(quoted(id_col)), "text": text_of(text_col)}, run, f"id {kind}, steps array<short>")


def step_counts(stored: DataFrame) -> np.ndarray:
    """How many rows have each step of each feature; a table of features times steps, whatever the number of rows."""
    counted = stored.select(F.posexplode("steps").alias("feature", "step")).groupBy("feature", "step").count().toArrow()
    out = np.zeros((len(FEATURES), STEPS), "i8")
    out[counted["feature"].to_numpy(), counted["step"].to_numpy()] = counted["count"].to_numpy()
    return out


def train(stored: DataFrame, labels: DataFrame, label_id: str, label_col: str, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Trees for measured rows of the training part that have a label: all of them up to ``sample_rows``, else those
    of least hash. Several labels of one identifier count as one by their mean; null labels are none."""
    told = (
        labels.where(F.col(label_col).isNotNull() & F.col(label_id).isNotNull())
        .groupBy(F.col(label_id).alias("id"))
        .agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
    )
    rows = stored.where(_bucket("id") != 1).join(told, "id")
    sample = rows.orderBy(F.xxhash64("id"), "id", "steps").select("steps", "label").limit(sample_rows).toArrow()
    steps = sample["steps"].combine_chunks().values.to_numpy().reshape(-1, len(FEATURES)) if len(sample) else np.empty((0, len(FEATURES)), "i2")
    return grow(steps, sample["label"].to_numpy().astype(float), thresholds(step_counts(stored)))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per row: ``id``, ``held_out``, ``score`` from 0 to 1, ``predicted``.

    * Only the text makes a score. Labels are learnt from rows whose CRC-32 of the identifier leaves no remainder of 1
      by 3; a null identifier counts as the empty text and has no label.
    * The thresholds come from all documents. The trees are grown on the driver from at most ``sample_rows`` labelled
      rows of a few dozen bytes each; what is collected besides is the table of steps, of one size for any input.
    * Null and empty texts are scored as texts of no words. Without labels, or labels of one kind only, all texts have
      the same score. Repeated rows get equal scores, an empty table gives no rows, other columns are not read.
    """
    ready(docs.sparkSession)
    stored = write_scratch(measured(docs, id_col, text_col), "statistics")
    forest = train(stored, labels, label_id, label_col, sample_rows)
    kind = stored.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                steps = part.column("steps").flatten().to_numpy().reshape(-1, len(FEATURES))
                score = forest.score(steps)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype("i4"))],
                    names=["id", "held_out", "score", "predicted"],
                )

    rows = stored.select("id", (_bucket("id") == 1).alias("held_out"), "steps")
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int")

import random
import zlib

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from ldspark.llm import quality_classifier as q

LABELS = "doc_id BIGINT, quality INT, toxic INT"


def naive_split(steps, gradient, hessian, cuts, l2, least):
    """Gain of every split of one node, by masks."""
    best = (1e-9, -1, 0)
    for f, own in enumerate(cuts):
        for k, cut in enumerate(own):
            left = steps[:, f] <= cut
            parts = [(gradient[m].sum(), hessian[m].sum()) for m in (left, ~left)]
            if min(h for _, h in parts) < least:
                continue
            gain = sum(g * g / (h + l2) for g, h in parts) - gradient.sum() ** 2 / (hessian.sum() + l2)
            if gain > best[0] + 1e-12:
                best = (gain, f, k)
    return best


def test_histograms_find_the_best_split():
    rng = np.random.default_rng(1)
    for _ in range(20):
        steps = rng.integers(0, 12, (200, 4)).astype("i2")
        histogram = np.stack([np.bincount(steps[:, f], minlength=q.STEPS) for f in range(4)])
        cuts = q.thresholds(histogram)
        gradient, hessian = rng.normal(size=200), rng.uniform(0.1, 0.3, 200)
        bins = np.column_stack([np.searchsorted(own, steps[:, f]) for f, own in enumerate(cuts)])
        node = rng.integers(0, 3, 200)
        feature, place = q.best_split(bins, gradient, hessian, node, 3, cuts, 1.0, 2.0)
        for k in range(3):
            mine = node == k
            _, f, p = naive_split(steps[mine], gradient[mine], hessian[mine], cuts, 1.0, 2.0)
            assert (feature[k], place[k] if f >= 0 else 0) == (f, p)


def walk(forest, row):
    total = forest.base
    inner = forest.feature.shape[1]
    for feature, cut, value in zip(forest.feature, forest.cut, forest.value):
        node = 0
        while node < inner:
            node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
        total += value[node - inner]
    return total


def test_flat_trees_equal_walking_row_by_row():
    rng = np.random.default_rng(2)
    steps = rng.integers(0, q.STEPS, (300, len(q.FEATURES))).astype("i2")
    label = ((steps[:, 3] > 500) ^ (steps[:, 7] > 300)).astype(float)
    histogram = np.stack([np.bincount(steps[:, f], minlength=q.STEPS) for f in range(steps.shape[1])])
    forest = q.grow(steps, label, q.thresholds(histogram), trees=30)
    assert np.allclose(forest.margin(steps), [walk(forest, row) for row in steps])
    assert ((forest.score(steps) >= 0.5) == label).mean() > 0.97


def test_thresholds_part_rare_steps():
    counts = np.zeros((3, q.STEPS), "i8")
    counts[0, [10, 1000]] = 10_000, 3
    counts[1, 5] = 7
    many, none, empty = q.thresholds(counts)
    assert len(none) == len(empty) == 0
    assert ((many >= 10) & (many < 1000)).all() and len(many) >= q.EVEN_CUTS - 1


def corpus(n=400):
    """Prose marked good and three kinds of junk marked bad."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        text, good = cases.prose(rng, rng.randint(20, 150)), i % 4 != 0
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", "%%% "), " ".join([text.split()[0]] * 90)])
        rows.append((i, text, "en", "src1", 0))
        if i % 5:
            labels.append((i, int(good), i % 2))
    return rows, labels


def scored(spark, rows, labels, **more):
    docs = rows if hasattr(rows, "select") else cases.frame(spark, rows)
    return q.classify(docs, spark.createDataFrame(labels, LABELS), **more).collect()


def test_held_out_rows_are_told_apart(spark):
    rows, labels = corpus()
    good = {i: i % 4 != 0 for i, *_ in rows}
    found = scored(spark, rows, labels)
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in found if r.held_out]
    assert len(held) > 80 and sum(r.predicted == good[r.id] for r in held) / len(held) > 0.97


def test_only_texts_and_training_labels_count(spark):
    """Other columns and the labels of held-out rows change nothing, nor does the order or the parting of rows."""
    rows, labels = corpus(160)
    first = sorted(tuple(r) for r in scored(spark, rows, labels))
    other = [(i, t, "fr", f"src{i}", 9) for i, t, *_ in rows]
    held = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y, 1 - t) for i, y, t in labels]
    random.Random(1).shuffle(other)
    docs = cases.clashing(spark, other).withColumn("score", F.lit(2)).withColumn("steps", F.lit("x")).repartition(3)
    assert sorted(tuple(r) for r in scored(spark, docs, held + [(10**9, 0, 0), (3, None, 0), (None, 0, 0)])) == first


@pytest.mark.parametrize("labels", [[], [(0, 1, 0), (2, 1, 0)], [(0, None, None)]])
def test_without_both_labels_all_scores_are_equal(spark, labels):
    found = scored(spark, cases.documents(1), labels)
    assert len({r.score for r in found}) == 1 and len(found) == len(cases.documents(1))


def test_odd_rows(spark):
    rows, labels = corpus(80)
    found = scored(spark, rows + [r for r in cases.documents(2)], labels, sample_rows=30)
    assert len(found) == 80 + len(cases.documents(2)) and all(r.score is not None for r in found)
    assert scored(spark, [], labels) == []


def test_statistics_of_odd_texts():
    texts = ["", " \n\t", "a", "é" * 1000, "word " * 100_000, "\x00", "#" * 5000]
    steps = q.statistics(texts)
    assert steps.shape == (len(texts), len(q.FEATURES)) and steps.min() >= 0 and steps.max() < q.STEPS
    assert (steps[0] == 0).all()
    alone = np.concatenate([q.statistics([t]) for t in texts])
    assert (alone == steps).all()

import math
import zlib
from collections import Counter

import cases
import numpy as np
import pytest

from ldspark.llm import attention, lm_scoring as lm


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    weights = {k: v.astype(np.float64) for k, v in attention.fresh(20, np.zeros(10), np.zeros(7)).items()}
    x = rng.integers(0, 20, (3, attention.WINDOW))
    y, second = rng.integers(0, 10, (3, attention.STRIDE)), rng.integers(0, 7, (3, attention.STRIDE))
    y[:, ::3] = 0
    valid = rng.random(y.shape) < 0.8
    found, _ = attention.gradients(weights, x, y, second, valid)
    for name, w in weights.items():
        at = (x[0, 20], 3) if name == "embed" else tuple(rng.integers(0, n) for n in w.shape)
        kept, step = w[at], 1e-5
        w[at] = kept + step
        more = attention.gradients(weights, x, y, second, valid)[1]
        w[at] = kept - step
        less = attention.gradients(weights, x, y, second, valid)[1]
        w[at] = kept
        assert found[name][at] == pytest.approx((more - less) / 2 / step, rel=1e-4, abs=1e-8)


def test_windows_score_every_position_once():
    lengths = np.array([1, 23, 24, 25, 100, 48])
    at, inside = attention.windows(lengths)
    scored = at[:, attention.CONTEXT :][inside[:, attention.CONTEXT :]]
    assert sorted(scored) == list(range(lengths.sum()))


def scores(texts, classes, weights):
    return lm.score_texts(np.concatenate(texts), np.array([len(t) for t in texts]), classes, weights)


def trained():
    counts = np.zeros(lm.IDS, np.int64)
    texts = lm.subwords([lm.words_of(r[1] or "") for r in cases.documents() if len(r[1] or "") < 10_000], lm.Words())
    for t in texts:
        counts += np.bincount(t, minlength=lm.IDS)
    classes = lm.Classes.from_counts(counts)
    adam = attention.Adam(classes.fresh_weights(), lm.RATE)
    before = sum(scores(texts, classes, adam.weights))
    for turn in range(3):
        lm.learn(texts, classes, adam, np.random.default_rng(turn))
    return texts, classes, adam.weights, before


def one_by_one(ids, classes, w):
    """The score of a text position by position, with plain loops over what each window shows."""
    total = 0.0
    for t in range(len(ids)):
        start = t // attention.STRIDE * attention.STRIDE - attention.CONTEXT
        seen = [classes.inputs[ids[p - 1]] if p > 0 else lm.INPUTS for p in range(start, t + 1)]
        h = np.array([w["embed"][s] + w["place"][i] for i, s in enumerate(seen)], np.float64)
        kv = h @ w["key_value"]
        q = h[-1] @ w["query"] / math.sqrt(attention.WIDTH)
        a = np.exp(kv[:, : attention.WIDTH] @ q)
        z = h[-1] + (a / a.sum()) @ kv[:, attention.WIDTH :] @ w["mixed"]
        logits = z @ w["out"] + w["out_bias"]
        c = classes.outputs[ids[t]]
        total += logits[c] - np.log(np.exp(logits).sum())
        if c == 0:
            logits = z @ w["other"] + w["other_bias"]
            total += logits[classes.others[ids[t]]] - np.log(np.exp(logits).sum())
        total += classes.within[ids[t]]
    return total / math.log(10)


def test_scores_equal_one_by_one_and_training_helps():
    texts, classes, weights, before = trained()
    found = scores(texts, classes, weights)
    assert sum(found) > before
    for i in (0, 5, len(texts) - 1):
        assert found[i] == pytest.approx(one_by_one(texts[i], classes, weights), rel=1e-4)


def test_probabilities_sum_to_one():
    _, classes, weights, _ = trained()
    after = lm.subwords([[b"tare", b"mo"]], lm.Words())[0][:3]
    each = [scores([np.array([*after, i], np.int32)], classes, weights)[0] for i in range(0, lm.IDS, 1)][:3000]
    prefix = scores([after], classes, weights)[0]
    assert 0 < sum(10 ** (s - prefix) for s in each) <= 1.001


def test_large_logits_do_not_overflow():
    classes = lm.Classes.from_counts(np.ones(lm.IDS, np.int64))
    weights = {k: v * 500 for k, v in classes.fresh_weights().items()}
    assert np.isfinite(scores(lm.subwords([[b"a", b"b"] * 30], lm.Words()), classes, weights)).all()


def base(rows):
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in rows]
    words = [lm.words_of(r[1] or "") + [None] for r in rows]
    counts = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    n, v = counts.total(), len(counts)
    return [
        (str(r[0]), h, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for r, h, ws in zip(rows, held, words)
    ]


@pytest.mark.parametrize("share", [2_000_000, 300])
def test_base_scores_equal_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(lm, "FREQUENT_SHARE", share)
    monkeypatch.setattr(lm, "COUNTED_WORDS", 50)
    rows = [r for r in cases.documents() if len(r[1] or "") < 45_000]
    found = lm.score_corpus(cases.clashing(spark, rows)).collect()
    told = sorted((str(r.id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found)
    for ours, plain in zip(told, sorted(base(rows)), strict=True):
        assert ours[:5] == plain[:5] and ours[5] == pytest.approx(plain[5], rel=1e-9)
    assert all(r.score < 0 for r in found)


def test_no_training_rows_and_empty_table(spark):
    only = [(i, "some words here", None, None, 0) for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    found = lm.score_corpus(cases.frame(spark, only)).collect()
    assert {(r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in found} == {(True, 4, 0, 0)}
    assert lm.score_corpus(cases.frame(spark, [])).count() == 0


def test_words_are_encoded_together_as_alone(monkeypatch):
    monkeypatch.setattr(lm, "KEPT_WORDS", 20)
    held = lm.Words()
    for row in cases.documents():
        words = lm.words_of(row[1] or "")[:300] + ["\u00a0x\u2003y\x1cz".encode(), b"'s", b"<|endoftext|>", b"12a.b"]
        alone = [i for w in words for i in lm.encoding().encode_ordinary(" " + w.decode())]
        assert lm.subwords([words, []], held)[0].tolist() == [*alone, lm.END_ID]


def test_parts_grow_with_texts(spark):
    rows = [(i, "word " * n, None, None, 0) for i, n in enumerate((0, 1, 100, 10_000))]
    parts = cases.frame(spark, rows).select("doc_id", *lm.a_part(lm.text_of("text"), 1)).orderBy("doc_id").collect()
    assert [len(p.text) for p in parts] == [0, 5, lm.LEAST_CHARACTERS, 50_000 // lm.TRAIN_SHARE]
    assert [(p.first, p.last) for p in parts[:2]] == [(True, True)] * 2


def test_every_word_of_a_training_text_is_learned_from(spark):
    codec = lm.encoding()
    raw = [codec.decode_single_token_bytes(i) for i in range(300, 6_000)]
    words = list(dict.fromkeys(w[1:].decode() for w in raw if w[:1] == b" " and w[1:].isalpha() and w[1:].isascii() and w[1:].islower()))[:600]
    text = " ".join(words)
    ids = lm.subwords([lm.words_of(text)], lm.Words())[0]
    assert len(ids) == 601
    classes = lm.Classes.from_counts(np.bincount(ids, minlength=lm.IDS))
    start = weights = classes.fresh_weights()
    for turn in range(lm.ROUNDS):
        weights = lm.train_round(cases.frame(spark, [(0, text, None, None, 0)]), classes, weights, turn)
    moved = (weights["embed"] != start["embed"]).any(axis=1)
    assert moved[classes.inputs[ids[:-1]]].all()


def test_rounds_tile_the_windows():
    lengths = np.array([1, 24, 25, 24, 1000, 7, 49])
    held = np.concatenate([lm.of_round(lengths, turn, 3) for turn in range(3)])
    assert sorted(held) == list(range(len(attention.windows(lengths)[0])))


def test_rounds_read_stored_ids_as_they_do_texts(spark):
    rows = [r for r in cases.documents() if len(r[1] or "") < 10_000]
    texts = cases.frame(spark, rows).coalesce(1)
    told = [lm.words_of(r.text or "") for r in texts.select("text").collect()]
    ids = lm.subwords(told, lm.Words())
    stored = spark.createDataFrame([(bytearray(i.astype("<u2").tobytes()),) for i in ids], "ids binary").coalesce(1)
    counts = np.bincount(np.concatenate(ids), minlength=lm.IDS)
    assert (lm.count_subwords(stored) == counts).all()
    classes = lm.Classes.from_counts(counts)
    start = classes.fresh_weights()
    plain, read = lm.train_round(texts, classes, start, 0), lm.train_round(stored, classes, start, 0, ids_col="ids")
    for name in start:
        assert (plain[name] != start[name]).any()
        assert read[name] == pytest.approx(plain[name], rel=1e-6, abs=1e-7)


def test_blocks_do_not_change_gradients_or_scores(monkeypatch):
    rng = np.random.default_rng(2)
    weights = attention.fresh(20, np.zeros(10), np.zeros(7))
    x = rng.integers(0, 20, (5, attention.WINDOW))
    y, second = rng.integers(0, 10, (5, attention.STRIDE)), rng.integers(0, 7, (5, attention.STRIDE))
    valid = rng.random(y.shape) < 0.8
    made = []
    for rows in (7, 10_000):
        monkeypatch.setattr(attention, "BLOCK", rows)
        made.append((attention.gradients(weights, x, y, second, valid), attention.log_probabilities(weights, x, y, second)))
    (few, loss), found = made[0]
    (whole, all_loss), told = made[1]
    assert loss == pytest.approx(all_loss, rel=1e-5) and found == pytest.approx(told, rel=1e-5)
    for name in whole:
        assert few[name] == pytest.approx(whole[name], rel=1e-4, abs=1e-6)

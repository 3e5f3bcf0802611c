import collections
import hashlib
import random

import cases
import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ldspark.llm import token_alignment as t

A = Tokenizer.from_file(public_tokenizers.path(t.A_FILE))
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=public_tokenizers.path(t.B_FILE))
LETTERS = t.byte_letters()
ALPHABET = list("ab cd \n\t\r  \x0b\x85 　é世🙂𓀀€ß'’.,!;)}{>()1234\x1c\x1f\x00½ª") + [
    "  ", "\n\n", "<0x41>", "<s>", "</s>", "'s", " ▁", "the", "ing", " the", "\r\n", ";\r", "<|endoftext|>", "%%%", "!!", "_", "É",
]


def a_bytes(i):
    return bytes(LETTERS[c] for c in A.id_to_token(i))


def b_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def whole(text):
    """Groups and linked pairs of a whole text, by its bytes and every pair of tokens."""
    if not text:
        return 0, 0, 0, 0, "", {}
    raw = (" " + text).encode()
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    left, right = [a_bytes(i) for i in a], [b_bytes(i) for i in b]
    if b"".join(left) != raw or b"".join(right) != raw:
        return 0, 0, 0, 0, "", {}
    ends = [np.cumsum([len(x) for x in side]).tolist() for side in (left, right)]
    starts = [[0, *side[:-1]] for side in ends]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    groups = [
        "|".join(",".join(str(x) for x, e in zip(ids, side) if low < e <= high) for ids, side in ((a, ends[0]), (b, ends[1])))
        for low, high in zip([0, *cuts], cuts)
    ]
    pairs = collections.Counter(
        (a[i], b[j])
        for i in range(len(a))
        for j in range(len(b))
        if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]
    )
    return len(a), len(b), len(groups), sum(pairs.values()), ";".join(groups), pairs


@pytest.mark.parametrize("kept", [5, 200_000])
def test_equals_whole_texts_by_bytes(kept):
    """Also with words forgotten all the time, and over texts that share words."""
    rng = random.Random(kept)
    aligner = t.Aligner(public_tokenizers.path(t.A_FILE), public_tokenizers.path(t.B_FILE), kept)
    for _ in range(300):
        texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 14))) for _ in range(6)]
        for text, found in zip(texts, aligner.texts(texts)):
            *counts, pairs = whole(text)
            assert tuple(found[:5]) == tuple(counts), text
            codes = dict(zip(found[5].tolist(), found[6].tolist()))
            assert codes == {x << t.B_BITS | y: n for (x, y), n in pairs.items()}, text


def test_long_word_and_long_white_space():
    aligner = t.aligner(public_tokenizers.path(t.A_FILE), public_tokenizers.path(t.B_FILE))
    for text in ("x" * 20_000, " " * 5_000 + "a", "世" * 3_000, "ab" * 30 + "%" * 2_000, "\n" * 2_000, "é" * 999 + " "):
        (found,) = aligner.texts([text])
        raw = b" " + text.encode()
        groups = [tuple([int(i) for i in side.split(",")] for side in g.split("|")) for g in found[4].split(";")]
        assert b"".join(a_bytes(i) for a, _ in groups for i in a) == raw
        assert b"".join(b_bytes(i) for _, b in groups for i in b) == raw
        assert [i for a, _ in groups for i in a] == A.encode(" " + text, add_special_tokens=False).ids
        assert [i for _, b in groups for i in b] == B.encode(text)
        assert all(sum(len(a_bytes(i)) for i in a) == sum(len(b_bytes(i)) for i in b) for a, b in groups)
    assert max(map(len, [*aligner.words, *aligner.parts])) <= t.LONGEST_KEPT, "long words are not kept"


def expected(texts):
    aligned = [whole(text) for text in texts]
    count = collections.Counter(pair for row in aligned for pair in row[5])
    most = collections.defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [
        (
            *row[:4],
            sum(n for pair, n in row[5].items() if count[pair] == most[pair[0]]),
            sum(n * count[pair] for pair, n in row[5].items()),
            hashlib.sha256(row[4].encode()).hexdigest() if row[0] else "",
        )
        for row in aligned
    ]


def test_corpus_equals_brute_force(spark):
    rows = [r for r in cases.documents(3) if r[1] is None or len(r[1]) < 3_000]
    rows += [(900, "with ▁ in it", None, None, None), (901, "<|endoftext|> <s> a", None, None, None)]
    found = t.align_corpus(cases.clashing(spark, rows).repartition(3)).collect()
    got = collections.Counter(tuple(r) for r in found)
    assert got == collections.Counter((r[0], *e) for r, e in zip(rows, expected([r[1] for r in rows])))


def test_rare_pairs_are_joined_all_the_same(spark):
    """With a bound that lets no pair be common, one that lets all be, and one between them."""
    rows = [(i, text, None, None, None) for i, text in enumerate(["the cat sat", "the dog", "a cat, a dog", "", "the the the"])]
    stored = t.write_scratch(
        t.align_documents(cases.frame(spark, rows)).withColumn("place", t.F.col("id")), "aligned"
    )
    counts = t.pair_counts(stored)
    sums = [sorted(map(tuple, t.link_sums(stored, "place", counts, n).collect())) for n in (1, 12, 10**9)]
    assert sums[0] == sums[1] == sums[2] and len(sums[0]) == 4


def test_empty_table(spark):
    assert t.align_corpus(cases.frame(spark, [])).collect() == []

import collections
import zlib

import cases
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ldspark.llm import packing


def ids_of(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for t in texts]


def check(pieces, ids):
    """Every id in one piece, checksums right, sequences without gaps and of allowed length."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for doc, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids[doc])
            assert p.ids_crc32 == zlib.crc32(ids[doc][at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids[doc])
    padding = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding == 0


def test_pieces_hold_all_ids_once(spark):
    rows = [r for r in cases.documents() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    ids = dict(zip([r[0] for r in rows], ids_of([r[1] for r in rows])))
    check(packing.pack(cases.clashing(spark, rows).repartition(3)).collect(), ids)


def test_repeated_and_null_ids(spark):
    rows = cases.documents()
    pieces = packing.pack(cases.frame(spark, rows)).collect()
    assert sum(p.length for p in pieces) == sum(map(len, ids_of([r[1] for r in rows])))


def test_tiers_and_steps():
    packer = packing.Packer(waiting=2)
    rng = np.random.default_rng(0)
    out = []
    for doc in range(400):
        out += packer.add(doc, np.arange(rng.integers(1, 300), dtype="<u4"))
    out += packer.finish()
    steps, sequences = collections.Counter(), collections.Counter()
    for _, _, length, _, _, sequence, _, tier, group in out:
        sequences[sequence, tier, group] += length
    assert {t for _, t, _ in sequences} >= {128, 256, 512}
    for (_, tier, group), length in sequences.items():
        assert length == tier
        steps[group] += tier
    assert max(steps.values()) <= packing.STEP_TOKENS


def test_empty_table(spark):
    assert packing.pack(cases.frame(spark, [])).count() == 0


def test_long_runs_of_one_kind(spark):
    """White space, letters, marks and a mixture, a million characters each; the fast reader gives up on some."""
    n = 1_000_000
    texts = [" " * n + "a", "\t" * n, "\n" * n + "b", "x" * n, "%" * n, " \n\t" * (n // 3) + "z <|endoftext|>"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    check(packing.pack(cases.frame(spark, rows).repartition(3)).collect(), dict(enumerate(ids_of(texts))))

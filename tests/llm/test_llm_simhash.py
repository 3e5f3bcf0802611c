import random

import cases
import pytest
import xxhash
from pyspark.sql import functions as F

from ldspark.llm import simhash_dedup as s
from ldspark.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def near(fps):
    fps = sorted(set(fps))
    return [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]


def test_fingerprint_equals_the_long_way(monkeypatch):
    monkeypatch.setattr(s, "_CHUNK", 7)
    for row in cases.documents():
        assert s.fingerprint(row[1] or "") == plain_fingerprint(row[1])


@pytest.mark.parametrize("bucket_rows", [512, 1])
def test_components_equal_brute_force(spark, bucket_rows):
    rng = random.Random(3)
    fps = []
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(12):
            fp = centre
            for bit in rng.sample(range(64) if rng.random() < 0.5 else range(32), rng.randint(0, 4)):
                fp ^= 1 << bit
            fps.append(fp)
    fps = sorted({signed(f) for f in fps})
    links = s.links(spark.createDataFrame([(f,) for f in fps], "fp BIGINT"), bucket_rows)
    found = {r.node: r.root for r in components(links).collect()}
    expected = cases.groups(near(fps), fps)
    assert {f: found.get(f, f) for f in fps} == expected
    assert len(set(expected.values())) < len(fps)


def test_documents_equal_brute_force(spark):
    rows = cases.documents()
    fps = [signed(plain_fingerprint(r[1])) for r in rows]
    root = cases.groups(near(fps), set(fps))
    least = {}
    for row, fp in zip(rows, fps):
        if row[0] is not None:
            least[root[fp]] = min(row[0], least.get(root[fp], row[0]))
    found = s.near_duplicates(cases.clashing(spark, rows)).collect()
    assert sorted((str(r.id), r.fp, str(r.component_id)) for r in found) == sorted(
        (str(r[0]), fp, str(least.get(root[fp]))) for r, fp in zip(rows, fps)
    )
    docs = cases.clashing(spark, rows)
    kept = s.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(root.values()))
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(least.values())


def test_empty_tables(spark):
    assert s.near_duplicates(cases.frame(spark, [])).count() == 0
    assert s.drop_near_duplicates(cases.frame(spark, [])).count() == 0
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (200, 201), (201, 200)]
    edges = spark.createDataFrame(links, "a BIGINT, b BIGINT")
    found = {r.node: r.root for r in components(edges).collect()}
    nodes = {n for pair in links for n in pair}
    assert found == cases.groups(links, nodes)

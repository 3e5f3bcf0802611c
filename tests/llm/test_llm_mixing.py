import hashlib
import os
import random

import cases
import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

from ldspark.llm import mixing, queries

SF = "/root/testdata/sf0.001"


def levels(weights):
    return [mixing.Level(n, F.col(n), w) for n, w in zip(("a", "b", "c"), weights)]


def water(budget, children):
    """Even shares by weight, none above its capacity, as fractions."""
    open_ = {k: (w, c) for k, (w, c) in children.items()}
    given = dict.fromkeys(children, 0.0)
    while open_ and budget > 1e-9:
        total = sum(w for w, _ in open_.values())
        full = {k: c for k, (w, c) in open_.items() if c * total <= budget * w}
        if not full:
            for k, (w, _) in open_.items():
                given[k] = budget * w / total
            break
        for k, c in full.items():
            given[k] = c
            budget -= c
            del open_[k]
    return given


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_water_filling(spark, seed):
    rng = random.Random(seed)
    leaves = [(a, b, c, rng.choice([0, 1, 50, 1000, 10**9])) for a in "xyz" for b in "pq" for c in "mn" if rng.random() < 0.9]
    weights = [{"x": 5, "y": 2}, {"p": 3}, {"m": 0} if seed == 3 else {"n": 7}]
    epochs = 2
    chosen = lambda i, v: weights[i].get(v, 1)
    capacity = {(a, b, c): n * epochs if chosen(2, c) else 0 for a, b, c, n in leaves}
    budget = int(sum(capacity.values()) * 0.6) + 3

    def below(node):
        return sum(v for k, v in capacity.items() if k[: len(node)] == node)

    shares, nodes = {(): min(budget, below(()))}, [()]
    for i in range(3):
        nodes = sorted({k[: i + 1] for k in capacity})
        for parent in sorted({n[:-1] for n in nodes}):
            family = {n: (max(1, chosen(i, n[-1])), below(n)) for n in nodes if n[:-1] == parent}
            shares |= water(shares[parent], family)
    df = spark.createDataFrame(leaves, "a STRING, b STRING, c STRING, tokens BIGINT")
    found = {(r.a, r.b, r.c): r.target for r in mixing.leaf_targets(df, levels(weights), budget, epochs).collect()}
    assert sum(found.values()) == min(budget, sum(capacity.values()))
    for leaf, target in found.items():
        assert target <= capacity[leaf] and abs(target - shares[leaf]) <= 3


def test_prefix_and_epochs(spark):
    rows = cases.documents()
    docs = cases.clashing(spark, rows)
    tree = [mixing.Level("mix_lang", F.col("lang"), {"en": 3}), mixing.Level("mix_source", F.col("source"))]
    found = mixing.mix(docs, tree, budget_percent=80, max_epochs=3, seed=5, bucket_digits=1).collect()
    words = {}
    for r in rows:
        words.setdefault((r[2] or "", r[3] or ""), []).append((r[0], len((r[1] or "").encode().split())))
    taken = {}
    for r in found:
        taken.setdefault((r.mix_lang, r.mix_source), []).append(r)
    assert taken
    for leaf, own in taken.items():
        target, total = own[0].target, sum(n for _, n in words[leaf])
        whole, rest = divmod(target, total)
        key = lambda i: hashlib.sha256(f"5:{whole}:{'' if i is None else i}".encode()).hexdigest()
        expected, before, last = [], 0, None
        for doc, n in sorted(words[leaf], key=lambda x: key(x[0])):
            if before < rest or key(doc) == last:
                expected.append(doc)
                last = key(doc)
            before += n
        assert sorted(map(str, (r.id for r in own if r.epoch == whole))) == sorted(map(str, expected))
        for epoch in range(whole):
            assert sum(r.epoch == epoch for r in own) == len(words[leaf])
        assert max(r.epoch for r in own) <= 2


def test_documents_keep_their_columns(spark):
    docs = cases.clashing(spark, cases.documents())
    tree = [mixing.Level("mix_lang", F.col("lang"))]
    mixed = mixing.mixed_documents(docs, tree, budget_percent=50)
    assert mixed.columns == docs.columns and 0 < mixed.count() < docs.count()


def test_empty_table_and_no_budget(spark):
    tree = [mixing.Level("mix_lang", F.col("lang"))]
    assert mixing.mix(cases.frame(spark, []), tree, budget_percent=50).count() == 0
    assert mixing.mix(cases.frame(spark, cases.documents()), tree, budget=0).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), name, queries.QUERIES[name], queries.ORACLE[name], SF) is None

import hashlib
import os
import re

import cases
import corpus_pipeline
import pytest
import test_llm_packing as packing_tests
import test_llm_quality_rules as rules_tests
import test_llm_simhash as simhash_tests
from ldspark.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def good(text):
    n, chars, symbols, lines, dup, repeat, distinct, stops, lettered = rules_tests.plain(text)
    return (
        n >= 50
        and 100 * repeat <= 50 * n
        and 100 * symbols <= 10 * n
        and 100 * dup <= 40 * lines
        and 300 * n <= 100 * chars <= 1000 * n
        and 100 * stops >= 2 * n
        and 100 * distinct >= 5 * n
        and 100 * lettered >= 70 * n
    )


def mixed(rows):
    """Row identifiers of the mixture, by shares worked out the long way."""
    levels = [queries.DOMAIN_WEIGHTS, queries.LANG_WEIGHTS, queries.SOURCE_WEIGHTS]
    leaves = {}
    for r in rows:
        number = re.search(r"[0-9]+$", r.source or "")
        leaf = (f"d{int(number.group()) % 4}" if number else "", r.lang or "", r.source or "")
        leaves.setdefault(leaf, []).append((r.doc_id, len((r.text or "").encode().split())))
    capacity = {leaf: sum(n for _, n in docs) for leaf, docs in leaves.items()}

    def deal(budget, parent):
        if len(parent) == 3:
            return {parent: budget}
        names = sorted({leaf[: len(parent) + 1] for leaf in leaves if leaf[: len(parent)] == parent})
        children = [(n, levels[len(parent)].get(n[-1], 1), sum(c for k, c in capacity.items() if k[: len(n)] == n)) for n in names]
        children.sort(key=lambda c: (c[2] / c[1], c[0][-1]))
        targets, left = {}, budget
        for i, (name, weight, has) in enumerate(children):
            rest = sum(w for _, w, _ in children[i:])
            if has * rest <= left * weight:
                targets[name], left = has, left - has
                continue
            upto = 0
            for n, w, _ in children[i:]:
                targets[n] = left * (upto + w) // rest - left * upto // rest
                upto += w
            break
        return {k: v for n, t in targets.items() for k, v in deal(t, n).items()}

    taken = []
    for leaf, target in deal(sum(capacity.values()) * corpus_pipeline.BUDGET_PERCENT // 100, ()).items():
        whole, rest = divmod(target, capacity[leaf])
        before = 0
        key = lambda d: hashlib.sha256(f"{queries.MIX_SEED}:{whole}:{d[0]}".encode()).hexdigest()
        for doc in sorted(leaves[leaf], key=key):
            taken += [doc[0]] * (whole + (before < rest))
            before += doc[1]
    return taken


def test_stages_and_rows_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, docs.collect()
    rows = [r for r in rows if good(r.text)]
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r)
    exact = list(first.values())
    fps = {r.doc_id: simhash_tests.signed(simhash_tests.plain_fingerprint(r.text)) for r in exact}
    root = cases.groups(simhash_tests.near(fps.values()), set(fps.values()))
    kept = {}
    for r in sorted(exact, key=lambda r: r.doc_id):
        kept.setdefault(root[fps[r.doc_id]], r)
    near = list(kept.values())
    expected = [rows, exact, near, None]
    assert len(docs.collect()) > len(rows) > len(exact) >= len(near)
    for (name, stage), told in zip(corpus_pipeline.STAGES[:-1], expected):
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        ids = [r.doc_id for r in told] if told is not None else mixed(near)
        assert sorted(r.doc_id for r in docs.collect()) == sorted(ids), name
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = dict(zip(texts, packing_tests.ids_of(texts.values())))
    pieces = corpus_pipeline.run(spark, SF).withColumnRenamed("doc_id", "id").collect()
    packing_tests.check(pieces, ids)


def test_odd_rows_pass_through_every_stage(spark):
    docs = cases.clashing(spark, cases.documents())
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, rows, SF).collect()


def test_entry_has_the_queries_of_this_package():
    import __spark_entry__

    assert __spark_entry__.OPTIONAL_ERROR is None
    assert {"pipeline", *queries.QUERIES} <= set(__spark_entry__.queries())

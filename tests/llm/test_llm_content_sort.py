import collections
import hashlib
import re

import cases
import pytest
from pyspark.sql import functions as F

from ldspark.llm.content_sort import content_sort, drop_copies


def expected(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    ids, sizes = collections.defaultdict(list), collections.Counter(norm)
    for row, text in zip(rows, norm):
        if row[0] is not None:
            ids[text].append(row[0])
    return collections.Counter(
        (r[0], min(ids[t]) if ids[t] else None, sizes[t], hashlib.sha256(t.encode()).hexdigest()) for r, t in zip(rows, norm)
    )


@pytest.mark.parametrize("group_rows", [1000, 2])
def test_groups_equal_brute_force(spark, group_rows):
    rows = cases.documents()
    found = content_sort(cases.clashing(spark, rows), group_rows=group_rows).drop("row").collect()
    assert collections.Counter((r.id, r.keep_id, r.group_size, r.text_sha256) for r in found) == expected(rows)
    kept = collections.Counter(r.text_sha256 for r in found if r.kept)
    assert set(kept.values()) == {1} and set(kept) == {r.text_sha256 for r in found}
    assert all(r.id == r.keep_id for r in found if r.kept)


def test_hot_group_is_spread_and_whole(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.concat(F.lit("t"), "id")).alias("text")
    )
    found = content_sort(docs, group_rows=10)
    assert found.where("group_size = 134 AND keep_id = 0").count() == 134
    assert found.where("kept").count() == 267


def test_kept_rows_keep_their_columns(spark):
    docs = cases.clashing(spark, cases.documents())
    kept = drop_copies(docs)
    assert kept.schema.fieldNames() == docs.schema.fieldNames()
    assert kept.where("failed <> 9").count() == 0


def test_empty_table(spark):
    assert content_sort(cases.frame(spark, [])).count() == 0


def test_no_python_and_one_text_shuffle(spark):
    plan = content_sort(cases.frame(spark, cases.documents()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("rangepartitioning") == 1

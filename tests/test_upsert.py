import pytest

from helpers import plan, rows
from ldspark.operators import (
    compact,
    latest_by_id,
    read_latest,
    read_latest_documents,
    split_by_id,
    upsert_by_id,
    write_batch,
    write_document_batch,
)

SCHEMA = "id STRING, at INT, v STRING"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_the_greatest_row_wins_and_ties_go_by_value(spark):
    data = [("a", 1, "x"), ("a", 2, "b"), ("a", 2, "c"), ("b", 1, "y")]
    assert rows(latest_by_id(frame(spark, data), "id", ["at"])) == [("a", 2, "c"), ("b", 1, "y")]


def test_rows_without_an_id_are_returned_or_an_error(spark):
    data = [("a", 1, "x"), (None, 9, "no id")]
    named, unnamed = split_by_id(frame(spark, data), "id")
    assert rows(named) == data[:1] and rows(unnamed) == data[1:]
    with pytest.raises(Exception, match="without 'id'"):
        latest_by_id(frame(spark, data), "id", ["at"]).collect()


def test_without_an_order_two_rows_for_one_id_are_an_error(spark):
    assert rows(latest_by_id(frame(spark, [("a", 1, "x")]), "id")) == [("a", 1, "x")]
    with pytest.raises(Exception, match="several rows for id a"):
        latest_by_id(frame(spark, [("a", 1, "x"), ("a", 2, "y")]), "id").collect()


def test_upsert_replaces_whole_rows(spark):
    target = frame(spark, [("a", 1, "old"), ("b", 1, "stay")])
    updates = frame(spark, [("a", 2, None), ("c", 1, "new"), ("c", 2, "newer")])
    want = [("a", 2, None), ("b", 1, "stay"), ("c", 2, "newer")]
    once = upsert_by_id(target, updates, "id", ["at"])
    assert rows(once) == want
    assert rows(upsert_by_id(once, updates, "id", ["at"])) == want
    assert rows(upsert_by_id(target, None, "id")) == rows(target)
    assert rows(upsert_by_id(target, updates.limit(0), "id")) == rows(target)


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/store"
    first = frame(spark, [("a", 1, "x"), ("b", 5, "late"), ("a", 2, "y")])
    second = frame(spark, [("b", 3, "early"), ("c", 1, "z")])
    for batch_id, batch in ((0, first), (1, second), (1, second), (0, first)):
        write_batch(batch, path, batch_id, "id", ["at"])
    got = read_latest(spark.read.parquet(path), "id", ["at"])
    assert rows(got) == [("a", 2, "y"), ("b", 5, "late"), ("c", 1, "z")]
    assert got.columns == ["id", "at", "v"]


def test_columns_without_an_order_are_named(spark):
    df = spark.sql("SELECT 'a' AS id, map('k', 1) AS m")
    with pytest.raises(ValueError, match="JSON text"):
        latest_by_id(df, "id")


def documents(spark, data):
    return spark.createDataFrame(
        [(e, p, n, f"{e}#{p}", v) for e, p, n, v in data], "entity STRING, part INT, parts INT, key STRING, value STRING"
    )


def test_documents_are_replaced_as_a_whole(spark, tmp_path):
    path, fresh = f"{tmp_path}/store", f"{tmp_path}/fresh"
    write_document_batch(documents(spark, [("a", 0, 2, "x"), ("a", 1, 2, "y"), ("b", 0, 1, "z")]), path, 0, "r1", "2020")
    write_document_batch(documents(spark, [("a", 0, 1, "small")]), path, 0, "r2", "2021")
    current = read_latest_documents(spark.read.parquet(path))
    want = [("a#0", "small"), ("b#0", "z")]
    assert rows(current.select("key", "value")) == want
    compact(current, fresh)
    assert rows(read_latest_documents(spark.read.parquet(fresh)).select("key", "value")) == want
    write_document_batch(documents(spark, [("b", 0, 2, "p"), ("b", 1, 2, "q")]), fresh, 0, "r3", "2022")
    later = read_latest_documents(spark.read.parquet(fresh)).select("key", "value")
    assert rows(later) == [("a#0", "small"), ("b#0", "p"), ("b#1", "q")]


def test_documents_of_one_batch_are_read_where_they_lie(spark, tmp_path):
    """Only entities of several batches are compared; a document without an entity is no document."""
    path = f"{tmp_path}/store"
    first = [(f"e{n}", 0, 1, "old") for n in range(50)] + [(None, 0, 1, "lost")]
    write_document_batch(documents(spark, first), path, 0, "r1", "2020")
    alone = read_latest_documents(spark.read.parquet(path))
    assert "Exchange" not in plan(alone)
    assert rows(alone.select("entity", "value")) == sorted((f"e{n}", "old") for n in range(50))
    write_document_batch(documents(spark, [("e7", 0, 2, "a"), ("e7", 1, 2, "b"), ("new", 0, 1, "c")]), path, 1, "r1", "2020")
    both = read_latest_documents(spark.read.parquet(path))
    assert "LeftAnti" in plan(both)
    want = [(f"e{n}", 0, "old") for n in range(50) if n != 7] + [("e7", 0, "a"), ("e7", 1, "b"), ("new", 0, "c")]
    assert rows(both.select("entity", "part", "value")) == sorted(want, key=repr)
    assert both.columns == alone.columns == ["entity", "part", "parts", "key", "value", "run_started", "batch_seq"]


def test_entities_that_share_a_bin_are_told_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ldspark.operators.upsert.KEY_BINS", 1)
    path = f"{tmp_path}/store"
    write_document_batch(documents(spark, [("a", 0, 1, "x"), ("b", 0, 1, "y")]), path, 0, "r1", "2020")
    write_document_batch(documents(spark, [("c", 0, 1, "z")]), path, 1, "r1", "2020")
    every = read_latest_documents(spark.read.parquet(path)).select("key", "value")
    assert rows(every) == [("a#0", "x"), ("b#0", "y"), ("c#0", "z")]


def test_runs_that_number_their_batches_alike_keep_each_other(spark, tmp_path):
    path = f"{tmp_path}/store"
    write_batch(frame(spark, [("a", 1, "x")]), path, 0, "id", ["at"], "r1")
    write_batch(frame(spark, [("b", 1, "y")]), path, 0, "id", ["at"], "r2")
    assert rows(read_latest(spark.read.parquet(path), "id", ["at"])) == [("a", 1, "x"), ("b", 1, "y")]

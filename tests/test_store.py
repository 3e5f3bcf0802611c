"""Keyed stores in buckets, and aliases, by versions."""

import os
import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ldspark import files
from ldspark.operators import store as st, versions as ve
from ldspark.operators.upsert import upsert_by_id

SCHEMA = "id STRING, v STRING, at BIGINT"


def frame(spark, *some):
    return spark.createDataFrame([(k, v, at) for k, v, at in some], SCHEMA)


def data_files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{path}/rows") for f in names if f.endswith(".parquet")}


def test_upsert_touches_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "s")
    first = st.create_store(frame(spark, *[(f"k{i}", f"v{i}", 0) for i in range(80)]), path, "id", buckets=16)
    before = data_files(path)
    updates = frame(spark, ("k3", "é\t\n\"\\", 1), ("k3", "\U0001f600", 2), ("new", None, 1))
    second = st.upsert_store(first, updates, order_by=["at"])
    touched = set(first.buckets.touched(updates))
    for bucket, folder in first.buckets.folders.items():
        same = second.buckets.folders[bucket] == folder
        assert same == (bucket not in touched)
    assert before < data_files(path), "files that were there stay, with their names"
    assert rows(second.read()) == rows(upsert_by_id(first.read(), updates, "id", ["at"]))
    assert first.read().count() == 80 and st.open_store(spark, path).version == 2
    again = st.upsert_store(second, updates, order_by=["at"])
    assert rows(again.read()) == rows(second.read()), "the same updates again change nothing"


def test_untouched_buckets_are_not_read(spark, tmp_path):
    path = str(tmp_path / "s")
    store = st.create_store(frame(spark, *[(f"k{i}", "v", 0) for i in range(80)]), path, "id", buckets=16)
    key = frame(spark, ("k5", "new", 1))
    (mine,) = store.buckets.touched(key)
    for bucket, folder in store.buckets.folders.items():
        if bucket != mine:
            shutil.rmtree(f"{store.buckets.path}/{folder}/_bucket={bucket}")
    assert rows(store.lookup(key)) == [("k5", "v", 0)]
    new = st.upsert_store(store, key)
    assert rows(new.lookup(key.select("id"))) == [("k5", "new", 1)]


def test_delete_and_nothing_to_do(spark, tmp_path):
    path = str(tmp_path / "s")
    store = st.create_store(frame(spark, ("a", "x", 0), ("b", "y", 0)), path, "id", buckets=4)
    assert st.upsert_store(store, frame(spark)) is store
    assert st.delete_from_store(store, frame(spark, ("zz", None, 0))) is store
    less = st.delete_from_store(store, frame(spark, ("a", None, 0), ("a", None, 0)))
    none = st.delete_from_store(less, frame(spark, ("b", None, 0)))
    assert rows(less.read()) == [("b", "y", 0)] and none.read().isEmpty() and none.buckets.folders == {}
    back = st.upsert_store(none, frame(spark, ("a", "again", 1)))
    assert rows(back.read()) == [("a", "again", 1)]


def test_odd_rows_of_a_store(spark, tmp_path):
    with pytest.raises(Exception, match="a row without 'id'"):
        st.create_store(frame(spark, (None, "x", 0)), str(tmp_path / "n"), "id")
    with pytest.raises(Exception, match="several rows for id"):
        st.create_store(frame(spark, ("a", "x", 0), ("a", "y", 1)), str(tmp_path / "t"), "id")
    empty = st.create_store(frame(spark), str(tmp_path / "e"), "id", buckets=4)
    assert empty.read().isEmpty() and rows(st.upsert_store(empty, frame(spark, ("a", "x", 0))).read()) == [("a", "x", 0)]
    with pytest.raises(ve.Conflict):
        st.create_store(frame(spark, ("a", "x", 0)), str(tmp_path / "e"), "id")
    wide = frame(spark, ("a", "x", 0)).withColumns({"_bucket2": F.lit(1), "key": F.lit("k")})
    assert rows(st.create_store(wide, str(tmp_path / "w"), "id", buckets=2).read()) == [("a", "x", 0, 1, "k")]


def test_one_of_two_writers_wins_and_readers_see_no_change(spark, tmp_path):
    path = str(tmp_path / "s")
    store = st.create_store(frame(spark, ("a", "old", 0)), path, "id", buckets=2)
    reader = store.read()

    def write(value):
        try:
            return st.upsert_store(store, frame(spark, ("a", value, 1)))
        except ve.Conflict:
            return None

    with ThreadPoolExecutor(2) as pool:
        done = [s for s in pool.map(write, ["one", "two"]) if s is not None]
    assert len(done) == 1 and ve.versions(spark, path) == [1, 2]
    assert rows(st.open_store(spark, path).read()) == rows(done[0].read())
    assert rows(reader) == [("a", "old", 0)] and rows(st.open_store(spark, path, 1).read()) == [("a", "old", 0)]
    assert len(st.expire_store(spark, path)) == 2, "the old rows and those of the writer that lost"
    assert rows(st.open_store(spark, path).read()) == rows(done[0].read())


def test_alias_outlives_its_readers_and_goes_back(spark, tmp_path):
    a, b, alias = (str(tmp_path / n) for n in ("a", "b", "alias"))
    spark.createDataFrame([(1, "x")], "n INT, t STRING").write.parquet(a)
    spark.createDataFrame([(2,)], "n INT").write.parquet(b)
    assert ve.set_alias(spark, alias, [a]) == 1
    reader = ve.open_alias(spark, alias)
    assert ve.set_alias(spark, alias, [b, a], based_on=1) == 2
    with pytest.raises(ve.Conflict):
        ve.set_alias(spark, alias, [b], based_on=1)
    assert rows(reader) == [(1, "x")]
    assert rows(ve.open_alias(spark, alias).select("n", "t")) == [(1, "x"), (2, None)]
    assert ve.restore_alias(spark, alias, 1) == 3 and rows(ve.open_alias(spark, alias)) == [(1, "x")]
    with pytest.raises(FileNotFoundError):
        ve.open_alias(spark, alias, 9)
    with pytest.raises(FileNotFoundError):
        ve.open_alias(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        ve.set_alias(spark, alias, [])


def test_a_file_is_there_as_a_whole_or_not(spark, tmp_path):
    path = str(tmp_path / "f" / "one.json")
    assert files.write_new(spark, path, "é\U0001f600\n") and not files.write_new(spark, path, "other")
    assert files.read_text(spark, path) == "é\U0001f600\n"
    assert files.names(spark, str(tmp_path / "f")) in (["one.json"], [".one.json.crc", "one.json"])

import json
import os

import pytest

from helpers import rows
from ldspark import Model, Node, session, streaming
from ldspark.operators import apply_model, read_latest, read_latest_documents
from ldspark.session import scratch_root

SCHEMA = "id BIGINT, name STRING, at BIGINT"
MODEL = Model("u:", "r", [Node("r", "R", "r/{id}", {"name": "name"})])


def folder(spark, tmp_path, batches):
    path = tmp_path / "in"
    path.mkdir()
    for n, batch in enumerate(batches):
        (path / f"{n}.json").write_text("\n".join(json.dumps(r) for r in batch), encoding="utf-8")
    return str(path)


BATCHES = [
    [{"id": 1, "name": "a", "at": 5}, {"id": 2, "name": "😀", "at": 1}],
    [{"id": 1, "name": "late", "at": 3}, {"id": 1, "name": "later", "at": 4}],
    [{"id": 3, "name": None, "at": 1}],
]


def test_mapping_a_stream_equals_mapping_a_batch(spark, tmp_path):
    path = folder(spark, tmp_path, BATCHES)
    out = f"{tmp_path}/out"
    stream = streaming.read_json_stream(spark, path, SCHEMA, files_per_batch=1)
    streaming.write_stream(
        apply_model(stream, MODEL), "parquet", f"{tmp_path}/c", {"path": out}, available_now=True
    ).awaitTermination()
    batch = apply_model(spark.read.schema(SCHEMA).json(path), MODEL)
    assert rows(spark.read.parquet(out)) == rows(batch)


def test_upsert_over_batches_keeps_the_latest(spark, tmp_path):
    path, out = folder(spark, tmp_path, BATCHES), f"{tmp_path}/store"
    for checkpoint in ("c1", "c2"):  # the second run replays every batch
        stream = streaming.read_json_stream(spark, path, SCHEMA, files_per_batch=1)
        streaming.upsert_stream(
            stream, out, f"{tmp_path}/{checkpoint}", "id", ["at"], available_now=True
        ).awaitTermination()
    got = read_latest(spark.read.parquet(out), "id", ["at"]).select("id", "name")
    assert rows(got) == sorted([(1, "a"), (2, "😀"), (3, None)], key=repr)


def test_streams_with_their_own_checkpoints_keep_each_other(spark, tmp_path):
    store = f"{tmp_path}/store"
    for n, batch in enumerate(BATCHES[:1] + BATCHES[2:]):
        (tmp_path / str(n)).mkdir()
        path = folder(spark, tmp_path / str(n), [batch])
        stream = streaming.read_json_stream(spark, path, SCHEMA)
        streaming.upsert_stream(stream, store, f"{tmp_path}/c{n}", "id", ["at"], available_now=True).awaitTermination()
    got = read_latest(spark.read.parquet(store), "id", ["at"]).select("id", "name")
    assert rows(got) == sorted([(1, "a"), (2, "😀"), (3, None)], key=repr)


def test_documents_are_published_and_scratch_is_removed(spark, tmp_path, monkeypatch):
    published = []
    (tmp_path / "scratch").mkdir()
    monkeypatch.setattr(session, "scratch_root", lambda _: f"file://{tmp_path}/scratch")
    stream = streaming.read_json_stream(spark, folder(spark, tmp_path, BATCHES), SCHEMA, files_per_batch=1)
    streaming.upsert_documents_stream(
        stream, [MODEL], f"{tmp_path}/store", f"{tmp_path}/c", available_now=True,
        publish=lambda documents: published.extend(r["key"] for r in documents.collect()),
    ).awaitTermination()
    stored = read_latest_documents(spark.read.parquet(f"{tmp_path}/store"))
    assert {r["key"] for r in stored.collect()} == set(published) == {"u:r/1", "u:r/2", "u:r/3"}
    assert os.listdir(tmp_path / "scratch") == []


def test_files_become_messages(spark, tmp_path):
    path, out = folder(spark, tmp_path, BATCHES), f"{tmp_path}/messages"
    streaming.publish_folder(
        spark, path, "parquet", f"{tmp_path}/c", {"path": out}, available_now=True
    ).awaitTermination()
    got = {r["key"].rsplit("/", 1)[1]: r["value"] for r in spark.read.parquet(out).collect()}
    assert got == {
        f"{n}.json": "\n".join(json.dumps(r) for r in batch) for n, batch in enumerate(BATCHES)
    }


def test_console(spark, tmp_path):
    stream = streaming.read_json_stream(spark, folder(spark, tmp_path, BATCHES), SCHEMA)
    streaming.print_stream(stream, available_now=True).awaitTermination()


def test_topics_need_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        streaming.read_topics(spark, "localhost:9092", ["t"])


def test_scratch_folder(spark):
    assert scratch_root(spark) == scratch_root(spark)

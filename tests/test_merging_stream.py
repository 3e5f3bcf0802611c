"""Documents merged in a stream equal a batch reduce of all that came, also after a restart and a replay."""

import os

import pytest
from helpers import rows
from test_increments import flat

from ldspark import streaming
from ldspark.operators import apply_model, read_stated, reduce_documents
from ldspark.plans import Model, Node

MODEL = Model("http://x/", "user", [
    Node("user", ["User", "Agent"], "user/{u}", {"said": "text"}, {"saw": "thing"}),
    Node("thing", "Thing", "thing/{t}"),
])
SCHEMA = "u STRING, t STRING, text STRING, at TIMESTAMP"
FIRST = [("a", "1", "é\t\"", "2024-01-01 10:00:00"), ("b", "1", None, "2024-01-01 10:00:01"), (None, "9", "x", "2024-01-01 10:00:02")]
SECOND = [("a", "1", "é\t\"", "2024-01-01 11:00:00"), ("b", "2", "\U0001f600\n", "2024-01-01 11:00:00")]
THIRD = [("b", "3", "z", "2024-01-01 12:00:00"), ("c", None, None, "2024-01-01 12:00:00")]


def frame(spark, some):
    return spark.createDataFrame(some, "u STRING, t STRING, text STRING, at STRING").selectExpr("u", "t", "text", "CAST(at AS TIMESTAMP) AS at")


def add_file(spark, folder, some):
    frame(spark, some).coalesce(1).write.mode("append").json(folder)


def run(spark, folder, out, **more):
    stream = streaming.read_json_stream(spark, folder, SCHEMA, files_per_batch=1)
    streaming.merge_documents_stream(stream, [MODEL], out, f"{out}-cp", available_now=True, **more).awaitTermination()


def expected(spark, *batches):
    return reduce_documents(apply_model(frame(spark, [r for b in batches for r in b]), MODEL))


@pytest.mark.parametrize("parts", [1, 3])
def test_equals_batch_after_restart_and_replay(spark, tmp_path, parts):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    published = []

    def publish(documents):
        published.append(sorted(r["entity"] for r in documents.collect()))

    add_file(spark, folder, FIRST)
    run(spark, folder, out, parts=parts, publish=publish)
    add_file(spark, folder, SECOND)
    run(spark, folder, out, parts=parts, publish=publish)
    found = flat(reduce_documents(read_stated(spark.read.parquet(out))))
    assert found == flat(expected(spark, FIRST, SECOND))
    if parts == 1:
        assert published[1] == ["http://x/thing/2", "http://x/user/b"], "a repeated statement changes no document"
    commits = sorted((n for n in os.listdir(f"{out}-cp/commits") if n.isdigit()), key=int)
    os.remove(f"{out}-cp/commits/{commits[-1]}")
    if os.path.exists(f"{out}-cp/commits/.{commits[-1]}.crc"):
        os.remove(f"{out}-cp/commits/.{commits[-1]}.crc")
    run(spark, folder, out, parts=parts)
    assert flat(reduce_documents(read_stated(spark.read.parquet(out)))) == found
    add_file(spark, folder, THIRD)
    run(spark, folder, out, parts=parts)
    assert flat(reduce_documents(read_stated(spark.read.parquet(out)))) == flat(expected(spark, FIRST, SECOND, THIRD))


def test_published_documents_are_whole(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    seen = {}
    for some in (FIRST, SECOND, THIRD):
        add_file(spark, folder, some)
        run(spark, folder, out, publish=lambda documents: seen.update({r["key"]: r["value"] for r in documents.collect()}))
    from ldspark.operators import document_rows

    assert seen == {r["key"]: r["value"] for r in document_rows(expected(spark, FIRST, SECOND, THIRD)).collect()}


def test_periods_expire(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    late = [("a", "7", "late", "2024-01-01 10:30:00")]
    for some in (FIRST, SECOND, [("d", "5", "much later", "2024-02-01 00:00:00")], late, [("a", "1", "again", "2024-02-01 01:00:00")]):
        add_file(spark, folder, some)
        run(spark, folder, out, event_time="at", keep_for="1 day")
    stored = spark.read.parquet(out)
    kept = [("d", "5", "much later", "2024-02-01 00:00:00"), ("a", "1", "again", "2024-02-01 01:00:00")]
    assert flat(reduce_documents(read_stated(stored))) == flat(expected(spark, FIRST, SECOND, kept)), "the late row is left out"
    assert flat(reduce_documents(read_stated(stored, since="2024-01-15"))) == flat(expected(spark, kept))


def test_two_streams_into_one_folder_are_united(spark, tmp_path):
    out = str(tmp_path / "out")
    for name, some in (("one", FIRST), ("two", THIRD)):
        folder = str(tmp_path / name)
        add_file(spark, folder, some)
        stream = streaming.read_json_stream(spark, folder, SCHEMA)
        streaming.merge_documents_stream(stream, [MODEL], out, f"{folder}-cp", available_now=True).awaitTermination()
    assert rows(read_stated(spark.read.parquet(out))) == rows(apply_model(frame(spark, FIRST + THIRD), MODEL).distinct())

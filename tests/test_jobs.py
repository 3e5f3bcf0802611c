import json
import os

import pytest

from helpers import rows
from ldspark import operators as ops, session, sources
from ldspark.jobs import main

MODEL = {
    "base": "http://d.example/",
    "root": "p",
    "nodes": [
        {
            "id": "p", "cls": "http://v.example/Person", "subject": "p/{value:$.id}",
            "props": {"http://v.example/name": {"json": "value:$.name"}},
            "links": {"http://v.example/city": "c"},
        },
        {"id": "c", "cls": "http://v.example/City", "subject": "c/{value:$.city}"},
    ],
}
CITY = {
    "base": "http://d.example/",
    "root": "c",
    "nodes": [
        {"id": "c", "cls": "http://v.example/City", "subject": "c/{value:$.city}",
         "props": {"http://v.example/label": {"json": "value:$.city"}}},
    ],
}
CONTEXT = {"@context": {n: {"@id": f"http://v.example/{n}"} for n in ("Person", "City", "name", "city", "label")}}
RECORDS = [{"id": "1", "name": "Ann 😀", "city": "x y"}, {"id": "2", "name": "Bob", "city": "x y"}]


@pytest.fixture
def files(tmp_path):
    (tmp_path / "in.txt").write_text(
        "".join(f"{r['id']}\t{json.dumps(r)}\n" for r in RECORDS), encoding="utf-8"
    )
    (tmp_path / "model.json").write_text(json.dumps(MODEL))
    (tmp_path / "city.json").write_text(json.dumps(CITY))
    (tmp_path / "context.json").write_text(json.dumps(CONTEXT))
    (tmp_path / "frames").mkdir()
    (tmp_path / "frames" / "person.json").write_text('{"@type": "Person", "city": {"@type": "City"}}')
    (tmp_path / "frames" / "none.json").write_text('{"@type": "Nothing"}')
    return tmp_path


def pairs(spark, path):
    return {r["key"]: json.loads(r["value"]) for r in sources.read_kv_text(spark, str(path)).collect()}


def test_map_reduce_and_context(spark, files):
    main(["map", f"{files}/in.txt", f"{files}/out", "--model", f"{files}/model.json", "--model", f"{files}/city.json"], spark)
    docs = pairs(spark, f"{files}/out")
    assert docs["http://d.example/c/x%20y"] == {
        "@id": "http://d.example/c/x%20y", "@type": "http://v.example/City", "http://v.example/label": "x y",
    }
    main(
        ["context", f"{files}/out", f"{files}/short", "--context", f"{files}/context.json"],
        spark,
    )
    assert pairs(spark, f"{files}/short")["http://d.example/p/1"] == {
        "uri": "http://d.example/p/1", "@type": "Person", "name": "Ann 😀", "city": "http://d.example/c/x%20y",
    }


def test_map_to_lines(spark, files):
    main(
        ["map", f"{files}/in.txt", f"{files}/nt", "--model", f"{files}/city.json", "--output-format", "ntriples"], spark
    )
    lines = [r[0] for r in rows(spark.read.text(f"{files}/nt"))]
    assert '<http://d.example/c/x%20y> <http://v.example/label> "x y" .' in lines


def test_frames(spark, files):
    main(
        ["frame", f"{files}/in.txt", f"{files}/framed", "--model", f"{files}/model.json", "--model", f"{files}/city.json",
         "--context", f"{files}/context.json", "--frames", f"{files}/frames", "--merge-limit", "10"],
        spark,
    )
    got = pairs(spark, f"{files}/framed/person")
    assert got["http://d.example/p/2"]["city"] == {
        "uri": "http://d.example/c/x%20y", "@type": "City", "label": "x y",
    }
    assert pairs(spark, f"{files}/framed/none") == {}


def test_filter_and_convert(spark, files):
    main(["filter", f"{files}/in.txt", f"{files}/two", "2,9", "--output-kind", "sequence"], spark)
    main(["convert", f"{files}/two", f"{files}/text", "--kind", "sequence"], spark)
    assert pairs(spark, f"{files}/text") == {"2": RECORDS[1]}


def test_json_lines_to_pairs(spark, files):
    (files / "lines.json").write_text('{"url": "http://x.example/", "n": 1}\n')
    main(["convert", f"{files}/lines.json", f"{files}/keyed", "--kind", "json", "--output-kind", "sequence"], spark)
    assert rows(sources.read_sequence(spark, f"{files}/keyed")) == [("http://x.example/", '{"url": "http://x.example/", "n": 1}')]
    (files / "bad.json").write_text('{"n": 1}\n')
    with pytest.raises(ValueError, match="without 'url'"):
        main(["convert", f"{files}/bad.json", f"{files}/never", "--kind", "json"], spark)


JOBS = {
    "map": ["--model", "{0}/model.json"],
    "context": ["--context", "{0}/context.json"],
    "frame": ["--model", "{0}/model.json", "--frames", "{0}/frames"],
}


@pytest.mark.parametrize("job", sorted(JOBS))
def test_records_that_do_not_parse_fail_a_job_or_are_set_apart(spark, files, job):
    with open(f"{files}/in.txt", "a", encoding="utf-8") as out:
        out.write('9\t{"id": "9", \n')
    args = [a.format(files) for a in JOBS[job]]
    with pytest.raises(Exception, match="not JSON, key: 9|unusable records"):
        main([job, f"{files}/in.txt", f"{files}/never", *args], spark)
    main([job, f"{files}/in.txt", f"{files}/good", *args, "--rejects", f"{files}/rejects"], spark)
    assert [r["key"] for r in spark.read.json(f"{files}/rejects").collect()] == ["9"]


def test_load_writes_documents_and_rejects(spark, files):
    (files / "load.txt").write_text('k\t{"id": 1, "big": "x", "n": 1.50}\nk\t{"n": 2}\nk\tbroken\n')
    args = ["load", f"{files}/load.txt", "--key-field", "id", "--drop", "big", "--output", f"{files}/loaded"]
    with pytest.raises(ValueError, match="unusable records"):
        main(args, spark)
    main([*args, "--rejects", f"{files}/rejects"], spark)
    assert pairs(spark, f"{files}/loaded") == {"1": {"id": 1, "n": 1.5}}
    assert sorted(r["value"] for r in spark.read.json(f"{files}/rejects").collect()) == ["broken", '{"n": 2}']


def test_context_changes_names_only(spark, files):
    text = '{"http://v.example/name":{"http://v.example/label":1.50,"l":["b","a","a"]},"ok":true,"@type":["http://v.example/City","x"]}'
    (files / "docs.txt").write_text(f"k\t{text}\n")
    main(["context", f"{files}/docs.txt", f"{files}/renamed", "--context", f"{files}/context.json"], spark)
    (row,) = sources.read_kv_text(spark, f"{files}/renamed").collect()
    assert row["value"] == '{"name":{"label":1.50,"l":["b","a","a"]},"ok":true,"@type":["City","x"]}'


def test_scratch_is_empty_after_a_job(spark, files, monkeypatch):
    (files / "scratch").mkdir()
    monkeypatch.setattr(session, "scratch_root", lambda _: f"file://{files}/scratch")
    main(["frame", f"{files}/in.txt", f"{files}/f", "--model", f"{files}/model.json", "--frames", f"{files}/frames"], spark)
    assert pairs(spark, f"{files}/f/none") == {} and os.listdir(files / "scratch") == []


def test_compact_keeps_the_current_documents(spark, tmp_path):
    store = f"{tmp_path}/store"
    for run, value in (("2020", "old"), ("2021", "new")):
        rows_ = spark.createDataFrame([("a", 0, 1, "a", value)], "entity STRING, part INT, parts INT, key STRING, value STRING")
        ops.write_document_batch(rows_, store, 0, run, run)
    main(["compact", f"{tmp_path}/fresh", "--input", store], spark)
    assert [r["value"] for r in ops.read_latest_documents(spark.read.parquet(f"{tmp_path}/fresh")).collect()] == ["new"]


def test_collections_and_frames_that_follow(spark, files):
    """Loads added, replaced and withdrawn; the frames are made once and follow."""
    store, framed = f"{files}/store", f"{files}/framed"
    put = ["--model", f"{files}/model.json", "--context", f"{files}/context.json", "--buckets", "2"]
    city = ["--model", f"{files}/city.json", "--context", f"{files}/context.json"]
    main(["add", f"{files}/in.txt", store, "--load", "people", *put], spark)
    main(["add", f"{files}/in.txt", store, "--load", "cities", *city], spark)
    main(["refresh", store, framed, "--frames", f"{files}/frames", "--buckets", "2"], spark)

    def labels():
        found = ops.open_framed(spark, framed).read("person").collect()
        return {r["uri"]: [x["v"] for c in r["city"] for x in c["props"].get("label", [])] for r in found}

    assert labels() == {"http://d.example/p/1": ["x y"], "http://d.example/p/2": ["x y"]}
    main(["withdraw", store, "--load", "cities"], spark)
    (files / "in.txt").write_text(f"1\t{json.dumps(RECORDS[0])}\n", encoding="utf-8")
    main(["add", f"{files}/in.txt", store, "--load", "people", *put], spark)
    main(["refresh", store, framed], spark)
    assert labels() == {"http://d.example/p/1": []}

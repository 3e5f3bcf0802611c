import json

import pytest

from helpers import rows
from ldspark import sources
from ldspark.operators import (
    frame_types,
    list_frames,
    pair_models,
    parse_contexts,
    types_with_uris,
    unknown_types,
)
from ldspark.plans import Frame


def put(folder, files):
    for name, text in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")


def test_frames_of_a_folder(spark, tmp_path):
    frame = {"@type": "A", "p": {"@type": "B"}}
    put(tmp_path, {"one.json": json.dumps(frame, indent=1), "two.x.json": '{"@type": "C"}', "no.txt": "x", "json": "x"})
    frames = list_frames(sources.read_files(spark, str(tmp_path), "*.json"))
    assert {r["name"] for r in frames.collect()} == {"one", "two.x"}
    assert sources.load_frames(frames) == {"one": Frame.from_dict(frame), "two.x": Frame("C")}


def test_models_pair_with_their_roots(spark, tmp_path):
    put(
        tmp_path,
        {
            "g/g-model.ttl": "x", "g/g-root.txt": "  http://v.example/Page1 \n\n",
            "y/y1-model.ttl": "x", "y/y1-root.txt": "R1", "y/y2-model.ttl": "x", "y/y2-root.txt": "R2",
            "y/y2-model.MD": "x", "y/picture.png": "x", "z/z-model.ttl": "no root", "z/other-root.txt": "R",
            "w/g-root.txt": "in another folder", "w/w-model.ttl.bak": "x",
        },
    )
    files = sources.read_files(spark, str(tmp_path), recursive=True)
    got = {(r["name"], r["url"].rsplit("/", 1)[1], r["root"]) for r in pair_models(files).collect()}
    assert got == {
        ("g", "g-model.ttl", "http://v.example/Page1"), ("y", "y1-model.ttl", "R1"), ("y", "y2-model.ttl", "R2"),
    }


def frames(spark, *specs):
    return spark.createDataFrame(
        [(f"f{n}", s if isinstance(s, str) else json.dumps(s)) for n, s in enumerate(specs)],
        "name STRING, text STRING",
    )


def test_types_named_in_frames(spark):
    spec = {
        "@context": {"x": {"@type": "@id"}}, "@type": "A",
        "p": {"@type": ["B", "C"], "q": {"@type": "D", "@context": {"y": {"@type": "@id"}}}},
        "list": [{"@type": "Ignored"}], "untyped": {"r": {"@type": "E"}},
    }
    got = rows(frame_types(frames(spark, spec, {"@type": "A"}, "{broken", {})))
    assert got == sorted([("f0", t) for t in "ABCDE"] + [("f1", "A")], key=repr)


def test_a_frame_that_is_too_deep_is_an_error(spark):
    spec = {"@type": "T0"}
    for n in range(1, 4):
        spec = {"@type": f"T{n}", "p": spec}
    assert frame_types(frames(spark, spec), max_depth=4).count() == 4
    with pytest.raises(Exception, match="deeper than 3"):
        frame_types(frames(spark, spec), max_depth=3).collect()


def test_types_looked_up_in_the_context(spark):
    types = frame_types(frames(spark, {"@type": "A", "p": {"@type": "B"}}, {"@type": "A"}))
    files = spark.createDataFrame(
        [('{"@context": {"A": {"@id": "v:A"}, "B": {"@id": "v:B"}, "Z": {"@id": "v:Z"}}}',)], "text STRING"
    )
    context = parse_contexts(files)
    assert rows(types_with_uris(types, context)) == [("A", "v:A"), ("B", "v:B")]
    partial = context.filter("term <> 'B'")
    assert rows(unknown_types(types, partial)) == [("B",)]
    assert rows(types_with_uris(types, partial, strict=False)) == [("A", "v:A"), ("B", None)]
    with pytest.raises(Exception, match="not in the context: B"):
        types_with_uris(types, partial).collect()

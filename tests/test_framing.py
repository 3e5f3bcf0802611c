import json

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows, statements
from ldspark.catalogue import models
from ldspark.operators import (
    apply_frames,
    frame_documents,
    framed_document_json,
    partition_on_types,
    store_by_type,
    store_colocated,
    to_nodes,
    type_members,
)
from ldspark.plans import RDF_TYPE, Frame

DATA = [
    ("c:1", RDF_TYPE, "C", "type"), ("c:1", "name", "one", "literal"), ("c:1", "n", "n:1", "iri"),
    ("c:2", RDF_TYPE, "C", "type"), ("c:2", "n", "n:2", "iri"), ("c:2", "n", "n:missing", "iri"),
    ("c:3", RDF_TYPE, "C", "type"), ("c:3", "n", "x:1", "iri"), ("c:3", "n", "text", "literal"),
    ("c:4", RDF_TYPE, "C", "type"),
    ("n:1", RDF_TYPE, "N", "type"), ("n:1", "name", "North", "literal"), ("n:1", "r", "r:1", "iri"),
    ("n:2", RDF_TYPE, "N", "type"), ("n:2", RDF_TYPE, "C", "type"), ("n:2", "r", "r:1", "iri"),
    ("r:1", RDF_TYPE, "R", "type"), ("r:1", "name", "Region", "literal"),
    ("x:1", RDF_TYPE, "X", "type"),
]
ONE = Frame("C", {"n": Frame("N")})
TWO = Frame("C", {"n": Frame("N", {"r": Frame("R")})})


def docs(framed, frame):
    return {r["key"]: json.loads(r["value"]) for r in framed_document_json(framed, frame).collect()}


def test_one_level(spark):
    got = docs(frame_documents(to_nodes(statements(spark, DATA)), ONE), ONE)
    north = {"uri": "n:1", "@type": "N", "name": "North", "r": "r:1"}
    second = {"uri": "n:2", "@type": ["C", "N"], "r": "r:1"}
    assert got["c:1"] == {"uri": "c:1", "@type": "C", "name": "one", "n": north}
    # a target that is absent, or of another type, stays a reference; text stays text
    assert got["c:2"] == {"uri": "c:2", "@type": "C", "n": [second, "n:missing"]}
    assert got["c:3"] == {"uri": "c:3", "@type": "C", "n": ["x:1", "text"]}
    assert got["c:4"] == {"uri": "c:4", "@type": "C"}
    # a document with two types is a root as well
    assert set(got) == {"c:1", "c:2", "c:3", "c:4", "n:2"}


def test_two_levels(spark):
    got = docs(frame_documents(to_nodes(statements(spark, DATA)), TWO), TWO)
    region = {"uri": "r:1", "@type": "R", "name": "Region"}
    assert got["c:1"]["n"] == {"uri": "n:1", "@type": "N", "name": "North", "r": region}
    assert got["c:2"]["n"][0]["r"] == region


def test_two_edges_on_one_frame(spark):
    data = DATA + [("c:1", "x", "x:1", "iri")]
    frame = Frame("C", {"n": Frame("N"), "x": Frame("X")})
    got = docs(frame_documents(to_nodes(statements(spark, data)), frame), frame)
    assert got["c:1"]["x"] == {"uri": "x:1", "@type": "X"} and got["c:1"]["n"]["uri"] == "n:1"


def test_cycles_end_with_the_frame(spark):
    data = [
        ("a:1", RDF_TYPE, "A", "type"), ("a:1", "b", "b:1", "iri"),
        ("b:1", RDF_TYPE, "B", "type"), ("b:1", "a", "a:1", "iri"),
    ]
    frame = Frame("A", {"b": Frame("B", {"a": Frame("A")})})
    got = docs(frame_documents(to_nodes(statements(spark, data)), frame), frame)
    assert got["a:1"]["b"]["a"] == {"uri": "a:1", "@type": "A", "b": "b:1"}


def wide(n=40):
    data = [("p:1", RDF_TYPE, "P", "type")]
    for i in range(n):
        data += [("p:1", "k", f"k:{i:03d}", "iri"), (f"k:{i:03d}", RDF_TYPE, "K", "type")]
    return data + [("p:1", "k", "k:absent", "iri")]


@pytest.mark.parametrize("limit", [0, 1, 7, 2000])
def test_merge_limit_embeds_some_and_keeps_the_rest_as_references(spark, limit):
    frame = Frame("P", {"k": Frame("K")})
    framed = frame_documents(to_nodes(statements(spark, wide())), frame, merge_limit=limit)
    embedded = [r[0] for r in framed.select(F.explode("k.uri")).collect()]
    left = [r[0] for r in framed.select(F.explode(F.col("props")["k"])).select("col.v").collect()]
    assert sorted(embedded) == [f"k:{i:03d}" for i in range(40)][:limit]
    assert sorted(embedded + left) == sorted([f"k:{i:03d}" for i in range(40)] + ["k:absent"])


@pytest.mark.parametrize("values,per_task", [(5, 3), (1000, 3), (5, 1000)])
def test_hot_parents_and_hot_children_give_the_same_documents(spark, values, per_task):
    """Parents split into parts and links salted, against the unsplit result."""
    data = wide() + [
        st
        for i in range(60)
        for st in [(f"q:{i}", RDF_TYPE, "P", "type"), (f"q:{i}", "k", "k:001", "iri")]
    ]
    frame = Frame("P", {"k": Frame("K")})
    split = frame_documents(
        to_nodes(statements(spark, data), values_per_row=values), frame, rows_per_task=per_task
    )
    plain = frame_documents(to_nodes(statements(spark, data)), frame)

    def pairs(framed):
        return rows(framed.select("uri", F.explode("k.uri").alias("c")).distinct())

    assert pairs(split) == pairs(plain)
    assert split.select("uri").distinct().count() == 61


def test_partition_on_types(spark):
    st = statements(spark, DATA)
    types = [{"name": "cs", "uri": "C"}, {"name": "ns", "uri": "N"}, {"name": "none", "uri": "Z"}]
    split = partition_on_types(to_nodes(st), types)
    assert {k: {r["uri"] for r in v.collect()} for k, v in split.items()} == {
        "cs": {"c:1", "c:2", "c:3", "c:4", "n:2"}, "ns": {"n:1", "n:2"}, "none": set(),
    }
    table = spark.createDataFrame([("cs", "C"), ("ns", "N")], "name STRING, uri STRING")
    assert {tuple(r) for r in type_members(st, table).collect()} == {
        ("cs", u) for u in ("c:1", "c:2", "c:3", "c:4", "n:2")
    } | {("ns", "n:1"), ("ns", "n:2")}


def test_documents_stored_by_type_frame_alike(spark):
    nodes = to_nodes(statements(spark, DATA))
    stored = store_by_type(nodes, TWO.types())
    assert set(stored) == {"C", "N", "R"}
    assert stored["C"].columns == nodes.columns
    assert rows(stored["C"].select("uri")) == [(f"c:{n}",) for n in range(1, 5)] + [("n:2",)]
    assert docs(frame_documents(stored, TWO), TWO) == docs(frame_documents(nodes, TWO), TWO)
    assert "PartitionFilters: [isnotnull(class" in plan(stored["N"])


def test_several_frames_over_one_collection(spark):
    framed = apply_frames(to_nodes(statements(spark, DATA)), {"c": ONE, "r": Frame("R")})
    assert framed["c"].count() == 5 and framed["r"].count() == 1


def test_frame_from_json():
    text = '{"@context": {"x": {"@type": "@id"}}, "@type": "C", "n": {"@type": "N", "r": {"@type": "R"}}}'
    assert Frame.from_json(text) == TWO
    assert TWO.types() == {"C", "N", "R"}
    with pytest.raises(ValueError):
        Frame.from_json('{"n": {}}')


def test_named_properties_only(spark):
    frame = Frame.from_json('{"@type": "C", "n": {"@type": "N", "@explicit": true, "name": {}}}')
    assert frame == Frame("C", {"n": Frame("N", keep=("name",))})
    got = docs(frame_documents(to_nodes(statements(spark, DATA)), frame), frame)
    assert got["c:1"]["n"] == {"uri": "n:1", "@type": "N", "name": "North"}
    assert got["c:1"]["name"] == "one"


def test_frames_that_cannot_be_honoured_are_errors(spark):
    with pytest.raises(ValueError, match="not a list"):
        Frame.from_json('{"@type": "A", "p": [{"@type": "B"}]}')
    with pytest.raises(ValueError, match="one @type"):
        Frame.from_json('{"@type": "A", "p": {"q": {}}}')
    with pytest.raises(ValueError, match="cannot be named"):
        frame_documents(to_nodes(statements(spark, DATA)), Frame("C", {"types": Frame("N")}))


def test_limits_above_sparks_own_rank_in_salted_groups(spark):
    data = [("p:1", RDF_TYPE, "P", "type")]
    data += [("p:1", "c", f"c:{n:03}", "iri") for n in range(60)] + [(f"c:{n:03}", RDF_TYPE, "C", "type") for n in range(60)]
    frame = Frame("P", {"c": Frame("C")})
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        framed = frame_documents(to_nodes(statements(spark, data)), frame, merge_limit=20, rows_per_task=10)
        (row,) = framed.select(F.transform("c", lambda c: c["uri"]).alias("c")).collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert row["c"] == [f"c:{n:03}" for n in range(20)]


def test_colocated_documents_are_not_shuffled(spark):
    """Equal to the frame over other documents, and without an exchange on the parents' side at either level."""
    nodes = to_nodes(statements(spark, DATA))
    stored = store_colocated(nodes, TWO.types(), buckets=3)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame in (TWO, Frame("C", {"n": Frame("N"), "name": Frame("R")})):
            framed = frame_documents(stored, frame)
            text = plan(framed)
            assert "Bucketed: true" in text
            assert "Exchange hashpartitioning(uri" not in text and "Exchange hashpartitioning(_hash" not in text.split("[parent")[0]
            exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
            assert all("uri" not in line for line in exchanges), exchanges
            assert docs(framed, frame) == docs(frame_documents(store_by_type(nodes, frame.types()), frame), frame)
            assert docs(frame_documents(stored, frame, merge_limit=1), frame) == docs(frame_documents(nodes, frame, merge_limit=1), frame)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    with pytest.raises(KeyError):
        stored["unknown"]


def test_buckets_grow_with_the_documents(spark, monkeypatch):
    """A bucket is one task, so their number must not be fixed whatever the documents."""
    nodes = to_nodes(statements(spark, DATA))
    assert store_colocated(nodes, TWO.types()).buckets == 8
    monkeypatch.setattr("ldspark.operators.framing.LEAST_BUCKETS", 1)
    monkeypatch.setattr("ldspark.operators.framing.BUCKET_ROWS", 2)
    stored = store_colocated(nodes, TWO.types())
    assert stored.buckets == -(-nodes.count() // 2) > 1
    assert docs(frame_documents(stored, TWO), TWO) == docs(frame_documents(store_by_type(nodes, TWO.types()), TWO), TWO)


def test_only_columns_of_the_documents_are_dealt(spark, tmp_path):
    """Orders in one row group are dealt to tasks by what their documents are made of, and nothing else is read."""
    made = spark.range(250_000).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'O' AS o_orderstatus", "1.5D AS o_totalprice",
        "timestamp_ntz'2020-01-01' AS o_orderdate", "uuid() AS o_orderpriority",
    )
    made.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    links = models.order_links(spark, str(tmp_path))
    text = plan(links)
    assert "Exchange hashpartitioning" in text and "o_orderpriority" not in text and "o_totalprice" not in text
    assert links.rdd.getNumPartitions() == 3 and links.agg(F.sum("o_orderkey"), F.count("*")).first()[:] == (31_249_875_000, 250_000)

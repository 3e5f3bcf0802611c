import pytest
from pyspark.sql import functions as F

from helpers import rows, statements
from ldspark.operators import (
    distinct_statements,
    node_statements,
    node_values,
    reduce_documents,
    reduce_statements,
    to_nodes,
    union_all,
)
from ldspark.plans import RDF_TYPE

A = [
    ("u:1", RDF_TYPE, "T", "type"),
    ("u:1", "p", "b", "literal"),
    ("u:1", "p", "a", "literal"),
    ("u:1", "p", "a", "literal"),
    ("u:1", "q", "u:2", "iri"),
    ("u:2", RDF_TYPE, "T", "type"),
]
B = [
    ("u:1", RDF_TYPE, "S", "type"),
    ("u:1", "p", "a", "literal"),
    ("u:3", "p", "😀", "literal"),
    ("u:1", "p", "a", "iri"),
]


def test_union_is_a_bag(spark):
    a, b = statements(spark, A), statements(spark, B)
    assert union_all(a, b).count() == len(A) + len(B)
    assert union_all(a).count() == len(A)
    with pytest.raises(ValueError):
        union_all()


def test_reduce_is_idempotent_and_order_insensitive(spark):
    a, b = statements(spark, A), statements(spark, B)
    both = rows(reduce_statements(a, b))
    assert both == rows(reduce_statements(b, a)) == sorted(set(A + B), key=repr)
    assert both == rows(reduce_statements(reduce_statements(a), reduce_statements(b)))
    assert both == rows(reduce_statements(reduce_statements(a, b)))


def test_documents_are_sorted_and_complete(spark):
    got = {r["uri"]: r for r in reduce_documents(statements(spark, A), statements(spark, B)).collect()}
    assert got["u:1"]["types"] == ["S", "T"]
    assert [(x["kind"], x["v"]) for x in got["u:1"]["props"]["p"]] == [
        ("iri", "a"), ("literal", "a"), ("literal", "b"),
    ]
    assert got["u:2"]["props"] == {} and got["u:2"]["types"] == ["T"]
    assert got["u:3"]["types"] == []
    assert {r["part"] for r in got.values()} == {0}


def test_empty_collections_reduce_to_nothing(spark):
    assert reduce_documents(statements(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [1, 3, 10, 1000])
def test_large_documents_continue_in_parts_and_lose_nothing(spark, limit):
    data = [("u:hot", "p", str(n), "literal") for n in range(200)]
    data += [("u:hot", RDF_TYPE, "T", "type"), ("u:hot", RDF_TYPE, "S", "type")]
    data += [(f"u:{n}", "p", "x", "literal") for n in range(50)]
    data += [(f"u:{n}", RDF_TYPE, "T", "type") for n in range(50)]
    nodes = to_nodes(statements(spark, data), values_per_row=limit).cache()
    assert rows(node_statements(nodes)) == sorted(data, key=repr)
    hot = nodes.filter("uri = 'u:hot'").collect()
    assert all(r["types"] == ["S", "T"] for r in hot)
    if limit <= 10:
        assert len(hot) > 200 / limit / 2
        assert max(sum(len(v) for v in r["props"].values()) for r in hot) < 200 // 2
    cold = nodes.filter("uri <> 'u:hot'")
    if limit > 2:
        assert cold.count() == 50 and cold.filter("part <> 0").count() == 0
    assert node_values(nodes).filter("uri = 'u:hot'").count() == 200
    nodes.unpersist()


def test_single_valued_properties(spark):
    data = [
        ("u:1", "n", "9", "literal"), ("u:1", "n", "10", "literal"), ("u:1", "n", "10", "literal"),
        ("u:1", "d", "b", "literal"), ("u:1", "d", "a", "iri"),
        ("u:1", "m", "x", "literal"), ("u:1", "m", "y", "literal"), ("u:1", "m", "y", "literal"),
        ("u:2", "n", "no number", "literal"),
    ]
    got = rows(
        reduce_statements(
            statements(spark, data), single_valued={"n": ("max", "decimal(9,2)"), "d": "min"}
        )
    )
    assert got == sorted(
        [
            ("u:1", "n", "10", "literal"), ("u:1", "d", "a", "iri"), ("u:1", "m", "x", "literal"),
            ("u:1", "m", "y", "literal"), ("u:2", "n", "no number", "literal"),
        ],
        key=repr,
    )
    least = reduce_statements(
        statements(spark, data + [("u:1", "n", "none", "literal")]), single_valued={"n": ("min", "int")}
    )
    assert ("u:1", "n", "9", "literal") in rows(least)
    with pytest.raises(ValueError):
        reduce_statements(statements(spark, data), single_valued={"n": "avg"})


def test_distinct(spark):
    assert rows(distinct_statements(statements(spark, A + A))) == sorted(set(A), key=repr)


def test_parts_depend_on_the_entity_alone(spark):
    own = [("u:hot", "p", str(n), "literal") for n in range(25)]
    others = [(f"u:{n}", "p", "x", "literal") for n in range(500)]
    alone = to_nodes(statements(spark, own), values_per_row=10)
    among = to_nodes(statements(spark, own + others), values_per_row=10).filter("uri = 'u:hot'")
    assert rows(alone.select("part", "parts", "props")) == rows(among.select("part", "parts", "props"))
    assert {r["parts"] for r in alone.collect()} == {3}


def test_the_source_is_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(text):
        read.add(1)
        return text

    source = statements(spark, A + B).withColumn("o", F.udf(count)("o"))
    reduce_documents(source).collect()
    assert read.value == len(A + B)


def test_grouping_is_in_tasks_of_bounded_rows(spark):
    """However small the shuffle is, adaptive execution gathers no more statements in a task."""
    n = 200_000
    subject = F.concat(F.lit("http://x/"), F.col("id").cast("string"))
    facts = spark.range(n).select(
        subject.alias("s"), F.explode(F.array(*[F.struct(F.lit(f"p{i}").alias("p"), F.lit(str(i)).alias("o")) for i in range(6)])).alias("x")
    ).select("s", "x.p", "x.o", F.lit("literal").alias("kind"))
    nodes = to_nodes(facts).select("uri", F.spark_partition_id().alias("task"))
    counts = [r["n"] for r in nodes.groupBy("task").agg(F.count("*").alias("n")).collect()]
    assert len(counts) == 3 and sum(counts) == n

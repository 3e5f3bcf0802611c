import json

import pytest

from helpers import rows
from ldspark.operators import (
    document_statements,
    flat_document_json,
    reduce_documents,
    reduce_statements,
)
from ldspark.plans import RDF_TYPE


def records(spark, *docs):
    data = [(f"k{n}", d if isinstance(d, str) else json.dumps(d)) for n, d in enumerate(docs)]
    return spark.createDataFrame(data, "key STRING, value STRING")


def test_flat_documents(spark):
    doc = {
        "@id": "u:1", "@type": ["A", "B"], "t": ["x", 1, None], "r": {"@id": "u:2"},
        "link": "u:3", "v": {"@value": "y"},
    }
    got = rows(document_statements(records(spark, doc, {"p": "named by the key"}, "{broken"), links=["link"]))
    assert got == sorted(
        [
            ("u:1", RDF_TYPE, "A", "type"), ("u:1", RDF_TYPE, "B", "type"), ("u:1", "t", "x", "literal"),
            ("u:1", "t", "1", "literal"), ("u:1", "r", "u:2", "iri"), ("u:1", "link", "u:3", "iri"),
            ("u:1", "v", "y", "literal"), ("k1", "p", "named by the key", "literal"),
        ],
        key=repr,
    )


def test_nested_documents_are_taken_apart(spark):
    doc = {"@id": "u:1", "p": [{"@id": "u:2", "n": "two", "q": {"@id": "u:3", "n": "three"}}, "text"]}
    assert rows(document_statements(records(spark, doc))) == sorted(
        [
            ("u:1", "p", "u:2", "iri"), ("u:1", "p", "text", "literal"), ("u:2", "n", "two", "literal"),
            ("u:2", "q", "u:3", "iri"), ("u:3", "n", "three", "literal"),
        ],
        key=repr,
    )


def test_what_cannot_be_told_apart_is_an_error(spark):
    with pytest.raises(Exception, match="without identifier"):
        document_statements(records(spark, {"@id": "u:1", "p": {"n": 1}})).collect()
    deep = {"@id": "u:1", "p": {"@id": "u:2", "p": {"@id": "u:3"}}}
    with pytest.raises(Exception, match="nested below 2"):
        document_statements(records(spark, deep), max_depth=2).collect()


def test_documents_of_one_identifier_merge(spark):
    st = document_statements(
        records(spark, {"@id": "u:1", "a": "x"}, {"@id": "u:1", "a": ["x", "y"], "@type": "T"})
    )
    got = flat_document_json(reduce_documents(st), "@id").collect()
    assert [tuple(r) for r in got] == [("u:1", '{"@id":"u:1","@type":"T","a":["x","y"]}')]
    again = document_statements(
        spark.createDataFrame([tuple(r) for r in got], "key STRING, value STRING")
    )
    assert rows(again) == rows(reduce_statements(st))

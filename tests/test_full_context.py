"""Contexts with prefixes, coercions, containers and terms by class: there, and back."""

import json

import pytest
from helpers import plan, rows

from ldspark.operators.full_context import FACT, compact_statements, expand_documents
from ldspark.plans import RDF_TYPE
from ldspark.plans.context import FullContext, Term

TEXT = {
    "@context": {
        "@vocab": "http://v/", "@base": "http://b/", "@language": "en",
        "ex": "http://ex/", "deep": "ex:deep/", "Person": {"@id": "ex:Person", "@context": {"label": {"@id": "ex:personLabel"}, "tag": "ex:ptag"}},
        "label": "ex:label", "raw": {"@id": "ex:raw", "@language": ""}, "de": {"@id": "ex:label", "@language": "de"},
        "names": {"@id": "ex:name", "@container": "@language"}, "knows": {"@id": "ex:knows", "@type": "@id"},
        "steps": {"@id": "ex:steps", "@container": "@list"}, "path": {"@id": "ex:path", "@type": "@id", "@container": "@list"},
        "status": {"@id": "deep:status", "@type": "@vocab"}, "many": {"@id": "ex:many", "@container": "@set"},
    }
}
CONTEXT = FullContext.from_json(json.dumps(TEXT))
SCHEMA = "s STRING, p STRING, o STRING, kind STRING, lang STRING, place INT"


def expand(spark, *documents):
    records = [(f"key{i}", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)]
    return expand_documents(spark.createDataFrame(records, "key STRING, value STRING"), CONTEXT)


def test_compiled_once():
    assert CONTEXT.prefixes == {"ex": "http://ex/", "deep": "http://ex/deep/"}
    assert CONTEXT.terms["status"] == Term("http://ex/deep/status", "vocab")
    assert CONTEXT.scoped["http://ex/Person"] == {"label": Term("http://ex/personLabel"), "tag": Term("http://ex/ptag")}
    assert CONTEXT.expand_name("deep:x") == "http://ex/deep/x" and CONTEXT.expand_name("http://q/") == "http://q/"
    for wrong in ({"a": "b:x", "b": "a:y"}, {"a": {"@id": "u:", "@container": "@graph"}}, {"@import": "x"}, {"a": {"@reverse": "x"}}):
        with pytest.raises(ValueError):
            FullContext.from_json(json.dumps({"@context": wrong}))
    two = FullContext.from_json('{"@context": [{"a": "u:1", "b": "u:2"}, {"b": "u:3"}]}')
    assert {k: t.iri for k, t in two.terms.items()} == {"a": "u:1", "b": "u:3"}


def test_expand(spark):
    document = {
        "@id": "one", "@type": ["Person", "Other"], "label": "scoped", "ex:label": {"@value": "x", "@language": "fr"},
        "names": {"en": ["A", "B"], "de": "Ä\t\"\U0001f600"}, "knows": ["ex:two", "rel", "http://abs/x"], "steps": ["b", "a", "b", 3],
        "path": ["ex:1"], "status": "open", "free": {"@id": "deep:z"}, "plain": 1.5, "none": None, "ex:list": {"@list": ["q", "q"]}, "yes": True,
    }
    one, en = "http://b/one", "en"
    assert rows(expand(spark, document, "{broken", {"label": "no id", "many": [], "de": "zwei"})) == sorted(
        [
            (one, RDF_TYPE, "http://ex/Person", "type", None, None), (one, RDF_TYPE, "http://v/Other", "type", None, None),
            (one, "http://ex/personLabel", "scoped", "literal", en, None), (one, "http://ex/label", "x", "literal", "fr", None),
            (one, "http://ex/name", "A", "literal", en, None), (one, "http://ex/name", "B", "literal", en, None),
            (one, "http://ex/name", "Ä\t\"\U0001f600", "literal", "de", None),
            (one, "http://ex/knows", "http://ex/two", "iri", None, None), (one, "http://ex/knows", "http://b/rel", "iri", None, None),
            (one, "http://ex/knows", "http://abs/x", "iri", None, None),
            *[(one, "http://ex/steps", o, "literal", None if o == "3" else en, i) for i, o in enumerate(["b", "a", "b", "3"])],
            (one, "http://ex/path", "http://ex/1", "iri", None, 0), (one, "http://ex/deep/status", "http://v/open", "iri", None, None),
            (one, "http://v/free", "http://ex/deep/z", "iri", None, None), (one, "http://v/plain", "1.5", "literal", None, None),
            (one, "http://ex/list", "q", "literal", en, 0), (one, "http://ex/list", "q", "literal", en, 1),
            (one, "http://v/yes", "true", "literal", None, None),
            ("key2", "http://ex/label", "no id", "literal", en, None), ("key2", "http://ex/label", "zwei", "literal", "de", None),
        ],
        key=repr,
    )
    with pytest.raises(Exception, match="an object that is no value"):
        expand(spark, {"x": {"y": 1}}).collect()


FACTS = [
    ("http://b/one", RDF_TYPE, "http://ex/Person", "type", None, None), ("http://b/one", "http://ex/personLabel", "s", "literal", "en", None),
    ("http://b/one", "http://ex/label", "hidden here", "literal", "en", None), ("http://b/one", "http://ex/label", "de", "literal", "de", None),
    ("http://b/one", "http://ex/label", "fr", "literal", "fr", None), ("http://b/one", "http://ex/label", "none", "literal", None, None),
    ("http://b/one", "http://v/label", "a name of the vocabulary that is a term", "literal", "en", None),
    ("http://b/one", "http://ex/name", "A", "literal", "en", None), ("http://b/one", "http://ex/name", "B", "literal", "en", None),
    ("http://b/one", "http://ex/name", "C", "literal", "x-y", None), ("http://b/one", "http://ex/name", "untagged", "literal", None, None),
    ("http://b/one", "http://ex/knows", "http://ex/deep/two", "iri", None, None), ("http://b/one", "http://ex/knows", "text", "literal", "en", None),
    ("http://b/one", "http://other/p", "http://b/rel", "iri", None, None), ("http://b/one", "http://other/p", "\U0001f600\"\\\n\t", "literal", "en", None),
    *[("http://b/one", "http://ex/steps", o, "literal", "en", i) for i, o in enumerate(["b", "a", "b"])],
    *[("http://b/one", "http://ex/path", f"http://ex/{i}", "iri", None, 3 - i) for i in range(4)],
    *[("http://b/one", "http://other/list", o, "literal", None, i) for i, o in enumerate("zz")],
    ("http://else/two", RDF_TYPE, "http://v/Other", "type", None, None), ("http://else/two", "http://ex/label", "en", "literal", "en", None),
    ("http://else/two", "http://ex/many", "lone", "literal", "en", None), ("http://else/two", "http://v/x:y", "odd", "literal", "en", None),
    ("http://else/two", "http://ex/deep/status", "http://v/open", "iri", None, None), ("urn:3", "http://v/q", "http://v/name", "iri", None, None),
]


def test_back_and_there_again(spark):
    facts = spark.createDataFrame(FACTS + FACTS[:3], SCHEMA)
    documents = compact_statements(facts, CONTEXT)
    found = {r["key"]: json.loads(r["value"]) for r in documents.collect()}
    one, two = found["http://b/one"], found["http://else/two"]
    assert one["@id"] == "one" and one["@type"] == "Person" and one["label"] == "s" and one["de"] == "de"
    assert one["names"] == {"en": ["A", "B"], "x-y": "C"} and one["knows"] == "deep:two" and one["steps"] == ["b", "a", "b"]
    assert one["path"] == ["ex:3", "ex:2", "ex:1", "ex:0"] and one["http://other/list"] == {"@list": [{"@value": "z"}, {"@value": "z"}]}
    assert two["label"] == "en" and two["many"] == ["lone"] and two["status"] == "open"
    assert rows(expand_documents(documents, CONTEXT)) == sorted(set(FACTS), key=repr)


def test_large_documents_go_on_in_parts_with_their_lists_whole(spark):
    facts = [("u:1", "http://ex/many", f"v{i}", "literal", "en", None) for i in range(20)] + [("u:1", RDF_TYPE, "http://v/T", "type", None, None)]
    facts += [("u:1", "http://ex/steps", f"s{i % 3}", "literal", "en", i) for i in range(9)]
    documents = compact_statements(spark.createDataFrame(facts, SCHEMA), CONTEXT, values_per_row=5)
    assert documents.count() > 2
    assert rows(expand_documents(documents, CONTEXT).distinct()) == sorted(set(facts), key=repr)
    assert sum("steps" in r["value"] for r in documents.collect()) == 1


def test_plain_context_and_no_rows(spark):
    plain = FullContext.from_json('{"@context": {}}')
    facts = [("u:1", "p:q", "x", "literal", None, None), ("u:1", "p:q", "u:2", "iri", None, None), ("u:1", RDF_TYPE, "T", "type", None, None)]
    documents = compact_statements(spark.createDataFrame(facts, SCHEMA), plain)
    assert [json.loads(r["value"]) for r in documents.collect()] == [{"@id": "u:1", "@type": "T", "p:q": ["x", {"@id": "u:2"}]}]
    assert rows(expand_documents(documents, plain)) == sorted(facts, key=repr)
    none = spark.createDataFrame([], SCHEMA)
    assert compact_statements(none, CONTEXT).isEmpty() and expand_documents(compact_statements(none, CONTEXT), CONTEXT).isEmpty()
    assert FACT == tuple(none.columns)


def test_documents_are_parsed_and_expanded_once(spark):
    context = FullContext(scoped={"C": {"n": Term("http://x/n")}})
    texts = [("a", '{"@type": "C", "n": 1}'), ("b", "no json"), ("c", None), ("d", "{}"), ("e", "[1]")]
    records = spark.createDataFrame(texts, "key STRING, value STRING").repartition(3, "key")
    facts = expand_documents(records, context)
    assert plan(facts).count("parseJson") == 1
    assert {r[0] for r in rows(facts)} == {"a"}
    reads = spark.sparkContext.accumulator(0)

    def seen(parts):
        for part in parts:
            reads.add(part.num_rows)
            yield part

    counted = facts.mapInArrow(seen, facts.schema)
    assert [r[0] for r in rows(compact_statements(counted, context))] == ["a"] and reads.value == 2

"""Frames that contain themselves, against nesting by hand."""

import json
import random

import pytest
from helpers import rows, statements

from ldspark.operators import reduce_documents
from ldspark.operators.framing import store_by_type
from ldspark.operators.recursive import expand_frames, recursive_document_json
from ldspark.plans import RDF_TYPE, FrameRule, FrameRules

TREE = FrameRules("part", {"part": FrameRule("Part", {"has": "part"})})
PEOPLE = FrameRules(
    "person",
    {
        "person": FrameRule("Person", {"knows": "person", "works": "firm"}),
        "firm": FrameRule("Firm", {"boss": "person"}, keep=("name",)),
    },
)


def nested(data, rules):
    """``(places, documents)`` by walking from each root."""
    types, props = {}, {}
    for s, p, o, kind in set(data):
        if kind == "type":
            types.setdefault(s, set()).add(o)
        else:
            props.setdefault(s, {}).setdefault(p, set()).add((kind, o))
    places = []

    def document(uri, name, path):
        rule = rules.rules[name]
        places.append((path[0], len(path) - 1, uri))
        out = {"uri": uri, "@type": one(sorted(types[uri]))}
        for p, values in props.get(uri, {}).items():
            if rule.keep is not None and p not in (*rule.keep, *rule.edges):
                continue
            inner, left = [], []
            for kind, o in sorted(values):
                target = rule.edges.get(p)
                if kind == "iri" and target and rules.rules[target].type in types.get(o, ()) and o not in path:
                    inner.append(document(o, target, [*path, o]))
                else:
                    left.append(o)
            out[p] = one(inner + left)
        return out

    def one(values):
        return values[0] if len(values) == 1 else values

    found = {uri: document(uri, rules.root, [uri]) for uri in types if rules.rules[rules.root].type in types[uri]}
    return sorted(places), found


def check(spark, data, rules):
    nodes = store_by_type(reduce_documents(statements(spark, data)), {r.type for r in rules.rules.values()})
    expansion = expand_frames(nodes, rules)
    places, documents = nested(data, rules)
    assert rows(expansion.places().select("root", "depth", "uri")) == sorted(places, key=repr)
    got = {r["key"]: json.loads(r["value"]) for r in recursive_document_json(expansion).collect()}
    assert got == documents
    return expansion


def of(uri, cls, *links):
    return [(uri, RDF_TYPE, cls, "type"), (uri, "name", f"the {uri}", "literal"), *[(uri, p, o, "iri") for p, o in links]]


def test_chains_trees_and_cycles(spark):
    data = sum([of(f"c{i}", "Part", ("has", f"c{i + 1}")) for i in range(6)], of("c6", "Part", ("has", "missing")))
    data += sum([of(f"t{i}", "Part", ("has", f"t{2 * i}"), ("has", f"t{2 * i + 1}")) for i in range(1, 8)], [])
    data += of("a", "Part", ("has", "b")) + of("b", "Part", ("has", "a"), ("has", "b"), ("has", "c5"))
    expansion = check(spark, data, TREE)
    assert len(expansion.levels) == 7


@pytest.mark.parametrize("seed", [3])
def test_random_graphs_of_two_frames(spark, seed):
    rng = random.Random(seed)
    data = []
    for i in range(7):
        data += of(f"p{i}", rng.choice(["Person", "Person", "Other"]), ("knows", f"p{rng.randrange(9)}"), ("works", f"f{rng.randrange(3)}"))
        data += [(f"p{i}", "knows", "a \"word\"\t\U0001f600", "literal")]
    for i in range(3):
        data += of(f"f{i}", "Firm", ("boss", f"p{rng.randrange(7)}"), ("boss", f"f{i}"), ("place", "x"))
    data += [("f1", RDF_TYPE, "Person", "type")]
    check(spark, data, PEOPLE)


def test_large_document_in_parts(spark):
    """A document in three parts: each part embeds its own links, and is embedded as a document of its own."""
    data = of("big", "Part", *[("has", f"x{i}") for i in range(5)]) + sum([of(f"x{i}", "Part") for i in range(5)], [])
    data += of("top", "Part", ("has", "big"))
    nodes = store_by_type(reduce_documents(statements(spark, data), values_per_row=3), {"Part"})
    expansion = expand_frames(nodes, TREE)
    parts = [r for r in expansion.places().collect() if r.uri == "big" and r.root == "top"]
    assert len(parts) == nodes["Part"].filter("uri = 'big'").count() > 1
    below = [r.uri for r in expansion.places().collect() if r.root == "top" and r.depth == 2]
    assert sorted(below) == [f"x{i}" for i in range(5)]
    (top,) = [json.loads(r["value"]) for r in recursive_document_json(expansion).collect() if r["key"] == "top"]
    assert sorted(x["uri"] for part in top["has"] for x in (part["has"] if isinstance(part.get("has"), list) else [part["has"]] if "has" in part else [])) == sorted(below)


def test_no_documents_and_wrong_rules(spark):
    nodes = store_by_type(reduce_documents(statements(spark, of("x", "Other"))), {"Part"})
    expansion = expand_frames(nodes, TREE)
    assert expansion.places().isEmpty() and recursive_document_json(expansion).isEmpty()
    with pytest.raises(ValueError):
        FrameRules("a", {"a": FrameRule("A", {"x": "b"})})


def test_rules_from_json():
    text = '{"root": "person", "frames": {"person": {"@type": "Person", "knows": "person", "works": "firm"}, "firm": {"@type": "Firm", "@explicit": true, "boss": "person", "name": {}}}}'
    assert FrameRules.from_json(text) == PEOPLE
    with pytest.raises(ValueError):
        FrameRules.from_json('{"root": "a", "frames": {"a": {"@type": "A", "x": {"@type": "B"}}}}')

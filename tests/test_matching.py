"""Frames that ask for values and properties, against documents by hand."""

import itertools

import pytest
from helpers import plan, statements

from ldspark.operators import frame_documents, reduce_documents, store_by_type
from ldspark.plans import RDF_TYPE, Frame, Match

DATA = [
    ("a", RDF_TYPE, "C", "type"), ("a", "seg", "x", "literal"), ("a", "n", "n1", "iri"), ("a", "tag", "é\t\"", "literal"),
    ("b", RDF_TYPE, "C", "type"), ("b", "seg", "y", "literal"), ("b", "seg", "z", "literal"), ("b", "n", "n2", "iri"),
    ("c", RDF_TYPE, "C", "type"), ("c", "tag", "\U0001f600", "literal"), ("c", "n", "n1", "iri"), ("c", "n", "n2", "iri"),
    ("d", RDF_TYPE, "C", "type"),
    ("n1", RDF_TYPE, "N", "type"), ("n1", "name", "one", "literal"),
    ("n2", RDF_TYPE, "N", "type"), ("n2", "name", "two", "literal"), ("n2", "old", "yes", "literal"),
]
CONDITIONS = [
    Match("seg"), Match("seg", absent=True), Match("seg", ("x", "z")), Match("tag", ("é\t\"", "\U0001f600")), Match("n", ("n2",)), Match("none"),
]


def by_hand(conditions, every):
    props = {}
    for s, p, o, kind in DATA:
        if kind == "type" and o == "C":
            props.setdefault(s, {})
        elif kind != "type" and not s.startswith("n"):
            props[s].setdefault(p, set()).add(o)

    def met(own, m):
        has = bool(own.get(m.prop)) if m.values is None else bool(set(m.values) & own.get(m.prop, set()))
        return has != m.absent

    return sorted(s for s, own in props.items() if (all if every else any)(met(own, m) for m in conditions))


@pytest.mark.parametrize("values_per_row", [1, 100])
def test_conditions_hold_for_whole_entities(spark, values_per_row):
    """Also where every value of an entity is in a part of its own."""
    nodes = store_by_type(reduce_documents(statements(spark, DATA), values_per_row=values_per_row), {"C", "N"})
    pairs = list(itertools.combinations(CONDITIONS, 2))  # some of them, with every condition in one at least
    for conditions in [(m,) for m in CONDITIONS[:3]] + pairs[::6]:
        for every in (True, False):
            framed = frame_documents(nodes, Frame("C", where=conditions, require_all=every))
            found = sorted({r["uri"] for r in framed.select("uri").collect()})
            assert found == by_hand(conditions, every), (conditions, every)


def test_targets_that_do_not_match_stay_references(spark):
    nodes = reduce_documents(statements(spark, DATA))
    frame = Frame("C", {"n": Frame("N", where=(Match("old", absent=True),))}, where=(Match("n"),))
    for limit in (None, 1):
        framed = {r["uri"]: r for r in frame_documents(nodes, frame, limit).collect()}
        assert set(framed) == {"a", "b", "c"}
        assert [x["uri"] for x in framed["c"]["n"]] == ["n1"] and [x["v"] for x in framed["c"]["props"]["n"]] == ["n2"]
        assert framed["b"]["n"] is None and [x["v"] for x in framed["b"]["props"]["n"]] == ["n2"]


@pytest.mark.parametrize("values_per_row", [1, 100])
def test_defaults_are_for_what_is_not_there(spark, values_per_row):
    nodes = reduce_documents(statements(spark, DATA), values_per_row=values_per_row)
    framed = frame_documents(nodes, Frame("C", defaults={"seg": "none", "tag": "-"}))
    found = {}
    for r in framed.collect():
        for p in ("seg", "tag"):
            found.setdefault((r["uri"], p), []).extend(x["v"] for x in r["props"].get(p, []))
    assert {k: sorted(v) for k, v in found.items()} == {
        ("a", "seg"): ["x"], ("a", "tag"): ["é\t\""], ("b", "seg"): ["y", "z"], ("b", "tag"): ["-"],
        ("c", "seg"): ["none"], ("c", "tag"): ["\U0001f600"], ("d", "seg"): ["none"], ("d", "tag"): ["-"],
    }


def test_one_filter_and_no_shuffle_for_small_documents(spark):
    stored = store_by_type(reduce_documents(statements(spark, DATA)), {"C"})["C"].drop("parts")
    text = plan(frame_documents(stored, Frame("C", where=(Match("seg", ("x",)), Match("tag")))))
    assert "Exchange" not in text and text.count("Filter") >= 1


def test_json_form():
    frame = Frame("C", {"n": Frame("N")}, where=(Match("seg", ("x",)), Match("tag"), Match("old", absent=True)), require_all=False, defaults={"seg": "y"})
    assert Frame.from_dict(frame.to_dict()) == frame
    text = '{"@type": "C", "@where": {"seg": ["x"], "tag": {}, "old": []}, "@requireAll": false, "seg": {"@default": "y"}, "n": {"@type": "N"}}'
    assert Frame.from_json(text) == frame
    with pytest.raises(ValueError):
        Frame.from_json('{"@type": "C", "@where": {"seg": "x"}}')

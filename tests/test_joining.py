"""Links between the rows of two inputs, against pairs by hand."""

import pytest
from helpers import plan, rows

from ldspark.operators.joining import apply_joined_model, join_graph
from ldspark.plans import RDF_TYPE, JoinedModel, JoinLink, Model, Node

ORDERS = Model("http://x/", "order", [
    Node("order", "Order", "order/{id}", {"note": "note"}, {"by": "buyer"}),
    Node("buyer", "Buyer", "buyer/{who}"),
])
LINES = Model("http://x/", "line", [Node("line", "Line", "line/{order}/{n}")])
LINKS = [
    JoinLink("of", ("line", "line"), ("order", "order"), [("order", "id")]),
    JoinLink("has", ("order", "order"), ("line", "line"), [("id", "order")]),
    JoinLink("bought", ("order", "buyer"), ("line", "line"), [("id", "order")]),
    JoinLink("like", ("line", "line"), ("line", "line"), [("n", "n")]),
]
MODEL = JoinedModel({"order": ORDERS, "line": LINES}, LINKS)
O = [(1, "a b", "é\t\"\\\n"), (2, None, "\U0001f600"), (None, "c", None), (4, "a b", None), (1, "a b", "é\t\"\\\n")]
L = [(1, 1), (1, 2), (2, 1), (None, 1), (9, 3), (1, 1), (2, None)]


def frames(spark, line_type="BIGINT"):
    order = spark.createDataFrame(O, "id BIGINT, who STRING, note STRING")
    return {"order": order, "line": spark.createDataFrame(L, "order BIGINT, n BIGINT").selectExpr(f"CAST(order AS {line_type}) AS order", "n")}


def by_hand():
    out = set()
    lines = {(o, n) for o, n in L if o is not None and n is not None}
    for oid, who, _ in set(O):
        for o, n in lines:
            if oid is not None and o == oid:
                line, order = f"http://x/line/{o}/{n}", f"http://x/order/{oid}"
                out |= {(line, "of", order, "iri"), (order, "has", line, "iri")}
                if who is not None:
                    out.add((f"http://x/buyer/{who.replace(' ', '%20')}", "bought", line, "iri"))
    out |= {(f"http://x/line/{a}/{n}", "like", f"http://x/line/{b}/{m}", "iri") for a, n in lines for b, m in lines if n == m}
    return sorted(out)


@pytest.mark.parametrize("line_type", ["BIGINT", "INT", "STRING"])
def test_links_are_the_pairs_that_agree(spark, line_type):
    found = apply_joined_model(frames(spark, line_type), MODEL)
    linked = found.filter("p IN ('of', 'has', 'bought', 'like')")
    assert rows(linked) == by_hand()
    own = found.filter(f"p = '{RDF_TYPE}' AND o = 'Order'")
    assert own.count() == 4, "the inputs' own statements are a bag, a row's each"


def test_links_over_the_same_columns_are_one_join(spark):
    graph = join_graph(LINKS)
    assert sorted(len(links) for links in graph.values()) == [1, 3]
    several = JoinLink("x", ("a", "n"), ("b", "m"), [("p", "q"), ("r", "s")])
    turned = JoinLink("y", ("b", "m"), ("a", "n"), [("s", "r"), ("q", "p")])
    assert len(join_graph([several, turned])) == 1
    text = plan(apply_joined_model(frames(spark), JoinedModel(MODEL.inputs, LINKS[:3])))
    joins = [line for line in text.splitlines() if "Join" in line and "_salt" in line]
    assert len(joins) == 1, text


def test_hot_keys_are_joined_in_several_tasks(spark):
    order = spark.range(3).selectExpr("id", "CAST(id AS STRING) AS who", "CAST(NULL AS STRING) AS note")
    line = spark.range(3000).selectExpr("IF(id % 3 = 0, id % 2, 0) AS order", "id AS n")
    model = JoinedModel(MODEL.inputs, LINKS[:2])
    found = apply_joined_model({"order": order, "line": line}, model, rows_per_task=100).filter("p IN ('of', 'has')")
    assert found.count() == found.distinct().count() == 6000


def test_several_columns(spark):
    a = spark.createDataFrame([("x", "yz", 1), ("xy", "z", 2), (None, "z", 3)], "p STRING, q STRING, n INT")
    model = JoinedModel(
        {"a": Model("u:", "n", [Node("n", "N", "{n}")]), "b": Model("v:", "n", [Node("n", "N", "{n}")])},
        [JoinLink("same", ("a", "n"), ("b", "n"), [("p", "p"), ("q", "q")])],
    )
    found = apply_joined_model({"a": a, "b": a}, model).filter("p = 'same'")
    assert rows(found) == [("u:1", "same", "v:1", "iri"), ("u:2", "same", "v:2", "iri")]


def test_empty_inputs_and_wrong_models(spark):
    empty = {k: df.limit(0) for k, df in frames(spark).items()}
    assert apply_joined_model(empty, MODEL).isEmpty()
    with pytest.raises(ValueError, match="inputs"):
        apply_joined_model({"order": empty["order"]}, MODEL)
    for wrong in (
        JoinLink("x", ("order", "nobody"), ("line", "line"), [("id", "order")]),
        JoinLink("x", ("order", "order"), ("lines", "line"), [("id", "order")]),
        JoinLink("x", ("order", "order"), ("line", "line"), []),
    ):
        with pytest.raises(ValueError):
            JoinedModel(MODEL.inputs, [wrong])


def test_from_json():
    text = """{"inputs": {"a": {"base": "u:", "root": "n", "nodes": [{"id": "n", "cls": "N", "subject": "{n}"}]}},
    "links": [{"predicate": "p", "source": ["a", "n"], "target": ["a", "n"], "on": [["x", "y"]]}]}"""
    model = JoinedModel.from_json(text)
    assert model.links == [JoinLink("p", ("a", "n"), ("a", "n"), (("x", "y"),))] and model.inputs["a"].base == "u:"

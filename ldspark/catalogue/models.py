"""Models, context and frames over the test tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ldspark.operators import apply_model, reduce_statements, store_by_type, store_colocated, to_nodes
from ldspark.operators.framing import Colocated
from ldspark.operators.skew import spread_rows
from ldspark.plans import Field, Frame, FrameRule, FrameRules, FullContext, Iri, JoinedModel, JoinLink, JsonPath, Match, Model, Node, Template
from ldspark.session import materialize

BASE = "http://data.example.org/"
VOCAB = "http://vocab.example.org/"
MONEY = "decimal(18,2)"


def v(name: str) -> str:
    return VOCAB + name


CONTEXT = {
    name: v(name)
    for name in (
        "Customer", "Supplier", "Nation", "Region", "Order",
        "name", "segment", "balance", "nation", "region", "customer", "status", "orders",
    )
}


FULL_CONTEXT = FullContext.from_json(
    json.dumps(
        {
            "@context": {
                "@vocab": VOCAB,
                "@base": BASE,
                "v": VOCAB,
                "Event": {"@id": "v:Event", "@context": {"kind": "v:eventKind"}},
                "user": {"@id": "v:user", "@type": "@id"},
                "nation": {"@id": "v:nation", "@type": "@id"},
                "tags": {"@id": "v:tags", "@container": "@list"},
                "label": {"@id": "v:label", "@container": "@language"},
                "segment": {"@id": "v:segment", "@type": "@vocab"},
            }
        }
    )
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table, or some of its columns, in tasks that are small enough to map."""
    return spread_rows(table(spark, sf_dir, name).select(*(columns or "*")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped_table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast(MONEY))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped_table(spark, sf_dir, "supplier").withColumn("s_acctbal", F.col("s_acctbal").cast(MONEY))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = mapped_table(spark, sf_dir, "orders")
    return df.withColumn("o_totalprice", F.col("o_totalprice").cast(MONEY))


def order_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What documents of orders and their customers are made of; no other column is moved."""
    return mapped_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")


CUSTOMER = Model(
    base=BASE,
    root="customer",
    nodes=[
        Node(
            "customer",
            v("Customer"),
            "customer/{c_custkey}",
            props={v("name"): "c_name", v("segment"): "c_mktsegment", v("balance"): "c_acctbal"},
            links={v("nation"): "nation"},
        ),
        Node("nation", v("Nation"), "nation/{c_nationkey}"),
    ],
)

SUPPLIER = Model(
    base=BASE,
    root="supplier",
    nodes=[
        Node(
            "supplier",
            v("Supplier"),
            "supplier/{s_suppkey}",
            props={v("name"): "s_name", v("balance"): "s_acctbal"},
            links={v("nation"): "nation"},
        ),
        Node("nation", v("Nation"), "nation/{s_nationkey}"),
    ],
)

NATION = Model(
    base=BASE,
    root="nation",
    nodes=[
        Node(
            "nation",
            v("Nation"),
            "nation/{n_nationkey}",
            props={v("name"): "n_name"},
            links={v("region"): "region"},
        ),
        Node("region", v("Region"), "region/{n_regionkey}"),
    ],
)

REGION = Model(
    base=BASE,
    root="region",
    nodes=[Node("region", v("Region"), "region/{r_regionkey}", props={v("name"): "r_name"})],
)

ORDER = Model(
    base=BASE,
    root="order",
    nodes=[
        Node(
            "order",
            v("Order"),
            "order/{o_orderkey}",
            props={v("status"): "o_orderstatus", v("date"): "o_orderdate", v("total"): "o_totalprice"},
            links={v("customer"): "customer"},
        ),
        Node("customer", v("Customer"), "customer/{o_custkey}"),
        Node("clerk", v("Clerk"), "clerk/{o_orderpriority}", links={v("order"): "order"}),
    ],
)

ORDER_PRIORITY = Model(
    base=BASE,
    root="priority",
    nodes=[
        Node(
            "priority",
            v("Priority"),
            "priority/{o_orderpriority}",
            props={v("label"): "o_orderpriority"},
            links={v("order"): "order"},
        ),
        Node("order", v("Order"), "order/{o_orderkey}"),
    ],
)

CUSTOMER_ACTIVITY = Model(
    base=BASE,
    root="customer",
    nodes=[
        Node(
            "customer",
            v("Customer"),
            "customer/{o_custkey}",
            props={
                v("largest"): "o_totalprice",
                v("first"): "o_orderdate",
                v("status"): "o_orderstatus",
            },
        )
    ],
)

CUSTOMER_ORDERS = Model(
    base=BASE,
    root="customer",
    nodes=[
        Node("customer", "Customer", "customer/{o_custkey}", links={"orders": "order"}),
        Node("order", "Order", "order/{o_orderkey}", props={"status": "o_orderstatus"}),
    ],
)

STATUS_ORDERS = Model(
    base=BASE,
    root="status",
    nodes=[
        Node("status", "Status", "status/{o_orderstatus}", links={"orders": "order"}),
        Node("order", "Order", "order/{o_orderkey}"),
    ],
)

ORDER_AND_CUSTOMER = Model(
    base=BASE,
    root="order",
    nodes=[
        Node("order", "Order", "order/{o_orderkey}", props={"status": "o_orderstatus"}, links={"customer": "customer"}),
        Node("customer", "Customer", "customer/{o_custkey}", links={"orders": "order"}),
    ],
)

LINE = Model(
    base=BASE,
    root="line",
    nodes=[Node("line", v("Line"), "order/{l_orderkey}/line/{l_linenumber}", props={v("quantity"): "l_quantity"})],
)

ORDER_LINES = JoinedModel(
    {"order": ORDER_AND_CUSTOMER, "line": LINE, "customer": CUSTOMER},
    [
        JoinLink(v("line"), ("order", "order"), ("line", "line"), [("o_orderkey", "l_orderkey")]),
        JoinLink(v("boughtBy"), ("line", "line"), ("order", "customer"), [("l_orderkey", "o_orderkey")]),
        JoinLink(v("buyerNation"), ("order", "order"), ("customer", "nation"), [("o_custkey", "c_custkey")]),
    ],
)

PART_WORDS = Model(
    base=BASE,
    root="part",
    nodes=[
        Node(
            "part",
            [v("Part"), v("Product")],
            "part/{p_partkey}",
            props={
                v("word"): "words",
                v("brand"): Iri(Template("http://brand.example.org/{p_brand}")),
                v("label"): Template("{p_name}/{p_type}"),
            },
        )
    ],
)

PART_WORD_ENTITIES = Model(
    base=BASE,
    root="part",
    nodes=[
        Node("part", v("Part"), "part/{p_partkey}", links={v("word"): "word"}),
        Node("word", v("Word"), "word/{_}", {v("text"): "_"}, {v("usedBy"): "part"}, each="words"),
    ],
)

PART_TREE = Model(
    base=BASE,
    root="part",
    nodes=[
        Node("part", "Part", "part/{p_partkey}", {"name": "p_name"}, {"above": "above"}),
        Node("above", "Part", "part/{above}"),
    ],
)

EVENT = Model(
    base=BASE,
    root="event",
    nodes=[
        Node(
            "event",
            v("Event"),
            "event/{event_id}",
            props={v("k"): JsonPath("props", "$.k"), v("kind"): "event_type", v("at"): "ts"},
            links={v("user"): "user"},
        ),
        Node("user", v("User"), "user/{user_id}"),
    ],
)

USER_EVENTS = Model(
    base=BASE,
    root="user",
    nodes=[
        Node("user", "User", "user/{user_id}", links={"event": "event"}),
        Node("event", "Event", "event/{event_id}"),
    ],
)

PAGE = Model(
    base=BASE,
    root="page",
    nodes=[Node("page", v("WebPage"), Field("url"), props={v("id"): "page_id"})],
)

CUSTOMER_FRAME = Frame("Customer", {"nation": Frame("Nation")})
SUPPLIER_FRAME = Frame("Supplier", {"nation": Frame("Nation")})
DEEP_FRAME = Frame("Customer", {"nation": Frame("Nation", {"region": Frame("Region")})})
ORDERS_FRAME = Frame("Customer", {"orders": Frame("Order")})
STATUS_FRAME = Frame("Status", {"orders": Frame("Order")})
CHOSEN_FRAME = Frame(
    "Customer",
    {"nation": Frame("Nation", where=(Match("name", ("NATION_1", "NATION_2", "NATION_3")), Match("region")))},
    where=(Match("segment", ("BUILDING", "MACHINERY")), Match("closed", absent=True), Match("name")),
    defaults={"rating": "none", "segment": "unknown"},
)
PART_RULES = FrameRules("part", {"part": FrameRule("Part", {"above": "part"})})
BACK_FRAME = Frame("Order", {"customer": Frame("Customer", keep=("name",))})


def entity_statements(spark: SparkSession, sf_dir: str, context: dict[str, str] | None = None) -> DataFrame:
    """Reduced statements of customers, suppliers, nations and regions."""
    return reduce_statements(
        apply_model(customers(spark, sf_dir), CUSTOMER, context=context),
        apply_model(suppliers(spark, sf_dir), SUPPLIER, context=context),
        apply_model(table(spark, sf_dir, "nation"), NATION, context=context),
        apply_model(table(spark, sf_dir, "region"), REGION, context=context),
    )


def entity_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Their documents under the short names, written once."""
    return materialize(to_nodes(entity_statements(spark, sf_dir, CONTEXT)), "nodes")


def entity_types(spark: SparkSession, sf_dir: str, *frames: Frame) -> dict[str, DataFrame]:
    """The same documents, written once by type for the frames to read."""
    classes = set().union(*[f.types() for f in frames])
    return store_by_type(to_nodes(entity_statements(spark, sf_dir, CONTEXT)), classes)


def colocated_types(spark: SparkSession, sf_dir: str, frame: Frame) -> Colocated:
    """The same documents in a table bucketed by document."""
    return store_colocated(entity_nodes(spark, sf_dir), frame.types())


def order_types(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    statements = reduce_statements(apply_model(order_links(spark, sf_dir), CUSTOMER_ORDERS))
    return store_by_type(to_nodes(statements), ORDERS_FRAME.types())


def status_types(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    statements = reduce_statements(apply_model(order_links(spark, sf_dir), STATUS_ORDERS))
    return store_by_type(to_nodes(statements), STATUS_FRAME.types())


def back_link_types(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders that name their customer, and customers that list all their orders."""
    statements = reduce_statements(
        apply_model(order_links(spark, sf_dir), ORDER_AND_CUSTOMER),
        apply_model(customers(spark, sf_dir), CUSTOMER, context=CONTEXT),
    )
    return store_by_type(to_nodes(statements), BACK_FRAME.types())


def part_tree_types(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Parts that name the one above them: four to one, and the first three in a ring."""
    n = F.col("p_partkey")
    above = F.when(n < 3, n + 1).when(n == 3, 1).otherwise(F.floor(n / 4))
    statements = reduce_statements(apply_model(table(spark, sf_dir, "part").withColumn("above", above), PART_TREE))
    return store_by_type(to_nodes(statements), {"Part"})

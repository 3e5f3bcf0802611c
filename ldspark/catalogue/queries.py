"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ldspark import operators as ops, sinks, sources, streaming
from ldspark.catalogue import models as m
from ldspark.functions import drop_json_fields, json_value
from ldspark.plans import Iri, Model, Node, Template
from ldspark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def json_text(*columns) -> F.Column:
    return F.to_json(F.struct(*columns))


def joined_values(nodes: DataFrame) -> DataFrame:
    return nodes.select("uri", "part", F.explode("props").alias("p", "vals")).select(
        "uri", "part", "p", F.array_join(F.transform("vals", lambda x: x["v"]), "|").alias("vals")
    )


# --- sources and sinks -------------------------------------------------------


@query
def kv_text_roundtrip(spark, sf_dir):
    events = m.table(spark, sf_dir, "events")
    path = scratch_path(spark, "kv")
    sinks.write_kv_text(
        events.select(F.col("event_id").cast("string").alias("key"), F.col("props").alias("value")),
        path,
    )
    return sources.read_records(spark, path, "text")


@query
def sequence_roundtrip(spark, sf_dir):
    pages = m.table(spark, sf_dir, "pages")
    path = scratch_path(spark, "sequence")
    sinks.write_sequence(
        pages.select(F.col("url").alias("key"), json_text("page_id", "html").alias("value")), path
    )
    doc = F.from_json("value", "page_id BIGINT, html STRING")
    return sources.read_records(spark, path, "sequence").select(
        F.col("key").alias("url"), doc["page_id"].alias("page_id"), doc["html"].alias("html")
    )


@query
def json_lines_key(spark, sf_dir):
    events = m.table(spark, sf_dir, "events")
    path = scratch_path(spark, "json-lines")
    lines = events.select(
        json_text("event_id", "event_type", F.parse_json("props").alias("props")).alias("line")
    )
    sinks.write_lines(lines, path)
    keyed, _ = ops.key_by_field(sources.read_records(spark, path, "json"), "$.event_id")
    return keyed.select(
        "key",
        json_value(F.col("doc"), "$.props.k", "bigint").alias("k"),
        json_value(F.col("doc"), "$.event_type").alias("event_type"),
    )


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    customers = m.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    sinks.write_csv(customers, path, sep="\t")
    return sources.read_records(spark, path, "csv", sep="\t", schema=customers.schema)


@query
def index_query(spark, sf_dir):
    found = sources.read_index(
        spark,
        f"{sf_dir}/orders.parquet",
        (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000),
    )
    return found.select("o_orderkey", "o_custkey")


@query
def docs_to_cells(spark, sf_dir):
    return part_cells(spark, sf_dir)


def part_cells(spark, sf_dir):
    part = m.table(spark, sf_dir, "part").withColumn(
        "p_retailprice", F.col("p_retailprice").cast(m.MONEY)
    )
    columns = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    return ops.docs_to_cells(part, "p_partkey", "f", columns)


@query
def cells_to_docs(spark, sf_dir):
    docs = ops.cells_to_docs(part_cells(spark, sf_dir))
    return docs.select(
        "row_key",
        "part",
        F.col("cells")["f:p_brand"].alias("p_brand"),
        F.col("cells")["f:p_type"].alias("p_type"),
        F.size("cells").alias("n_cells"),
    )


@query
def cells_to_columns(spark, sf_dir):
    return ops.cells_to_columns(
        part_cells(spark, sf_dir), [("f", "p_brand"), ("f", "p_type"), ("f", "p_size")]
    )


@query
def cells_two_families(spark, sf_dir):
    """One qualifier in two families, and a row key that has it in one of them only."""
    some = m.table(spark, sf_dir, "part").filter("p_size > 25")
    more = ops.docs_to_cells(some.select("p_partkey", F.col("p_type").alias("p_brand")), "p_partkey", "g", ["p_brand"])
    cells = ops.union_all(part_cells(spark, sf_dir), more)
    return ops.cells_to_columns(cells, [("f", "p_brand"), ("g", "p_brand")]).withColumnsRenamed(
        {"f:p_brand": "f_brand", "g:p_brand": "g_brand"}
    )


@query
def scan_cells(spark, sf_dir):
    """A scan of one row-key range, as a store's scan settings ask for it."""
    return ops.scan_cells(part_cells(spark, sf_dir), start="1", stop="3", families=["f"])


@query
def cells_clustered(spark, sf_dir):
    """The same range from cells clustered by row key, of which it reads only some files."""
    path = scratch_path(spark, "clustered")
    cells = part_cells(spark, sf_dir)
    ops.write_clustered(cells, path, files=16)
    return ops.read_clustered(spark, path, cells.schema, start="1", stop="3", families=["f"])


@query
def cells_versions(spark, sf_dir):
    """The last two values of each cell from version 100 on, where some events take back a row, a column or themselves."""
    events = m.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("row_key"),
        F.lit("e").alias("family"),
        F.col("event_type").alias("qualifier"),
        F.col("event_id").alias("version"),
        json_value(F.parse_json("props"), "$.k").alias("value"),
    )
    kind = F.col("version") % 40
    op = F.when(kind == 0, "delete_row").when(kind == 1, "delete_column").when(kind == 2, "delete_version")
    markers = events.filter(kind < 3).withColumn("op", op)
    return ops.latest_versions(events.withColumn("op", F.lit("put")).unionByName(markers), versions=2, since=100)


@query
def cell_lines(spark, sf_dir):
    return ops.cell_lines(m.table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def cell_documents(spark, sf_dir):
    events = m.table(spark, sf_dir, "events").select(
        "event_id", F.concat_ws("\n", "props", json_text(F.col("user_id").alias("k"))).alias("cell")
    )
    docs = ops.cell_documents(events, "event_id", "cell")
    return docs.select("event_id", json_value(F.col("doc"), "$.k", "bigint").alias("k"))


@query
def upsert_by_id(spark, sf_dir):
    target = m.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("v")
    )
    seen = m.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("v"),
        F.col("o_orderdate").alias("at"),
        F.col("o_orderkey").alias("n"),
    )
    latest = ops.latest_by_id(seen, "id", ["at", "n"]).select("id", "v")
    return ops.upsert_by_id(target, latest, "id")


@query
def bulk_load_by_id(spark, sf_dir):
    """JSON documents loaded by an identifier inside them, one field dropped, over what is stored already."""
    pages = m.table(spark, sf_dir, "pages")
    texts = pages.select(
        json_text(F.col("page_id").alias("id"), "url", F.col("html").alias("body")).alias("value")
    )
    keyed, _ = ops.key_by_field(texts, "$.id")
    documents = keyed.select(
        F.col("key").alias("id"), drop_json_fields(F.col("value"), "body").alias("value")
    )
    old = json_text(F.lit("old").alias("url"), F.lit("old").alias("body")).alias("value")
    stored = m.table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("id"), old).distinct()
    doc = F.parse_json("value")
    return ops.upsert_by_id(stored, documents, "id").select(
        "id", json_value(doc, "$.url").alias("url"), json_value(doc, "$.body").alias("body")
    )


@query
def load_rejects(spark, sf_dir):
    """Records that cannot be loaded, for want of JSON or of an identifier, set apart and not lost."""
    text = (
        F.when(F.col("event_id") % 5 == 0, F.format_string('{"id": %d', "event_id"))
        .when(F.col("event_id") % 5 == 1, F.format_string('{"n": %d}', "event_id"))
        .otherwise(F.format_string('{"id": %d}', "event_id"))
    )
    events = m.table(spark, sf_dir, "events").select(text.alias("value"))
    keyed, rejects = ops.key_by_field(events, "$.id")
    good = keyed.select(F.lit("loaded").alias("state"), "key", "value")
    return good.unionByName(rejects.select(F.lit("rejected").alias("state"), F.lit(None).cast("string").alias("key"), "value"))


@query
def alias_view(spark, sf_dir):
    c = m.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), "c_mktsegment"
    )
    s = m.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey")
    )
    return ops.swap_alias(spark, "parties", [c, s]).select(
        "name", "nationkey", F.col("c_mktsegment").alias("segment")
    )


# --- stores ------------------------------------------------------------------


def customer_store(spark, sf_dir):
    rows = m.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("v"))
    return ops.create_store(rows, scratch_path(spark, "store"), "id", buckets=16)


@query
def store_upsert(spark, sf_dir):
    """Customers in buckets by key; the last order of those that have one replaces them, in its own buckets."""
    store = customer_store(spark, sf_dir)
    seen = m.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("v"),
        F.col("o_orderdate").alias("at"),
        F.col("o_orderkey").alias("n"),
    )
    return ops.upsert_store(store, seen, ["at", "n"]).read()


@query
def store_delete(spark, sf_dir):
    """Customers with an order deleted, and what an earlier version still has of those with a large one."""
    store = customer_store(spark, sf_dir)
    orders = m.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), "o_totalprice")
    left = ops.delete_from_store(store, orders).read().select(F.lit("left").alias("state"), "id", "v")
    found = ops.open_store(spark, store.path, 1).lookup(orders.filter("o_totalprice > 400000"))
    return left.unionByName(found.select(F.lit("found").alias("state"), "id", "v"))


@query
def alias_versions(spark, sf_dir):
    """What a reader sees that opened an alias before it was pointed elsewhere, one after that, and after going back."""
    folder = scratch_path(spark, "aliased")
    for name, key in (("customer", "c"), ("supplier", "s")):
        rows = m.table(spark, sf_dir, name)
        rows.select(F.col(f"{key}_name").alias("name"), F.col(f"{key}_nationkey").alias("nationkey")).write.parquet(
            f"{folder}/{name}"
        )
    alias = f"{folder}/parties"
    ops.set_alias(spark, alias, [f"{folder}/customer"])
    before = ops.open_alias(spark, alias)
    ops.set_alias(spark, alias, [f"{folder}/supplier", f"{folder}/customer"], based_on=1)
    after = ops.open_alias(spark, alias)
    ops.restore_alias(spark, alias, 1)
    back = ops.open_alias(spark, alias)
    return ops.union_all(
        *[df.select(F.lit(when).alias("reader"), "name", "nationkey") for when, df in (("before", before), ("after", after), ("back", back))]
    )


# --- records -----------------------------------------------------------------


@query
def drop_field(spark, sf_dir):
    orders = m.orders(spark, sf_dir).select(
        json_text("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("value")
    )
    kept = orders.select(drop_json_fields(F.col("value"), "o_orderpriority").alias("value"))
    doc = F.parse_json("value")
    return kept.select(
        json_value(doc, "$.o_orderkey", "bigint").alias("o_orderkey"),
        json_value(doc, "$.o_custkey", "bigint").alias("o_custkey"),
        json_value(doc, "$.o_orderstatus").alias("o_orderstatus"),
        F.array_join(F.json_object_keys("value"), ",").alias("fields"),
    )


@query
def filter_uris_isin(spark, sf_dir):
    wanted = [f"{m.BASE}customer/{n}" for n in (1, 7, 42)]
    return ops.keep_keys(ops.apply_model(m.customers(spark, sf_dir), m.CUSTOMER), wanted, "s")


@query
def filter_uris_semi(spark, sf_dir):
    big = m.table(spark, sf_dir, "orders").filter("o_totalprice > 400000")
    wanted = big.select(
        F.concat(F.lit(f"{m.BASE}customer/"), F.col("o_custkey").cast("string")).alias("uri")
    )
    return ops.keep_keys(ops.apply_model(m.customers(spark, sf_dir), m.CUSTOMER), wanted, "s")


# --- mapping -----------------------------------------------------------------


@query
def apply_model_statements(spark, sf_dir):
    return ops.apply_model(m.customers(spark, sf_dir), m.CUSTOMER)


@query
def apply_model_root(spark, sf_dir):
    return ops.apply_model(m.orders(spark, sf_dir), m.ORDER)


@query
def apply_model_links(spark, sf_dir):
    statements = ops.apply_model(m.orders(spark, sf_dir), m.ORDER)
    return statements.filter("kind = 'iri'").select("s", "p", "o")


@query
def apply_model_docs(spark, sf_dir):
    return joined_values(ops.model_documents(m.customers(spark, sf_dir), m.CUSTOMER))


@query
def documents_json(spark, sf_dir):
    statements = ops.apply_model(m.suppliers(spark, sf_dir), m.SUPPLIER, context=m.CONTEXT)
    return ops.flat_document_json(ops.to_nodes(ops.distinct_statements(statements)))


@query
def documents_to_statements(spark, sf_dir):
    """Framed documents taken apart again: nested documents become their own."""
    documents = frame_json(spark, sf_dir)
    return ops.distinct_statements(ops.document_statements(documents, "uri"))


@query
def apply_model_ntriples(spark, sf_dir):
    texts = m.table(spark, sf_dir, "documents")
    model = Model(
        m.BASE,
        "doc",
        [
            Node(
                "doc",
                m.v("Document"),
                "doc/{doc_id}",
                props={
                    m.v("text"): "text",
                    m.v("source"): Iri(Template("http://source.example.org/{source}")),
                },
            )
        ],
    )
    return ops.ntriples(ops.apply_model(texts, model))


@query
def csv_ntriples(spark, sf_dir):
    """Delimited text in, N-Triples lines out and back."""
    raw, out = scratch_path(spark, "tsv"), scratch_path(spark, "triples")
    customers = m.customers(spark, sf_dir)
    sinks.write_csv(customers, raw, sep="\t")
    rows = sources.read_records(spark, raw, "csv", sep="\t")
    sinks.write_lines(ops.ntriples(ops.apply_model(rows, m.CUSTOMER)), out)
    return sources.read_json_lines(spark, out).select(F.col("value").alias("line"))


@query
def apply_models_multi(spark, sf_dir):
    return ops.apply_models(m.orders(spark, sf_dir), [m.ORDER, m.ORDER_PRIORITY])


@query
def apply_model_arrays(spark, sf_dir):
    part = m.table(spark, sf_dir, "part").withColumn("words", F.split("p_name", " "))
    return ops.apply_model(part, m.PART_WORDS)


@query
def apply_model_each(spark, sf_dir):
    """An entity per element of a list, linked to and from the row's entity."""
    part = m.table(spark, sf_dir, "part").withColumn("words", F.split("p_name", " "))
    return ops.apply_model(part, m.PART_WORD_ENTITIES)


@query
def apply_model_json(spark, sf_dir):
    return ops.apply_model(m.table(spark, sf_dir, "events"), m.EVENT)


@query
def apply_model_absolute(spark, sf_dir):
    """Subjects that are identifiers already; the base is not put before them."""
    return ops.apply_model(m.table(spark, sf_dir, "pages"), m.PAGE)


@query
def apply_joined_models(spark, sf_dir):
    """Orders, their lines and their customers, and the links that rows of two of these make."""
    lines = m.table(spark, sf_dir, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast(m.MONEY))
    frames = {"order": m.orders(spark, sf_dir), "line": lines, "customer": m.customers(spark, sf_dir)}
    return ops.apply_joined_model(frames, m.ORDER_LINES)


@query
def apply_model_context(spark, sf_dir):
    return ops.apply_model(m.customers(spark, sf_dir), m.CUSTOMER, context=m.CONTEXT)


# --- union and reduce --------------------------------------------------------


@query
def union_all_statements(spark, sf_dir):
    return ops.union_all(
        ops.apply_model(m.customers(spark, sf_dir), m.CUSTOMER),
        ops.apply_model(m.suppliers(spark, sf_dir), m.SUPPLIER),
    )


@query
def distinct_statements(spark, sf_dir):
    return ops.distinct_statements(union_all_statements(spark, sf_dir))


@query
def reduce_by_uri(spark, sf_dir):
    return joined_values(ops.to_nodes(m.entity_statements(spark, sf_dir)))


@query
def reduce_single_valued(spark, sf_dir):
    statements = ops.apply_model(m.orders(spark, sf_dir), m.CUSTOMER_ACTIVITY)
    reduced = ops.reduce_statements(
        statements, single_valued={m.v("largest"): ("max", m.MONEY), m.v("first"): "min"}
    )
    return reduced.select(F.col("s").alias("uri"), "p", F.col("o").alias("v"))


@query
def reduce_large_entity(spark, sf_dir):
    """A few entities that hold a third of all values each, in parts, read back as one."""
    statements = ops.apply_model(m.orders(spark, sf_dir), m.STATUS_ORDERS)
    nodes = ops.reduce_documents(statements, values_per_row=100)
    return nodes.select("uri", "parts", F.explode("props").alias("p", "vals")).select(
        "uri", "parts", "p", F.explode("vals.v").alias("v")
    )


def loaded(spark, sf_dir):
    """Customers, suppliers, nations and regions as four loads of one collection."""
    inputs = {
        "customer": (m.customers(spark, sf_dir), m.CUSTOMER),
        "supplier": (m.suppliers(spark, sf_dir), m.SUPPLIER),
        "nation": (m.table(spark, sf_dir, "nation"), m.NATION),
        "region": (m.table(spark, sf_dir, "region"), m.REGION),
    }
    loads = {name: ops.apply_model(rows, model, context=m.CONTEXT) for name, (rows, model) in inputs.items()}
    return ops.add_loads(ops.create_collection(spark, scratch_path(spark, "collection"), buckets=8), loads)


def renamed_nations(spark, sf_dir):
    """Nations of one region under another name; the rest as it is."""
    name = F.when(F.col("n_regionkey") == 1, F.lower("n_name")).otherwise(F.col("n_name"))
    rows = m.table(spark, sf_dir, "nation").withColumn("n_name", name)
    return ops.apply_model(rows, m.NATION, context=m.CONTEXT)


@query
def incremental_reduce(spark, sf_dir):
    """Documents after one load was withdrawn and another replaced: those of the loads that are left."""
    collection = ops.withdraw_load(loaded(spark, sf_dir), "supplier")
    return joined_values(ops.replace_load(collection, "nation", renamed_nations(spark, sf_dir)).read_documents())


@query
def incremental_counts(spark, sf_dir):
    """How many loads state each statement, after one was withdrawn and added again."""
    collection = loaded(spark, sf_dir)
    load = collection.read_load("customer")
    return ops.add_load(ops.withdraw_load(collection, "customer"), "customer", load).read_statements()


# --- context -----------------------------------------------------------------


@query
def apply_context(spark, sf_dir):
    statements = ops.apply_model(m.customers(spark, sf_dir), m.CUSTOMER)
    return ops.apply_context(statements, m.CONTEXT).select("s", F.col("p").alias("term"), "o", "kind")


@query
def context_documents(spark, sf_dir):
    """Short names in stored JSON: numbers, order, repeats and the inline context stay as they are written."""
    text = F.format_string(
        f'{{"@id": "{m.BASE}event/%d", "@context": {{"k": {{"@id": "{m.v("k")}"}}}}, "@type": ["{m.v("Event")}", "Other"], '
        f'"{m.v("k")}": %s, "price": 1.50, "{m.v("tags")}": ["b", "a", "a", "{m.v("k")}"], '
        f'"in": {{"{m.v("kind")}": "%s", "@type": "{m.v("Event")}"}}}}',
        "event_id",
        "props",
        "event_type",
    )
    records = m.table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("key"), text.alias("value"))
    context = {**m.CONTEXT, **{name: m.v(name) for name in ("Event", "k", "kind", "tags")}}
    documents, _ = ops.context_documents(records, context)
    return documents


@query
def load_context(spark, sf_dir):
    """Context documents, one per part; only their object-valued terms count."""
    name = F.concat(F.lit("term"), F.col("p_partkey").cast("string"))
    text = F.format_string(
        '{"@context": {"%s": {"@id": "http://part.example.org/%d"}, '
        '"plain": "http://part.example.org/", "typed": {"@type": "@id"}}, "note": 1}',
        name,
        F.col("p_partkey"),
    )
    files = m.table(spark, sf_dir, "part").select(text.alias("text"))
    return ops.parse_contexts(files)


def written_records(spark, sf_dir):
    """Events and customers as JSON under a context: references, languages, lists, a name of its own for a class."""
    event = F.format_string(
        '{"@id": "event/%d", "@type": "Event", "user": "user/%d", "kind": "%s", "tags": ["b", "a", "b"], '
        '"label": {"en": "%s", "de": ["k%d"]}, "v:k": %s, "mine": {"@id": "v:x%d"}}',
        *("event_id", "user_id", "event_type", "event_type", "event_id"),
        json_value(F.parse_json("props"), "$.k"),
        "event_id",
    )
    customer = F.format_string(
        '{"@id": "customer/%d", "@type": "Customer", "name": "%s", "kind": "plain", "nation": ["nation/%d"], "segment": "%s"}',
        *("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
    )
    texts = [
        m.mapped_table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "props").select(event.alias("value")),
        m.mapped_table(spark, sf_dir, "customer").select(customer.alias("value")),
    ]
    return ops.union_all(*texts).select(F.lit("").alias("key"), "value")


@query
def context_expand(spark, sf_dir):
    return ops.expand_documents(written_records(spark, sf_dir), m.FULL_CONTEXT)


@query
def context_compact(spark, sf_dir):
    """The same documents written again from their statements."""
    return ops.compact_statements(context_expand(spark, sf_dir), m.FULL_CONTEXT)


# --- types and frames --------------------------------------------------------


@query
def partition_on_types(spark, sf_dir):
    wanted = [{"name": n, "uri": n} for n in ("Customer", "Supplier", "Nation")]
    split = ops.partition_on_types(m.entity_nodes(spark, sf_dir), wanted)
    return ops.union_all(
        *[df.select(F.lit(name).alias("type"), "uri") for name, df in split.items()]
    )


@query
def type_members(spark, sf_dir):
    names = ("Customer", "Supplier", "Nation")
    types = spark.createDataFrame([(n, m.v(n)) for n in names], "name STRING, uri STRING")
    return ops.type_members(m.entity_statements(spark, sf_dir), types)


def first(props: str, name: str):
    return F.col(props)[name][0]["v"]


@query
def frame_one_level(spark, sf_dir):
    framed = ops.frame_documents(m.entity_types(spark, sf_dir, m.CUSTOMER_FRAME), m.CUSTOMER_FRAME)
    return framed.select("uri", first("props", "name").alias("name"), F.explode_outer("nation").alias("n")).select(
        "uri",
        "name",
        F.col("n.uri").alias("nation_uri"),
        first("n.props", "name").alias("nation_name"),
    )


@query
def frame_two_level(spark, sf_dir):
    framed = ops.frame_documents(m.entity_types(spark, sf_dir, m.DEEP_FRAME), m.DEEP_FRAME)
    nations = framed.select("uri", first("props", "name").alias("name"), F.explode_outer("nation").alias("n"))
    return nations.select("uri", "name", F.col("n.uri").alias("nation_uri"), F.explode_outer("n.region").alias("r")).select(
        "uri", "name", "nation_uri", first("r.props", "name").alias("region_name")
    )


@query
def frame_colocated(spark, sf_dir):
    """The two-level frame over documents that stay where they are stored."""
    framed = ops.frame_documents(m.colocated_types(spark, sf_dir, m.DEEP_FRAME), m.DEEP_FRAME)
    nations = framed.select("uri", first("props", "name").alias("name"), F.explode_outer("nation").alias("n"))
    return nations.select("uri", "name", F.col("n.uri").alias("nation_uri"), F.explode_outer("n.region").alias("r")).select(
        "uri", "name", "nation_uri", first("r.props", "name").alias("region_name")
    )


@query
def frame_matching(spark, sf_dir):
    """Customers of two segments, with their nation where it is one of three; the others name it, all have a rating."""
    framed = ops.frame_documents(m.entity_types(spark, sf_dir, m.CHOSEN_FRAME), m.CHOSEN_FRAME)
    return framed.select(
        "uri",
        first("props", "segment").alias("segment"),
        first("props", "rating").alias("rating"),
        F.col("nation")[0]["props"]["name"][0]["v"].alias("nation_name"),
        first("props", "nation").alias("nation_uri"),
    )


@query
def frame_multi_root(spark, sf_dir):
    frames = {"customer": m.CUSTOMER_FRAME, "supplier": m.SUPPLIER_FRAME}
    framed = ops.apply_frames(m.entity_types(spark, sf_dir, *frames.values()), frames)
    return ops.union_all(
        *[
            df.select(F.lit(name).alias("root"), "uri", F.explode_outer("nation.uri").alias("nation_uri"))
            for name, df in framed.items()
        ]
    )


def embedded_and_listed(framed, prop):
    def listed(uris, embedded):
        return F.transform(
            F.coalesce(uris, F.array().cast("array<string>")),
            lambda u: F.struct(u.alias("order_uri"), F.lit(embedded).alias("embedded")),
        )

    left = F.transform(F.col("props")[prop], lambda x: x["v"])
    return framed.select("uri", F.inline(F.concat(listed(F.col(f"{prop}.uri"), True), listed(left, False))))


@query
def frame_capped(spark, sf_dir):
    """At most three embedded orders per customer; the rest stay references."""
    framed = ops.frame_documents(m.order_types(spark, sf_dir), m.ORDERS_FRAME, merge_limit=3)
    return embedded_and_listed(framed, "orders")


@query
def frame_capped_large(spark, sf_dir):
    """A limit above the one Spark ranks before the shuffle for, on parents that hold a third of the links each."""
    framed = ops.frame_documents(m.status_types(spark, sf_dir), m.STATUS_FRAME, merge_limit=1_200)
    return embedded_and_listed(framed, "orders")


@query
def frame_back_links(spark, sf_dir):
    """Customers embedded in their orders by name only, though each lists all its orders."""
    framed = ops.frame_documents(m.back_link_types(spark, sf_dir), m.BACK_FRAME)
    return framed.select("uri", F.explode_outer("customer").alias("c")).select(
        "uri",
        F.col("c.uri").alias("customer_uri"),
        first("c.props", "name").alias("name"),
        F.size("c.props").alias("n_props"),
    )


@query
def incremental_frames(spark, sf_dir):
    """Customers framed once, then brought up to date where a nation they show has another name."""
    collection = loaded(spark, sf_dir)
    framed = ops.create_framed(collection, scratch_path(spark, "framed"), {"customer": m.DEEP_FRAME}, buckets=8)
    later = ops.replace_load(collection, "nation", renamed_nations(spark, sf_dir))
    nations = ops.refresh_framed(framed, later).read("customer").select(
        "uri", first("props", "name").alias("name"), F.explode_outer("nation").alias("n")
    )
    return nations.select(
        "uri", "name", first("n.props", "name").alias("nation_name"), F.explode_outer("n.region").alias("r")
    ).select("uri", "name", "nation_name", first("r.props", "name").alias("region_name"))


@query
def frame_recursive(spark, sf_dir):
    """Parts that embed the part above them, as far as that goes; a ring ends where it would come round."""
    places = ops.expand_frames(m.part_tree_types(spark, sf_dir), m.PART_RULES).places()
    return places.select("root", F.col("depth").cast("bigint").alias("depth"), "uri")


@query
def frame_recursive_json(spark, sf_dir):
    return ops.recursive_document_json(ops.expand_frames(m.part_tree_types(spark, sf_dir), m.PART_RULES))


@query
def frame_json(spark, sf_dir):
    framed = ops.frame_documents(m.entity_types(spark, sf_dir, m.DEEP_FRAME), m.DEEP_FRAME)
    return ops.framed_document_json(framed, m.DEEP_FRAME)


@query
def write_frames(spark, sf_dir):
    """Frames written to one folder each, then read back."""
    frames = {"customer": m.CUSTOMER_FRAME, "supplier": m.SUPPLIER_FRAME}
    framed = ops.apply_frames(m.entity_types(spark, sf_dir, *frames.values()), frames)
    out = scratch_path(spark, "frames")
    names = sinks.write_frames(framed, frames, out)
    return ops.union_all(
        *[
            sources.read_records(spark, f"{out}/{name}", "text").select(
                F.lit(name).alias("frame"),
                "key",
                json_value(F.parse_json("value"), "$.nation.uri").alias("nation_uri"),
            )
            for name in names
        ]
    )


@query
def scan_frames(spark, sf_dir):
    """Frame files among others: named by file, other suffixes ignored."""
    c = m.table(spark, sf_dir, "customer").select(
        F.concat_ws("/", F.lit("file:/frames"), "c_mktsegment", F.concat("c_name", F.lit(".json"))).alias("path"),
        F.lit("{}").alias("text"),
    )
    s = m.table(spark, sf_dir, "supplier").select(
        F.concat_ws("/", F.lit("file:/frames"), F.concat("s_name", F.lit(".json.bak"))).alias("path"),
        F.lit("{}").alias("text"),
    )
    return ops.list_frames(c.unionByName(s)).select("name", "path")


@query
def pair_models_roots(spark, sf_dir):
    """A model file per customer, a root file for two segments' customers only."""
    c = m.table(spark, sf_dir, "customer")
    stem = F.concat_ws("/", F.lit("file:/models"), F.col("c_nationkey").cast("string"), "c_name")

    def files(rows, suffix, text):
        return rows.select(F.concat(stem, F.lit(suffix)).alias("path"), text.alias("text"))

    rooted = c.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    root = F.concat(F.lit(" \n"), F.lit(m.VOCAB), "c_mktsegment", F.lit("1\n"))
    every = ops.union_all(
        files(c, "-model.ttl", F.lit("# rules")),
        files(c, "-model.MD", F.lit("notes")),
        files(rooted, "-root.txt", root),
    )
    return ops.pair_models(every)


def customer_frames(spark, sf_dir):
    text = F.format_string(
        '{"@type": "%s", "home": {"@type": "Nation%d", "@context": {"x": {"@type": "@id"}}, '
        '"holder": {"@type": ["Party", "%s"]}}, "list": [{"@type": "Ignored"}]}',
        "c_mktsegment",
        "c_nationkey",
        "c_name",
    )
    return m.table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), text.alias("text"))


@query
def frame_types(spark, sf_dir):
    return ops.frame_types(customer_frames(spark, sf_dir))


@query
def types_with_uris(spark, sf_dir):
    c = m.table(spark, sf_dir, "customer")
    nation = F.concat(F.lit("Nation"), F.col("c_nationkey").cast("string"))
    terms = ops.union_all(
        *[
            c.select(term.alias("term"))
            for term in (F.col("c_mktsegment"), nation, F.lit("Party"), F.col("c_name"))
        ]
    ).distinct()
    context = terms.select("term", F.concat(F.lit(m.VOCAB), "term").alias("iri"))
    return ops.types_with_uris(ops.frame_types(customer_frames(spark, sf_dir)), context)


# --- streams -----------------------------------------------------------------


def event_files(spark, sf_dir):
    folder = scratch_path(spark, "event-files")
    events = m.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type", "props"
    )
    events.write.option("maxRecordsPerFile", 50_000).json(folder)
    stream = streaming.read_json_stream(spark, folder, events.schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_apply_model(spark, sf_dir):
    out = scratch_path(spark, "stream-statements")
    statements = ops.apply_model(event_files(spark, sf_dir), m.EVENT)
    streaming.write_stream(
        statements, "parquet", f"{out}-checkpoint", {"path": out}, available_now=True
    ).awaitTermination()
    return spark.read.schema(statements.schema).parquet(out)


@query
def stream_upsert(spark, sf_dir):
    out = scratch_path(spark, "stream-store")
    rows = event_files(spark, sf_dir).select("user_id", "ts", "event_id")
    streaming.upsert_stream(
        rows, out, f"{out}-checkpoint", "user_id", ["ts", "event_id"], available_now=True
    ).awaitTermination()
    stored = spark.read.parquet(out)
    return ops.read_latest(stored, "user_id", ["ts", "event_id"]).select("user_id", "event_id")


@query
def stream_files_as_messages(spark, sf_dir):
    """Files of customers published one message per file, then taken apart again."""
    folder, out = scratch_path(spark, "message-files"), scratch_path(spark, "messages")
    customers = m.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    customers.write.option("maxRecordsPerFile", 1_000).json(folder)
    streaming.publish_folder(
        spark, folder, "parquet", f"{out}-checkpoint", {"path": out},
        files_per_batch=1_000, available_now=True,
    ).awaitTermination()
    messages = spark.read.schema("key STRING, value STRING").parquet(out)
    docs = ops.cell_documents(messages, "key", "value").filter("doc IS NOT NULL")
    return docs.select(
        json_value(F.col("doc"), "$.c_custkey", "bigint").alias("c_custkey"),
        json_value(F.col("doc"), "$.c_name").alias("c_name"),
    )


def stored_documents(spark, sf_dir):
    out = scratch_path(spark, "stream-documents")
    streaming.upsert_documents_stream(
        event_files(spark, sf_dir), [m.EVENT], out, f"{out}-checkpoint", available_now=True
    ).awaitTermination()
    return ops.read_latest_documents(spark.read.parquet(out))


@query
def stream_upsert_documents(spark, sf_dir):
    """Events mapped and reduced per batch, the latest document kept per identifier."""
    return stored_documents(spark, sf_dir).select("key", "value")


@query
def stream_compact(spark, sf_dir):
    """The same store written anew as one batch."""
    path = scratch_path(spark, "compacted")
    ops.compact(stored_documents(spark, sf_dir), path)
    return ops.read_latest_documents(spark.read.parquet(path)).select("key", "value")


@query
def stream_upsert_shrink(spark, sf_dir):
    """Large documents of one stream replaced by small ones of another; no part of the old ones is left."""
    events = m.table(spark, sf_dir, "events").select("user_id", "event_id")
    firsts = events.groupBy("user_id").agg(F.min("event_id").alias("event_id"))
    store = scratch_path(spark, "shrinking")
    for n, rows in enumerate((events, firsts)):
        folder = scratch_path(spark, "user-events")
        rows.write.json(folder)
        stream = streaming.read_json_stream(spark, folder, rows.schema)
        streaming.upsert_documents_stream(
            stream, [m.USER_EVENTS], store, f"{store}-checkpoint-{n}", available_now=True, values_per_row=5
        ).awaitTermination()
    stored = ops.read_latest_documents(spark.read.parquet(store))
    return stored.filter(F.col("entity").contains("/user/")).select("entity", "parts", "value")


@query
def stream_merge_documents(spark, sf_dir):
    """Users whose events come in several batches: each batch adds to a user's document."""
    store = scratch_path(spark, "merging")
    folder = scratch_path(spark, "merged-files")
    m.table(spark, sf_dir, "events").select("user_id", "event_id").repartition(3, "event_id").write.json(folder)
    stream = streaming.read_json_stream(spark, folder, "user_id BIGINT, event_id BIGINT", files_per_batch=1)
    streaming.merge_documents_stream(stream, [m.USER_EVENTS], store, f"{store}-checkpoint", available_now=True).awaitTermination()
    nodes = ops.reduce_documents(ops.read_stated(spark.read.parquet(store)))
    return joined_values(nodes)

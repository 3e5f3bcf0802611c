"""SQL over the same tables whose rows each registered query must match."""

from __future__ import annotations

from ldspark.catalogue.models import BASE, VOCAB
from ldspark.plans import RDF_TYPE


def iri(path: str, key: str) -> str:
    return f"('{BASE}{path}/' || CAST({key} AS VARCHAR))"


def money(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18,2)) AS VARCHAR)"


def stamp(column: str) -> str:
    return f"replace(CAST({column} AS VARCHAR), ' ', 'T')"


def statements(table: str, rules: list[tuple[str, str, str, str]], vocab: str = VOCAB) -> str:
    """A UNION ALL of one SELECT per rule (subject, property, object, kind)."""
    selects = []
    for s, p, o, kind in rules:
        if kind == "type":
            p, o = f"'{RDF_TYPE}'", f"'{vocab}{o}'"
        else:
            p = f"'{vocab}{p}'"
        selects.append(f"SELECT {s} AS s, {p} AS p, {o} AS o, '{kind}' AS kind FROM {table}")
    return " UNION ALL ".join(selects)


C, CN = iri("customer", "c_custkey"), iri("nation", "c_nationkey")
S, SN = iri("supplier", "s_suppkey"), iri("nation", "s_nationkey")
N, NR = iri("nation", "n_nationkey"), iri("region", "n_regionkey")
R = iri("region", "r_regionkey")
O, OC = iri("order", "o_orderkey"), iri("customer", "o_custkey")
ST = f"('{BASE}status/' || o_orderstatus)"
OP = f"('{BASE}priority/' || url_encode(o_orderpriority))"

CUSTOMER = [
    (C, "", "Customer", "type"),
    (C, "nation", CN, "iri"),
    (C, "name", "c_name", "literal"),
    (C, "segment", "c_mktsegment", "literal"),
    (C, "balance", money("c_acctbal"), "literal"),
    (CN, "", "Nation", "type"),
]
SUPPLIER = [
    (S, "", "Supplier", "type"),
    (S, "nation", SN, "iri"),
    (S, "name", "s_name", "literal"),
    (S, "balance", money("s_acctbal"), "literal"),
    (SN, "", "Nation", "type"),
]
NATION = [
    (N, "", "Nation", "type"),
    (N, "region", NR, "iri"),
    (N, "name", "n_name", "literal"),
    (NR, "", "Region", "type"),
]
REGION = [(R, "", "Region", "type"), (R, "name", "r_name", "literal")]
ORDER = [
    (O, "", "Order", "type"),
    (O, "customer", OC, "iri"),
    (O, "status", "o_orderstatus", "literal"),
    (O, "date", stamp("o_orderdate"), "literal"),
    (O, "total", money("o_totalprice"), "literal"),
    (OC, "", "Customer", "type"),
]
PRIORITY = [
    (OP, "", "Priority", "type"),
    (OP, "order", O, "iri"),
    (OP, "label", "o_orderpriority", "literal"),
    (O, "", "Order", "type"),
]
ACTIVITY = [
    (OC, "largest", money("o_totalprice"), "literal"),
    (OC, "first", stamp("o_orderdate"), "literal"),
    (OC, "status", "o_orderstatus", "literal"),
]
E_, EU = iri("event", "event_id"), iri("user", "user_id")
EVENT = [
    (E_, "", "Event", "type"),
    (E_, "user", EU, "iri"),
    (E_, "k", "json_extract_string(props, '$.k')", "literal"),
    (E_, "kind", "event_type", "literal"),
    (E_, "at", stamp("ts"), "literal"),
    (EU, "", "User", "type"),
]
P = iri("part", "p_partkey")

customer_sql = statements("customer", CUSTOMER)
entity_sql = " UNION ALL ".join(
    [
        customer_sql,
        statements("supplier", SUPPLIER),
        statements("nation", NATION),
        statements("region", REGION),
    ]
)


def joined(sql: str) -> str:
    """Documents as one row per property with its sorted values."""
    return (
        "SELECT s AS uri, CAST(0 AS INTEGER) AS part, p, string_agg(o, '|' ORDER BY kind, o) AS vals "
        f"FROM (SELECT DISTINCT s, p, o, kind FROM ({sql})) WHERE kind <> 'type' GROUP BY s, p"
    )


def ntriples(sql: str) -> str:
    literal = "o"
    for raw, escaped in (
        ("'\\'", "'\\\\'"),
        ("'\"'", "'\\\"'"),
        ("chr(10)", "'\\n'"),
        ("chr(13)", "'\\r'"),
        ("chr(9)", "'\\t'"),
    ):
        literal = f"replace({literal}, {raw}, {escaped})"
    return (
        "SELECT '<' || s || '> <' || p || '> ' || CASE WHEN kind = 'literal' "
        f"THEN '\"' || {literal} || '\"' ELSE '<' || o || '>' END || ' .' AS line FROM ({sql})"
    )


def short(sql: str) -> str:
    return (
        f"SELECT s, CASE WHEN p = '{RDF_TYPE}' THEN p ELSE replace(p, '{VOCAB}', '') END AS p, "
        f"CASE WHEN kind = 'type' THEN replace(o, '{VOCAB}', '') ELSE o END AS o, kind FROM ({sql})"
    )


cells_sql = " UNION ALL ".join(
    f"SELECT CAST(p_partkey AS VARCHAR) AS row_key, 'f' AS family, '{c}' AS qualifier, {x} AS value FROM part"
    for c, x in (
        ("p_name", "p_name"),
        ("p_brand", "p_brand"),
        ("p_type", "p_type"),
        ("p_size", "CAST(p_size AS VARCHAR)"),
        ("p_retailprice", money("p_retailprice")),
    )
)
customer_nation = "customer JOIN nation ON c_nationkey = n_nationkey"
frame_type_sql = (
    "SELECT c_name AS name, c_mktsegment AS type FROM customer "
    "UNION SELECT c_name, 'Nation' || CAST(c_nationkey AS VARCHAR) FROM customer "
    "UNION SELECT c_name, 'Party' FROM customer UNION SELECT c_name, c_name FROM customer"
)

ORACLE: dict[str, str] = {
    "kv_text_roundtrip": "SELECT CAST(event_id AS VARCHAR) AS key, props AS value FROM events",
    "sequence_roundtrip": "SELECT url, page_id, html FROM pages",
    "json_lines_key": (
        "SELECT CAST(event_id AS VARCHAR) AS key, "
        "CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type FROM events"
    ),
    "csv_roundtrip": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "index_query": (
        "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000"
    ),
    "docs_to_cells": cells_sql,
    "cells_to_docs": (
        "SELECT CAST(p_partkey AS VARCHAR) AS row_key, CAST(0 AS INTEGER) AS part, p_brand, p_type, "
        "CAST(5 AS INTEGER) AS n_cells FROM part"
    ),
    "cells_to_columns": (
        "SELECT CAST(p_partkey AS VARCHAR) AS row_key, p_brand, p_type, "
        "CAST(p_size AS VARCHAR) AS p_size FROM part"
    ),
    "cells_two_families": (
        "SELECT CAST(p_partkey AS VARCHAR) AS row_key, p_brand AS f_brand, "
        "CASE WHEN p_size > 25 THEN p_type END AS g_brand FROM part"
    ),
    "scan_cells": f"SELECT * FROM ({cells_sql}) WHERE row_key >= '1' AND row_key < '3'",
    "cell_lines": "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents",
    "cell_documents": (
        "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events "
        "UNION ALL SELECT event_id, user_id FROM events"
    ),
    "upsert_by_id": (
        "WITH u AS (SELECT o_custkey AS id, 'order ' || CAST(o_orderkey AS VARCHAR) AS v, "
        "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) "
        "SELECT id, v FROM u WHERE r = 1 UNION ALL SELECT c_custkey, c_name FROM customer "
        "WHERE c_custkey NOT IN (SELECT id FROM u)"
    ),
    "bulk_load_by_id": (
        "SELECT CAST(page_id AS VARCHAR) AS id, url, CAST(NULL AS VARCHAR) AS body FROM pages "
        "UNION ALL SELECT DISTINCT CAST(conv_id AS VARCHAR), 'old', 'old' FROM conversations "
        "WHERE conv_id NOT IN (SELECT page_id FROM pages)"
    ),
    "load_rejects": (
        "SELECT CASE WHEN event_id % 5 > 1 THEN 'loaded' ELSE 'rejected' END AS state, "
        "CASE WHEN event_id % 5 > 1 THEN CAST(event_id AS VARCHAR) END AS key, "
        "CASE event_id % 5 WHEN 0 THEN '{\"id\": ' || event_id WHEN 1 THEN '{\"n\": ' || event_id || '}' "
        "ELSE '{\"id\": ' || event_id || '}' END AS value FROM events"
    ),
    "alias_view": (
        "SELECT c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment FROM customer "
        "UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier"
    ),
    "drop_field": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, 'o_orderkey,o_custkey,o_orderstatus' AS fields FROM orders"
    ),
    "filter_uris_isin": (
        f"SELECT * FROM ({customer_sql}) WHERE s IN "
        f"('{BASE}customer/1', '{BASE}customer/7', '{BASE}customer/42')"
    ),
    "filter_uris_semi": (
        f"SELECT * FROM ({customer_sql}) WHERE s IN "
        f"(SELECT {OC} FROM orders WHERE o_totalprice > 400000)"
    ),
    "apply_model_statements": customer_sql,
    "apply_model_root": statements("orders", ORDER),
    "apply_model_links": f"SELECT s, p, o FROM ({statements('orders', ORDER)}) WHERE kind = 'iri'",
    "apply_model_docs": joined(customer_sql),
    "documents_json": (
        f"SELECT {S} AS key, '{{\"uri\":\"' || {S} || '\",\"@type\":\"Supplier\",\"balance\":\"' || "
        f"{money('s_acctbal')} || '\",\"name\":\"' || s_name || '\",\"nation\":\"' || {SN} || '\"}}' AS value "
        f"FROM supplier UNION ALL SELECT DISTINCT {SN}, '{{\"uri\":\"' || {SN} || "
        "'\",\"@type\":\"Nation\"}' FROM supplier"
    ),
    "documents_to_statements": (
        "SELECT DISTINCT * FROM ("
        + short(
            " UNION ALL ".join(
                [
                    statements("customer", [r for r in CUSTOMER if r[0] != CN]),
                    statements(f"{customer_nation} JOIN region ON n_regionkey = r_regionkey", NATION + REGION),
                ]
            )
        )
        + ")"
    ),
    "apply_model_ntriples": ntriples(
        statements(
            "documents",
            [
                (iri("doc", "doc_id"), "", "Document", "type"),
                (iri("doc", "doc_id"), "text", "text", "literal"),
                (iri("doc", "doc_id"), "source", "'http://source.example.org/' || url_encode(source)", "iri"),
            ],
        )
    ),
    "csv_ntriples": ntriples(customer_sql),
    "apply_models_multi": (
        statements("orders", ORDER) + " UNION ALL " + statements("orders", PRIORITY)
    ),
    "apply_model_arrays": statements(
        "part",
        [
            (P, "", "Part", "type"),
            (P, "", "Product", "type"),
            (P, "word", "unnest(string_split(p_name, ' '))", "literal"),
            (P, "brand", "'http://brand.example.org/' || url_encode(p_brand)", "iri"),
            (P, "label", "url_encode(p_name) || '/' || url_encode(p_type)", "literal"),
        ],
    ),
    "apply_model_each": statements("part", [(P, "", "Part", "type")])
    + " UNION ALL "
    + statements(
        "(SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part)",
        [
            (P, "word", iri("word", "url_encode(w)"), "iri"),
            (iri("word", "url_encode(w)"), "", "Word", "type"),
            (iri("word", "url_encode(w)"), "text", "w", "literal"),
            (iri("word", "url_encode(w)"), "usedBy", P, "iri"),
        ],
    ),
    "apply_model_json": statements("events", EVENT),
    "apply_model_absolute": statements(
        "pages", [("url", "", "WebPage", "type"), ("url", "id", "CAST(page_id AS VARCHAR)", "literal")]
    ),
    "apply_model_context": short(customer_sql),
    "union_all_statements": customer_sql + " UNION ALL " + statements("supplier", SUPPLIER),
    "distinct_statements": (
        f"SELECT DISTINCT * FROM ({customer_sql} UNION ALL {statements('supplier', SUPPLIER)})"
    ),
    "reduce_by_uri": joined(entity_sql),
    "reduce_single_valued": (
        f"SELECT s AS uri, '{VOCAB}largest' AS p, CAST(max(CAST(o AS DECIMAL(18,2))) AS VARCHAR) AS v "
        f"FROM ({statements('orders', ACTIVITY)}) WHERE p = '{VOCAB}largest' GROUP BY s "
        f"UNION ALL SELECT s, '{VOCAB}first', min(o) FROM ({statements('orders', ACTIVITY)}) "
        f"WHERE p = '{VOCAB}first' GROUP BY s "
        f"UNION ALL SELECT DISTINCT s, p, o FROM ({statements('orders', ACTIVITY)}) WHERE p = '{VOCAB}status' "
        f"UNION ALL SELECT DISTINCT {OC}, '{RDF_TYPE}', '{VOCAB}Customer' FROM orders"
    ),
    "reduce_large_entity": (
        f"SELECT {ST} AS uri, CAST(CASE WHEN n > 100 THEN ceil(n / 100.0) ELSE 1 END AS INTEGER) AS parts, "
        f"'orders' AS p, {O} AS v FROM orders JOIN "
        "(SELECT o_orderstatus, count(*) + 1 AS n FROM orders GROUP BY o_orderstatus) USING (o_orderstatus)"
    ),
    "apply_context": f"SELECT s, p AS term, o, kind FROM ({short(customer_sql)})",
    "context_documents": (
        f"SELECT CAST(event_id AS VARCHAR) AS key, '{{\"@id\": \"{BASE}event/' || event_id || "
        f"'\", \"@context\": {{\"k\": {{\"@id\": \"{VOCAB}k\"}}}}, \"@type\": [\"Event\", \"Other\"], \"k\": ' || props || "
        f"', \"price\": 1.50, \"tags\": [\"b\", \"a\", \"a\", \"{VOCAB}k\"], \"in\": {{\"kind\": \"' || event_type || "
        "'\", \"@type\": \"Event\"}}' AS value FROM events"
    ),
    "load_context": (
        "SELECT 'term' || CAST(p_partkey AS VARCHAR) AS term, "
        "'http://part.example.org/' || CAST(p_partkey AS VARCHAR) AS iri FROM part"
    ),
    "partition_on_types": (
        f"SELECT 'Customer' AS type, {C} AS uri FROM customer UNION ALL SELECT 'Supplier', {S} FROM supplier "
        f"UNION ALL SELECT 'Nation', {N} FROM nation"
    ),
    "type_members": (
        f"SELECT 'Customer' AS type, {C} AS uri FROM customer UNION ALL SELECT 'Supplier', {S} FROM supplier "
        f"UNION ALL SELECT 'Nation', {N} FROM nation"
    ),
    "frame_one_level": (
        f"SELECT {C} AS uri, c_name AS name, {N} AS nation_uri, n_name AS nation_name FROM {customer_nation}"
    ),
    "frame_two_level": (
        f"SELECT {C} AS uri, c_name AS name, {N} AS nation_uri, r_name AS region_name "
        f"FROM {customer_nation} JOIN region ON n_regionkey = r_regionkey"
    ),
    "frame_multi_root": (
        f"SELECT 'customer' AS root, {C} AS uri, {CN} AS nation_uri FROM customer "
        f"UNION ALL SELECT 'supplier', {S}, {SN} FROM supplier"
    ),
    "frame_capped": (
        f"SELECT {OC} AS uri, {O} AS order_uri, "
        f"row_number() OVER (PARTITION BY o_custkey ORDER BY {O}) <= 3 AS embedded FROM orders"
    ),
    "frame_capped_large": (
        f"SELECT {ST} AS uri, {O} AS order_uri, "
        f"row_number() OVER (PARTITION BY o_orderstatus ORDER BY {O}) <= 1200 AS embedded FROM orders"
    ),
    "frame_back_links": (
        f"SELECT {O} AS uri, {OC} AS customer_uri, c_name AS name, CAST(1 AS INTEGER) AS n_props "
        "FROM orders JOIN customer ON o_custkey = c_custkey"
    ),
    "frame_json": (
        f"SELECT {C} AS key, '{{\"uri\":\"' || {C} || '\",\"@type\":\"Customer\",\"balance\":\"' || "
        f"{money('c_acctbal')} || '\",\"name\":\"' || c_name || '\",\"segment\":\"' || c_mktsegment || "
        f"'\",\"nation\":{{\"@type\":\"Nation\",\"name\":\"' || n_name || "
        f"'\",\"region\":{{\"@type\":\"Region\",\"name\":\"' || r_name || '\",\"uri\":\"' || {NR} || "
        f"'\"}},\"uri\":\"' || {N} || '\"}}}}' AS value "
        f"FROM {customer_nation} JOIN region ON n_regionkey = r_regionkey"
    ),
    "write_frames": (
        f"SELECT 'customer' AS frame, {C} AS key, {CN} AS nation_uri FROM customer "
        f"UNION ALL SELECT 'supplier', {S}, {SN} FROM supplier"
    ),
    "scan_frames": (
        "SELECT c_name AS name, 'file:/frames/' || c_mktsegment || '/' || c_name || '.json' AS path FROM customer"
    ),
    "pair_models_roots": (
        "SELECT CAST(c_nationkey AS VARCHAR) AS name, 'file:/models/' || CAST(c_nationkey AS VARCHAR) || '/' || "
        f"c_name || '-model.ttl' AS url, '{VOCAB}' || c_mktsegment || '1' AS root FROM customer "
        "WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')"
    ),
    "frame_types": frame_type_sql,
    "types_with_uris": (
        f"SELECT DISTINCT type AS name, '{VOCAB}' || type AS uri FROM ({frame_type_sql})"
    ),
    "stream_apply_model": statements("events", EVENT),
    "stream_upsert": (
        "SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER "
        "(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1"
    ),
    "stream_upsert_documents": (
        f"SELECT {E_} AS key, '{{\"uri\":\"' || {E_} || '\",\"@type\":\"{VOCAB}Event\",\"{VOCAB}at\":\"' || "
        f"{stamp('ts')} || '\",\"{VOCAB}k\":\"' || json_extract_string(props, '$.k') || '\",\"{VOCAB}kind\":\"' || "
        f"event_type || '\",\"{VOCAB}user\":\"' || {EU} || '\"}}' AS value FROM events "
        f"UNION ALL SELECT DISTINCT {EU}, '{{\"uri\":\"' || {EU} || '\",\"@type\":\"{VOCAB}User\"}}' FROM events"
    ),
    "stream_files_as_messages": "SELECT c_custkey, c_name FROM customer",
}
ORACLE["stream_compact"] = ORACLE["stream_upsert_documents"]
ORACLE["stream_upsert_shrink"] = (
    f"SELECT {EU} AS entity, CAST(1 AS INTEGER) AS parts, '{{\"uri\":\"' || {EU} || "
    f"'\",\"@type\":\"User\",\"event\":\"{BASE}event/' || min(event_id) || '\"}}' AS value FROM events GROUP BY user_id"
)

customer_names = "SELECT c_custkey AS id, c_name AS v FROM customer"
ORACLE["store_upsert"] = (
    "WITH u AS (SELECT o_custkey AS id, 'order ' || CAST(o_orderkey AS VARCHAR) AS v, o_orderdate AS at, o_orderkey AS n, "
    "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) "
    "SELECT id, v FROM u WHERE r = 1 UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT id FROM u)"
)
ORACLE["store_delete"] = (
    f"SELECT 'left' AS state, * FROM ({customer_names}) WHERE id NOT IN (SELECT o_custkey FROM orders) "
    f"UNION ALL SELECT 'found', * FROM ({customer_names}) WHERE id IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)"
)
customer_party = "SELECT c_name AS name, c_nationkey AS nationkey FROM customer"
ORACLE["alias_versions"] = (
    f"SELECT 'before' AS reader, * FROM ({customer_party}) UNION ALL SELECT 'back', * FROM ({customer_party}) "
    f"UNION ALL SELECT 'after', * FROM ({customer_party}) UNION ALL SELECT 'after', s_name, s_nationkey FROM supplier"
)
renamed = "(SELECT n_nationkey, n_regionkey, CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END AS n_name FROM nation)"
loads_left = [customer_sql, statements(renamed, NATION), statements("region", REGION)]
ORACLE["incremental_reduce"] = joined(short(" UNION ALL ".join(loads_left)))
every_load = [customer_sql, statements("supplier", SUPPLIER), statements("nation", NATION), statements("region", REGION)]
ORACLE["incremental_counts"] = "SELECT s, p, o, kind, count(*) AS n FROM (" + " UNION ALL ".join(
    f"SELECT DISTINCT * FROM ({short(sql)})" for sql in every_load
) + ") GROUP BY ALL"
ORACLE["incremental_frames"] = (
    f"SELECT {C} AS uri, c_name AS name, n_name AS nation_name, r_name AS region_name "
    f"FROM customer JOIN {renamed} ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)
part_ways = (
    "WITH RECURSIVE e AS (SELECT p_partkey AS k, p_name, CASE WHEN p_partkey < 3 THEN p_partkey + 1 WHEN p_partkey = 3 THEN 1 "
    "ELSE p_partkey // 4 END AS above FROM part), "
    "w AS (SELECT k AS root, k, 0::BIGINT AS depth, [k] AS seen FROM e UNION ALL "
    "SELECT w.root, e.above, w.depth + 1, list_append(seen, e.above) FROM w JOIN e ON w.k = e.k WHERE NOT list_contains(seen, e.above)) "
)
ORACLE["frame_recursive"] = part_ways + f"SELECT {iri('part', 'root')} AS root, depth, {iri('part', 'k')} AS uri FROM w"
# the root's fields in the order they are built, those of embedded documents by name
ORACLE["frame_recursive_json"] = part_ways + (
    ", j AS (SELECT root, depth, above, CASE WHEN depth = 0 THEN '{\"uri\":\"' || " + iri("part", "k") + " || '\",\"@type\":\"Part\",\"name\":\"' || p_name || "
    "'\",\"above\":' ELSE '{\"@type\":\"Part\",\"above\":' END AS head, CASE WHEN depth = 0 THEN '}' ELSE ',\"name\":\"' || p_name || '\",\"uri\":\"' || "
    + iri("part", "k") + " || '\"}' END AS tail FROM w JOIN e USING (k)) "
    f"SELECT {iri('part', 'root')} AS key, string_agg(head, '' ORDER BY depth) || '\"' || max_by({iri('part', 'above')}, depth) || '\"' || "
    "string_agg(tail, '' ORDER BY depth DESC) AS value FROM j GROUP BY root"
)
ORACLE["stream_merge_documents"] = (
    f"SELECT {EU} AS uri, CAST(0 AS INTEGER) AS part, 'event' AS p, string_agg({E_}, '|' ORDER BY {E_}) AS vals "
    "FROM events GROUP BY user_id"
)
ORACLE["frame_colocated"] = ORACLE["frame_two_level"]
LI = f"('{BASE}order/' || CAST(l_orderkey AS VARCHAR) || '/line/' || CAST(l_linenumber AS VARCHAR))"
short_order = [(O, "", "Order", "type"), (O, "status", "o_orderstatus", "literal"), (O, "customer", OC, "iri"), (OC, "", "Customer", "type"), (OC, "orders", O, "iri")]
order_lines = "orders JOIN lineitem ON o_orderkey = l_orderkey"
ORACLE["apply_joined_models"] = " UNION ALL ".join(
    [
        statements("orders", short_order, vocab="").replace(f"'{VOCAB}", "'"),
        statements("lineitem", [(LI, "", "Line", "type"), (LI, "quantity", money("l_quantity"), "literal")]),
        customer_sql,
        f"SELECT DISTINCT * FROM ({statements(order_lines, [(O, 'line', LI, 'iri'), (LI, 'boughtBy', OC, 'iri')])})",
        f"SELECT DISTINCT * FROM ({statements('orders JOIN customer ON o_custkey = c_custkey', [(O, 'buyerNation', CN, 'iri')])})",
    ]
)
ORACLE["cells_clustered"] = ORACLE["scan_cells"]
ORACLE["cells_versions"] = (
    "WITH p AS (SELECT CAST(user_id AS VARCHAR) AS row_key, 'e' AS family, event_type AS qualifier, event_id AS version, "
    "json_extract_string(props, '$.k') AS value, event_id % 40 AS mark FROM events), "
    "d AS (SELECT *, max(CASE WHEN mark = 0 THEN version END) OVER (PARTITION BY row_key) AS row_upto, "
    "max(CASE WHEN mark = 1 THEN version END) OVER (PARTITION BY row_key, qualifier) AS column_upto FROM p), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY row_key, qualifier ORDER BY version DESC) AS r FROM d "
    "WHERE mark <> 2 AND version > coalesce(row_upto, -1) AND version > coalesce(column_upto, -1) AND version >= 100) "
    "SELECT row_key, family, qualifier, version, value FROM k WHERE r <= 2"
)


def facts(table: str, rules: list[tuple[str, str, str, str, str | None, int | None]]) -> str:
    """A UNION ALL of one SELECT per statement with its language and its place in a list."""
    return " UNION ALL ".join(
        f"SELECT {s} AS s, '{RDF_TYPE if kind == 'type' else VOCAB + p}' AS p, {o} AS o, '{kind}' AS kind, "
        f"{'CAST(NULL AS VARCHAR)' if lang is None else repr(lang)} AS lang, CAST({'NULL' if place is None else place} AS INTEGER) AS place FROM {table}"
        for s, p, o, kind, lang, place in rules
    )


ORACLE["context_expand"] = " UNION ALL ".join(
    [
        facts(
            "events",
            [
                (E_, "", f"'{VOCAB}Event'", "type", None, None), (E_, "user", EU, "iri", None, None),
                (E_, "eventKind", "event_type", "literal", None, None),
                *[(E_, "tags", f"'{tag}'", "literal", None, i) for i, tag in enumerate("bab")],
                (E_, "label", "event_type", "literal", "en", None), (E_, "label", "'k' || event_id", "literal", "de", None),
                (E_, "k", "json_extract_string(props, '$.k')", "literal", None, None),
                (E_, "mine", f"'{VOCAB}x' || event_id", "iri", None, None),
            ],
        ),
        facts(
            "customer",
            [
                (C, "", f"'{VOCAB}Customer'", "type", None, None), (C, "name", "c_name", "literal", None, None),
                (C, "kind", "'plain'", "literal", None, None), (C, "nation", CN, "iri", None, None),
                (C, "segment", f"'{VOCAB}' || c_mktsegment", "iri", None, None),
            ],
        ),
    ]
)
ORACLE["context_compact"] = (
    f"SELECT {E_} AS key, '{{\"@id\":\"event/' || event_id || '\",\"@type\":\"Event\",\"k\":\"' || json_extract_string(props, '$.k') || "
    "'\",\"kind\":\"' || event_type || '\",\"label\":{\"de\":\"k' || event_id || '\",\"en\":\"' || event_type || "
    "'\"},\"mine\":{\"@id\":\"v:x' || event_id || '\"},\"tags\":[\"b\",\"a\",\"b\"],\"user\":\"user/' || user_id || '\"}' AS value FROM events "
    f"UNION ALL SELECT {C}, '{{\"@id\":\"customer/' || c_custkey || '\",\"@type\":\"Customer\",\"kind\":\"plain\",\"name\":\"' || c_name || "
    "'\",\"nation\":\"nation/' || c_nationkey || '\",\"segment\":\"' || c_mktsegment || '\"}' FROM customer"
)
ORACLE["frame_matching"] = (
    f"SELECT {C} AS uri, c_mktsegment AS segment, 'none' AS rating, CASE WHEN n_nationkey IN (1, 2, 3) THEN n_name END AS nation_name, "
    f"CASE WHEN n_nationkey NOT IN (1, 2, 3) THEN {CN} END AS nation_uri FROM {customer_nation} WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')"
)

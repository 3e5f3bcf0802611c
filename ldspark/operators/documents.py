"""Documents back to statements, so stored documents can be reduced or framed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ldspark.functions.documents import JSON_MAP, PART_OF, is_object, json_elements, json_value, walk
from ldspark.plans.model import RDF_TYPE

MAX_DEPTH = 64


def node_statements(nodes: DataFrame) -> DataFrame:
    """The statements a document view was built from."""
    types = nodes.select(
        F.col("uri").alias("s"),
        F.lit(RDF_TYPE).alias("p"),
        F.explode("types").alias("o"),
        F.lit("type").alias("kind"),
    )
    values = (
        nodes.select("uri", F.explode("props").alias("p", "vals"))
        .select("uri", "p", F.inline("vals"))
        .select(F.col("uri").alias("s"), "p", F.col("v").alias("o"), "kind")
    )
    # types are repeated on every part of a split document
    return types.distinct().unionByName(values)


def _inner_nodes(nodes: Column) -> Column:
    """The node objects one level below some node objects."""

    def below(node: Column) -> Column:
        values = F.flatten(
            F.transform(F.map_values(F.try_variant_get(node, "$", JSON_MAP)), json_elements)
        )
        return F.filter(
            values, lambda x: is_object(x) & json_value(x, "$['@value']").isNull()
        )

    return F.flatten(F.transform(nodes, below))


def document_statements(
    records: DataFrame, id_field: str = "@id", links: Sequence[str] = (), max_depth: int = MAX_DEPTH
) -> DataFrame:
    """Statements of JSON documents in ``key, value`` records.

    A document without its identifier is named by the record's key; the parts of
    a large one join their entity again. Objects with
    an identifier are links to it and documents of their own, at any depth;
    ``{"@value": ...}`` is text. Plain text is text, unless its property is one
    of ``links``. Text that does not parse gives nothing; a nested object without
    identifier, or nesting below ``max_depth``, is an error.
    """
    too_deep = F.concat(F.lit(f"nested below {max_depth} levels: "), F.col("key"))
    every = walk(F.array(F.try_parse_json("value")), _inner_nodes, max_depth, too_deep)

    path = f"$['{id_field}']"
    nodes = records.select("key", F.posexplode(every).alias("n", "node"))
    unnamed = F.raise_error(F.concat(F.lit("nested object without identifier in "), F.col("key")))
    named = F.coalesce(
        json_value(F.col("node"), f"$['{PART_OF}']"),
        json_value(F.col("node"), path),
        F.when(F.col("n") == 0, F.col("key")).otherwise(unnamed),
    )
    fields = (
        nodes.select(
            named.alias("s"),
            F.explode(F.try_variant_get(F.col("node"), "$", JSON_MAP)).alias("p", "raw"),
        )
        .filter(~F.col("p").isin(id_field, PART_OF))
        .select("s", "p", F.explode(json_elements(F.col("raw"))).alias("x"))
    )
    x = F.col("x")
    is_type = F.col("p") == "@type"
    entity = F.coalesce(json_value(x, f"$['{PART_OF}']"), json_value(x, path))
    target = F.when(is_object(x), entity)
    text = F.when(is_object(x), json_value(x, "$['@value']")).otherwise(json_value(x, "$"))
    kind = (
        F.when(is_type, "type")
        .when(target.isNotNull() | F.col("p").isin(list(links)), "iri")
        .otherwise("literal")
    )
    return fields.select(
        "s",
        F.when(is_type, RDF_TYPE).otherwise(F.col("p")).alias("p"),
        F.coalesce(target, text).alias("o"),
        kind.alias("kind"),
    ).filter(F.col("o").isNotNull())

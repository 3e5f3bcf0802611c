"""Contexts: short names for property and class identifiers."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Union

from pyspark.sql import DataFrame, functions as F

from ldspark.functions.documents import JSON_MAP, is_object, json_value, rename_json

Context = Union[DataFrame, Mapping[str, str]]


def parse_contexts(files: DataFrame) -> DataFrame:
    """``term, iri`` from documents in a ``text`` column.

    Takes the object-valued terms that carry ``@id``; text-valued terms and
    documents without ``@context`` give nothing.
    """
    holder = F.from_json("text", f"`@context` {JSON_MAP}")
    return (
        files.select(F.explode(holder["@context"]).alias("term", "definition"))
        .select("term", json_value(F.col("definition"), "$['@id']").alias("iri"))
        .filter(F.col("iri").isNotNull())
    )


def terms_by_iri(context: Mapping[str, str]) -> dict[str, str]:
    """One term per identifier, the first by name."""
    first: dict[str, str] = {}
    for term, iri in sorted(context.items()):
        first.setdefault(iri, term)
    return first


def _apply_literal(statements: DataFrame, context: Mapping[str, str]) -> DataFrame:
    terms = terms_by_iri(context)
    if not terms:
        return statements.select("s", "p", "o", "kind")
    table = F.create_map(*[F.lit(x) for pair in terms.items() for x in pair])

    def short(column: str):
        return F.coalesce(F.try_element_at(table, F.col(column)), F.col(column))

    o = F.when(F.col("kind") == "type", short("o")).otherwise(F.col("o"))
    return statements.select("s", short("p").alias("p"), o.alias("o"), "kind")


def apply_context(statements: DataFrame, context: Context) -> DataFrame:
    """Replace property and class identifiers by their terms, keep the unknown ones.

    A mapping is a setting: its terms are literals of the plan and rows are looked
    up where they are, without a join. A table is joined; Spark broadcasts it when
    its measured size allows it, and otherwise splits the skewed property keys at
    run time.
    """
    if isinstance(context, Mapping):
        return _apply_literal(statements, context)
    table = context.groupBy("iri").agg(F.min("term").alias("term"))
    names = table.select(F.col("iri").alias("p"), F.col("term").alias("p_term"))
    classes = table.select(
        F.col("iri").alias("class_iri"), F.col("term").alias("class_term")
    )
    class_iri = F.when(F.col("kind") == "type", F.col("o"))
    return (
        statements.join(names, "p", "left")
        .join(classes, class_iri == F.col("class_iri"), "left")
        .select(
            "s",
            F.coalesce("p_term", "p").alias("p"),
            F.coalesce("class_term", "o").alias("o"),
            "kind",
        )
    )


def context_documents(
    records: DataFrame, context: Mapping[str, str], id_field: str = "@id", output_id_field: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """JSON documents in ``key, value`` records under the short names of a context.

    Returns ``(documents, rejects)``; text that is no JSON object is a reject and
    untouched. Names and types are replaced at any depth and nothing else changes.
    With ``output_id_field`` the identifiers' field is renamed as well. There is
    no shuffle.
    """
    terms = terms_by_iri(context)
    names = terms if output_id_field is None else {**terms, id_field: output_id_field}
    marked = records.withColumn("_good", is_object(F.try_parse_json("value")))
    good = F.coalesce(F.col("_good"), F.lit(False))
    documents = marked.filter(good).withColumn("value", rename_json(F.col("value"), names, terms))
    return documents.drop("_good"), marked.filter(~good).drop("_good")

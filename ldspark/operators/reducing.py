"""Union and reduce: one set of statements, one document per identifier."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ldspark.operators.skew import sized_groups
from ldspark.plans.model import RDF_TYPE

COLUMNS = ("s", "p", "o", "kind")
VALUES_PER_ROW = 10_000


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name of one or more collections."""
    if not frames:
        raise ValueError("nothing to union")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def distinct_statements(statements: DataFrame) -> DataFrame:
    """The set of statements.

    The aggregate combines map-side, so a shared entity that thousands of rows
    mint leaves each task once, and the shuffle is by the whole statement.
    """
    return statements.select(*COLUMNS).distinct()


def _best(p: str, how: str, as_type: str | None) -> Column:
    """The greatest or least value of a property; values that do not cast come last."""
    fields = [F.col("o"), F.col("kind")]
    if as_type:
        number = F.col("o").try_cast(as_type)
        last = number.isNotNull() if how == "max" else number.isNull()
        fields = [last.alias("last"), number.alias("number"), *fields]
    ranked = F.when(F.col("p") == p, F.struct(*fields))
    return F.max(ranked) if how == "max" else F.min(ranked)


def reduce_statements(
    *frames: DataFrame, single_valued: Mapping[str, str | tuple[str, str]] | None = None
) -> DataFrame:
    """Union, then remove duplicates.

    ``single_valued`` maps a property to ``'min'`` or ``'max'``, or to such a
    word with the SQL type values are compared as, for example
    ``('max', 'decimal(18,2)')``; only that one value per subject is kept. Both
    steps are one aggregate over one scan: the value is a grouping key for
    ordinary properties and an aggregated column for single-valued ones.
    """
    statements = union_all(*frames).select(*COLUMNS)
    if not single_valued:
        return statements.distinct()

    rules = {p: (how, None) if isinstance(how, str) else how for p, how in single_valued.items()}
    wrong = sorted({how for how, _ in rules.values()} - {"min", "max"})
    if wrong:
        raise ValueError(f"single-valued properties take 'min' or 'max', not {wrong}")

    names = [f"_pick{n}" for n in range(len(rules))]
    picks = [_best(p, *rule).alias(name) for name, (p, rule) in zip(names, rules.items())]
    other = F.when(~F.col("p").isin(*rules), F.struct("o", "kind"))
    return (
        statements.groupBy("s", "p", other.alias("_other"))
        .agg(*picks)
        .select(
            "s",
            "p",
            *[
                F.coalesce(*[F.col(f"{c}.{field}") for c in ("_other", *names)]).alias(field)
                for field in ("o", "kind")
            ],
        )
    )


def to_nodes(statements: DataFrame, values_per_row: int = VALUES_PER_ROW) -> DataFrame:
    """Document view of a *set* of statements.

    ``uri, part, parts, types ARRAY<STRING>, props MAP<STRING, ARRAY<STRUCT<kind, v>>>``
    with every array sorted. A subject with up to ``values_per_row`` values is one
    row with part 0 of 1. A larger one has as many parts as its own number of
    values asks for, each with its types and some of its values; together the
    parts hold every value. That is how no task ever gathers an unbounded group.
    Node objects that share an identifier describe one node in JSON-LD, so part
    documents stay valid. The statements are written to the scratch folder once.
    """
    marked, tasks = sized_groups(statements, ["s"], ["p", "kind", "o"], values_per_row)
    is_type = F.col("kind") == "type"
    placed = marked.withColumn(
        "part",
        F.explode(
            F.when(is_type, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
        ),
    )
    # both aggregates below run on this one shuffle; with a number as the first key
    # they sort without comparing identifiers that share long prefixes
    by_property = (
        placed.repartition(tasks, "s", "part")
        .groupBy(F.xxhash64("s").alias("_hash"), "s", "part", "parts", "p")
        .agg(F.sort_array(F.collect_list(F.struct("kind", F.col("o").alias("v")))).alias("vals"))
    )
    entries = F.sort_array(F.collect_list(F.struct("p", "vals")))
    props = F.map_from_entries(entries)
    return (
        by_property.groupBy("_hash", "s", "part", "parts")
        .agg(props.alias("all"))
        .select(
            F.col("s").alias("uri"),
            "part",
            "parts",
            F.coalesce(
                F.transform(F.col("all")[RDF_TYPE], lambda x: x["v"]),
                F.array().cast("array<string>"),
            ).alias("types"),
            F.map_filter("all", lambda k, _: k != RDF_TYPE).alias("props"),
        )
    )


def reduce_documents(
    *frames: DataFrame,
    single_valued: Mapping[str, str | tuple[str, str]] | None = None,
    values_per_row: int = VALUES_PER_ROW,
) -> DataFrame:
    """Merge the statements of every identifier into its document."""
    return to_nodes(reduce_statements(*frames, single_valued=single_valued), values_per_row)


def node_values(nodes: DataFrame) -> DataFrame:
    """Flat view of documents: ``uri, part, p, kind, v``."""
    return nodes.select("uri", "part", F.explode("props").alias("p", "vals")).select(
        "uri", "part", "p", F.inline("vals")
    )

"""Models over several inputs: links between nodes that rows of two inputs make."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ldspark.functions.terms import lexical
from ldspark.operators.mapping import _Inputs, _statement, apply_model
from ldspark.operators.reducing import union_all
from ldspark.operators.skew import ROWS_PER_TASK, salted_join
from ldspark.plans.model import JoinedModel, JoinLink

Side = tuple[str, tuple[str, ...]]  # an input and its columns to join on


def join_graph(links: Sequence[JoinLink]) -> dict[tuple[Side, Side], list[tuple[JoinLink, bool]]]:
    """The joins that a model's links need, each with its links and whether they run from its left to its right.

    Links over the same two inputs and the same columns are one join, whichever way they point and in whatever order
    they name the columns.
    """
    joins: dict[tuple[Side, Side], list[tuple[JoinLink, bool]]] = {}
    for link in links:
        forward = (link.source[0], link.target[0]) <= (link.target[0], link.source[0])
        pairs = sorted({(a, b) if forward else (b, a) for a, b in link.on})
        left, right = (link.source[0], link.target[0]) if forward else (link.target[0], link.source[0])
        sides = ((left, tuple(a for a, _ in pairs)), (right, tuple(b for _, b in pairs)))
        joins.setdefault(sides, []).append((link, forward))
    return joins


def _key(df: DataFrame, columns: Sequence[str], as_text: bool) -> Column:
    """One column to join on; null where any part is."""
    kinds = [df.select(c).schema[0].dataType for c in columns]
    if not as_text:
        return F.col(columns[0])
    texts = [lexical(kind)(F.col(c)) for c, kind in zip(columns, kinds)]
    # lengths keep the parts apart whatever they hold
    return F.concat(*[part for t in texts for part in (F.length(t).cast("string"), F.lit(":"), t)])


def _same_type(frames: Mapping[str, DataFrame], left: Side, right: Side) -> bool:
    kinds: list[list[T.DataType]] = [[frames[name].select(c).schema[0].dataType for c in columns] for name, columns in (left, right)]
    return len(kinds[0]) == 1 and kinds[0] == kinds[1]


def apply_joined_model(
    frames: Mapping[str, DataFrame], model: JoinedModel, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The statements of every input's own model, and the links between inputs.

    A link is stated once per pair of entities whose rows agree in the columns; rows with a null in one of them agree
    with none, and a null subject has no links. Columns of different types agree where they are written alike. Per
    input and columns there is one narrow table of keys and subjects, each combination once, whatever the number
    of links that use it; it is combined map-side and joined once per partner, hot keys in several tasks. Inputs that
    are not in ``frames`` are an error.
    """
    missing = sorted(set(model.inputs) - set(frames))
    if missing:
        raise ValueError(f"no rows for the inputs {missing}")
    own = [apply_model(frames[name], one) for name, one in model.inputs.items()]

    joins = join_graph(model.links)
    wanted: dict[Side, set[str]] = {}
    for sides, links in joins.items():
        for link, forward in links:
            ends = (link.source[1], link.target[1]) if forward else (link.target[1], link.source[1])
            for side, node in zip(sides, ends):
                wanted.setdefault(side, set()).add(node)

    def table(side: Side, as_text: bool, prefix: str) -> DataFrame:
        name, columns = side
        inputs, one = _Inputs(frames[name]), model.inputs[name]
        nodes = {n.id: n for n in one.nodes}
        subjects = {node: inputs.subject(nodes[node], one.base) for node in sorted(wanted[side])}
        df = frames[name]
        if inputs.parsed:
            df = df.select("*", *[c.alias(n) for n, c in inputs.parsed.items()])
        key = _key(frames[name], columns, as_text).alias("_key")
        # the subject columns are expressions of the input, named while they are made
        made = df.select(key, *[c.alias(n) for n, c in inputs.columns.items()])
        rows = made.select("_key", *[c.alias(f"{prefix}{node}") for node, c in subjects.items()])
        return rows.filter(F.col("_key").isNotNull()).distinct()

    linked = []
    for (left, right), links in joins.items():
        as_text = not _same_type(frames, left, right)
        many, one = table(left, as_text, "l:"), table(right, as_text, "r:")
        spread = [c for c in many.columns if c != "_key"]
        pairs = salted_join(many, one, "_key", [f"`{c}`" for c in spread], rows_per_task=rows_per_task)
        stated = []
        for link, forward in links:
            ends = ("l:", "r:") if forward else ("r:", "l:")
            s, o = (F.col(f"`{end}{node}`") for end, (_, node) in zip(ends, (link.source, link.target)))
            stated.append(_statement(s, link.predicate, o, "iri"))
        statements = pairs.select(F.inline(F.array(*stated))).filter(F.col("s").isNotNull() & F.col("o").isNotNull())
        linked.append(statements.distinct())
    return union_all(*own, *linked)

"""Nested documents of frames that contain themselves: as deep as the data goes.

The links that can embed a document are joined with their targets once. From the roots on, each round joins only the
places the last round found with these links; a place carries the identifiers on the way to it, and a link back to one
of them is not followed, so it stays a reference. When a round finds nothing the places are put together from the
deepest to the roots. Every round is written, so a plan never grows with the depth of the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ldspark.functions.documents import document_fields, document_id
from ldspark.operators.framing import RESERVED, Nodes, _links, _without_embedded, of_type
from ldspark.operators.skew import ROWS_PER_TASK, salted_join
from ldspark.plans.frame import FrameRules
from ldspark.session import materialize

PLACE = ("rule", "uri", "part", "prop", "path", "seen")


def _edges(nodes: Nodes, rules: FrameRules, rows_per_task: int) -> DataFrame:
    """``rule, uri, part`` of a document, and ``prop, next_rule, child, child_part`` of one it can embed."""
    links = members = None
    for name, rule in rules.rules.items():
        documents = of_type(nodes, rule.type)
        mine = documents.select(F.lit(name).alias("next_rule"), F.col("uri").alias("child"), F.col("part").alias("child_part"))
        members = mine if members is None else members.unionByName(mine)
        if rule.edges:
            names = F.create_map(*[F.lit(x) for pair in rule.edges.items() for x in pair])
            out = _links(documents, list(rule.edges)).select(
                F.lit(name).alias("rule"),
                F.col("parent").alias("uri"),
                F.col("parent_part").alias("part"),
                "prop",
                F.col("target").alias("child"),
                names[F.col("prop")].alias("next_rule"),
            )
            links = out if links is None else links.unionByName(out)
    if links is None:
        raise ValueError("no frame follows a property")
    key = F.concat_ws("\x1f", "next_rule", "child")
    return salted_join(
        links.withColumn("_key", key),
        members.select(key.alias("_key"), "child_part"),
        "_key",
        ["uri", "part", "prop", "rule"],
        rows_per_task=rows_per_task,
    ).select("rule", "uri", "part", "prop", "next_rule", "child", "child_part")


def _written(places: DataFrame) -> tuple[DataFrame, int]:
    seen = Observation()
    stored = materialize(places.observe(seen, F.count(F.lit(1)).alias("n")), "places")
    return stored, seen.get["n"]


@dataclass(frozen=True)
class Expansion:
    """The places of documents in the trees of all roots, one table per depth."""

    nodes: Nodes
    rules: FrameRules
    levels: list[DataFrame]

    def places(self) -> DataFrame:
        """``root, depth, prop, uri, part, path``: every document in every tree, with the documents' identifiers from
        the root on. The root of a tree has depth 0."""
        out = None
        for depth, level in enumerate(self.levels):
            rows = level.select(F.col("seen")[0].alias("root"), F.lit(depth).alias("depth"), "prop", "uri", "part", "path")
            out = rows if out is None else out.unionByName(rows)
        return out


def expand_frames(nodes: Nodes, rules: FrameRules, rows_per_task: int = ROWS_PER_TASK) -> Expansion:
    """The trees of all documents of the root's type.

    A property is followed to documents of the type its frame asks for; a target that is absent, of another type, or
    on the way from the root already is not. Ways are as many as the data has: a document that several others embed
    is in the tree once for each, as in :func:`frame_documents`. The documents are read several times: pass a
    written table or the result of :func:`store_by_type`.
    """
    root = of_type(nodes, rules.rules[rules.root].type)
    key = document_id(F.col("uri"), F.col("part"))
    first = root.select(
        F.lit(rules.root).alias("rule"),
        "uri",
        "part",
        F.lit(None).cast("string").alias("prop"),
        F.array(key).alias("path"),
        F.array("uri").alias("seen"),
    )
    level, n = _written(first)
    levels = [level]
    edges = materialize(_edges(nodes, rules, rows_per_task), "edges") if n else None
    while n:
        child = document_id(F.col("child"), F.col("child_part"))
        found = (
            level.drop("prop")
            .join(edges, ["rule", "uri", "part"])
            .filter(~F.array_contains("seen", F.col("child")))
            .select(
                F.col("next_rule").alias("rule"),
                F.col("child").alias("uri"),
                F.col("child_part").alias("part"),
                "prop",
                F.array_append("path", child).alias("path"),
                F.array_append("seen", F.col("child")).alias("seen"),
            )
        )
        level, n = _written(found)
        if n:
            levels.append(level)
    return Expansion(nodes, rules, levels)


def _documents(nodes: Nodes, rules: FrameRules) -> DataFrame:
    """``rule, uri, part, types, props`` of all documents some frame asks for, with what it keeps of them."""
    out = None
    for name, rule in rules.rules.items():
        rows = of_type(nodes, rule.type).select(F.lit(name).alias("rule"), *RESERVED)
        if rule.keep is not None:
            own = F.map_filter("props", lambda k, _: k.isin([*rule.keep, *rule.edges]))
            rows = rows.withColumn("props", own)
        out = rows if out is None else out.unionByName(rows)
    return out


def _in_order(a: Column, b: Column) -> Column:
    left, right = (F.struct(x["uri"], x["part"]) for x in (a, b))
    return F.when(left < right, -1).when(left > right, 1).otherwise(0)


def recursive_document_json(expansion: Expansion, id_field: str = "uri") -> DataFrame:
    """``key, value`` with the JSON text of the nested documents, one per document of the root's type.

    Depth by depth from the deepest: what a document embeds is at most its own number of links, gathered by its place.
    """
    documents = _documents(expansion.nodes, expansion.rules)
    props = expansion.rules.props()
    built: DataFrame | None = None
    for depth in range(len(expansion.levels) - 1, -1, -1):
        rows = expansion.levels[depth].join(documents, ["rule", "uri", "part"])
        embedded = {}
        if built is not None:
            above = F.slice("path", 1, depth + 1)
            children = built.select(above.alias("path"), F.struct("prop", "uri", "part", "value").alias("child"))
            gathered = children.groupBy("path").agg(F.collect_list("child").alias("children"))
            rows = rows.join(gathered, "path", "left")
            for prop in props:
                mine = F.filter("children", lambda c: c["prop"] == prop)
                rows = rows.withColumn(f"_{prop}", F.array_sort(F.when(F.size(mine) > 0, mine), _in_order))
                rows = rows.withColumn("props", _without_embedded(prop, F.col(f"`_{prop}`")))
                embedded[prop] = F.transform(F.col(f"`_{prop}`"), lambda c: F.parse_json(c["value"]))
        else:
            embedded = dict.fromkeys(props, F.lit(None).cast("array<variant>"))
        fields = document_fields(*[F.col(c) for c in RESERVED], id_field, embedded)
        out = rows.select("path", "prop", "uri", "part", F.to_json(fields).alias("value"))
        built = materialize(out, "nested") if depth else out
    return built.select(F.col("path")[0].alias("key"), "value")

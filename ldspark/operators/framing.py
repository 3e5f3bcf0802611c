"""Split documents by type and join them into nested documents."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Union

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ldspark.functions.documents import document_fields, document_id
from ldspark.operators.skew import ROWS_PER_TASK, hot_keys, tasks_of, part_of, salted_join, with_parts
from ldspark.plans.frame import Frame
from ldspark.session import materialize, materialize_by, scratch_path

Nodes = Union[DataFrame, Mapping[str, DataFrame]]
LEAST_BUCKETS = 8
BUCKET_ROWS = 100_000


def of_type(nodes: Nodes, cls: str) -> DataFrame:
    """The documents that carry a type, from all documents or from a split by type."""
    if isinstance(nodes, Mapping):
        return nodes[cls]
    return nodes.filter(F.array_contains("types", cls))


def store_by_type(nodes: DataFrame, classes: Iterable[str], label: str = "types") -> dict[str, DataFrame]:
    """Write documents once, one folder per type, and return type to documents.

    Each frame then reads the types it names and nothing else. A document with
    several of the types is in each folder; one with none of them is left out.
    """
    names = sorted(set(classes))
    wanted = F.array(*[F.lit(c) for c in names])
    placed = nodes.withColumn("class", F.explode(F.array_intersect("types", wanted)))
    stored = materialize_by(placed, "class", label)
    return {c: stored.filter(F.col("class") == c).drop("class") for c in names}


@dataclass(frozen=True)
class Colocated(Mapping):
    """Type to documents, in a table bucketed and sorted by document."""

    spark: SparkSession
    table: str
    buckets: int
    classes: tuple[str, ...]

    def __getitem__(self, cls: str) -> DataFrame:
        if cls not in self.classes:
            raise KeyError(cls)
        return self.spark.table(self.table).filter(F.col("class") == cls).drop("class")

    def __iter__(self) -> Iterator[str]:
        return iter(self.classes)

    def __len__(self) -> int:
        return len(self.classes)


def store_colocated(
    nodes: DataFrame, classes: Iterable[str], buckets: int | None = None, label: str = "documents"
) -> Colocated:
    """Like :func:`store_by_type`, in a table bucketed by ``uri, part``; frames over it never shuffle their documents.

    What a frame embeds is dealt to the same buckets, so a document is read, sorted as it lies, and joined where it
    is; every frame and every run over the table saves that shuffle. A document's part is in the key, so a large
    entity is in many buckets. Files are below the scratch folder; the session's catalog knows the table.

    A bucket is one task of every frame over it. Without a number there are as many as the documents ask for, which
    are then read twice and should be a written table.
    """
    spark = nodes.sparkSession
    if buckets is None:
        buckets = max(LEAST_BUCKETS, tasks_of(nodes.count(), BUCKET_ROWS))
    names = tuple(sorted(set(classes)))
    path = scratch_path(spark, label)
    table = path.rpartition("/")[2].replace("-", "_")
    wanted = F.array(*[F.lit(c) for c in names])
    placed = nodes.withColumn("class", F.explode(F.array_intersect("types", wanted)))
    writer = placed.repartition(buckets, "uri", "part").write.partitionBy("class")
    writer.bucketBy(buckets, "uri", "part").sortBy("uri", "part").option("path", path).saveAsTable(table)
    return Colocated(spark, table, buckets, names)


def partition_on_types(nodes: DataFrame, types: Sequence[Mapping[str, str]]) -> dict[str, DataFrame]:
    """Per ``{"name", "uri"}`` entry the documents that carry the type.

    Every collection is a filter over the same documents; a document with two
    listed types is in both.
    """
    return {t["name"]: of_type(nodes, t["uri"]) for t in types}


def type_members(statements: DataFrame, types: DataFrame) -> DataFrame:
    """Long form of the split: ``type, uri`` for a ``name, uri`` table of types."""
    wanted = types.select(F.col("uri").alias("o"), F.col("name").alias("type"))
    return (
        statements.filter(F.col("kind") == "type")
        .join(wanted, "o")
        .select("type", F.col("s").alias("uri"))
    )


def _ranked(links: DataFrame, limit: int, rows_per_task: int) -> DataFrame:
    """The first ``limit`` targets of every parent, by identifier.

    A parent may hold any share of the links. Up to the limit Spark's own setting
    names, Spark ranks per input partition before the shuffle. Above it, the links
    of parents that hold many are first ranked in as many salted groups as their
    measured number asks for.
    """
    setting = links.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    if limit > int(setting):
        hot = hot_keys(links, ["parent"], ["target"], rows_per_task)
        salted = with_parts(links, ["parent"], hot).withColumn("_salt", part_of(["target"]))
        some = Window.partitionBy("parent", "_salt").orderBy("target")
        links = (
            salted.withColumn("_rank", F.row_number().over(some))
            .filter(F.col("_rank") <= limit)
            .drop("_rank", "_salt", "_hash", "parts")
        )
    every = Window.partitionBy("parent").orderBy("target")
    return (
        links.withColumn("_rank", F.row_number().over(every))
        .filter(F.col("_rank") <= limit)
        .drop("_rank")
    )


def _by_uri(a: Column, b: Column) -> Column:
    return (
        F.when(a["uri"] < b["uri"], -1)
        .when(a["uri"] > b["uri"], 1)
        .otherwise((a["part"] - b["part"]).cast("int"))
    )


def _without_embedded(prop: str, children: Column) -> Column:
    """The parent's map without the references that are now documents."""
    embedded = F.transform(children, lambda c: c["uri"])

    def rest(values: Column) -> Column:
        references = F.transform(F.filter(values, lambda x: x["kind"] == "iri"), lambda x: x["v"])
        kept = F.transform(
            F.array_except(references, embedded),
            lambda v: F.struct(F.lit("iri").alias("kind"), v.alias("v")),
        )
        return F.concat(kept, F.filter(values, lambda x: x["kind"] != "iri"))

    changed = F.transform_values(
        "props", lambda k, values: F.when(k == prop, rest(values)).otherwise(values)
    )
    left = F.map_filter(changed, lambda _, values: F.size(values) > 0)
    return F.when(children.isNull(), F.col("props")).otherwise(left)


def _has(prop: str, values: tuple[str, ...] | None = None) -> Column:
    """Whether a document has a property, or one of some values for it."""
    own = F.coalesce(F.try_element_at(F.col("props"), F.lit(prop)), F.array().cast("array<struct<kind: string, v: string>>"))
    return F.size(own) > 0 if values is None else F.exists(own, lambda x: x["v"].isin(list(values)))


def matching(documents: DataFrame, frame: Frame) -> DataFrame:
    """The documents that meet a frame's conditions, with its defaults for properties they lack.

    One predicate over ``props`` where a document is one row. The parts of a large entity count as one: what each
    part has is combined by entity, and only such entities are looked up again.
    """
    if not frame.where and not frame.defaults:
        return documents
    asked = [_has(m.prop, m.values) for m in frame.where] + [_has(p) for p in frame.defaults]
    names = [f"_has{i}" for i in range(len(asked))]
    marked = documents.withColumns(dict(zip(names, asked)))
    if "parts" in documents.columns:
        several = F.col("parts") > 1
        large = marked.filter(several)
        whole = large.groupBy("uri").agg(*[F.max(n).alias(n) for n in names])
        marked = marked.filter(~several).unionByName(large.drop(*names).join(whole, "uri").select(*marked.columns))
    met = [~F.col(n) if m.absent else F.col(n) for n, m in zip(names, frame.where)]
    if met:
        marked = marked.filter(reduce(and_ if frame.require_all else or_, met))
    for name, (prop, value) in zip(names[len(met) :], frame.defaults.items()):
        added = F.create_map(F.lit(prop), F.array(F.struct(F.lit("literal").alias("kind"), F.lit(value).alias("v"))))
        lacks = ~F.col(name) & (F.col("part") == 0)
        marked = marked.withColumn("props", F.when(lacks, F.map_concat("props", added)).otherwise(F.col("props")))
    return marked.drop(*names)


def _links(parents: DataFrame, props: Sequence[str]) -> DataFrame:
    """``prop, parent, parent_part, target`` of all framed properties, from one read of the parents."""
    wanted = F.map_filter("props", lambda k, _: k.isin(list(props)))
    each = parents.select("uri", "part", F.explode(wanted).alias("prop", "values"))
    targets = F.transform(F.filter("values", lambda x: x["kind"] == "iri"), lambda x: x["v"])
    return each.select(
        "prop", F.col("uri").alias("parent"), F.col("part").alias("parent_part"), F.explode(targets).alias("target")
    )


def _embed(
    out: DataFrame,
    links: DataFrame,
    prop: str,
    children: DataFrame,
    members: DataFrame,
    merge_limit: int | None,
    rows_per_task: int,
    buckets: int | None,
) -> DataFrame:
    """Adds the documents ``prop`` leads to by its ``parent, parent_part, target`` links."""
    # one list of hot targets serves both joins: salting more than needed is harmless
    spread = ["parent", "parent_part"]
    hot = hot_keys(links, ["target"], spread, rows_per_task)
    if merge_limit is not None:
        # every document has a part 0, so identifiers are unique without a distinct
        uris = members.filter(F.col("part") == 0).select(F.col("uri").alias("target"))
        known = salted_join(links, uris, "target", spread, "left_semi", hot=hot)
        links = _ranked(known, merge_limit, rows_per_task)
    documents = children.select(
        F.col("uri").alias("target"),
        F.struct(*[F.col(f"`{c}`") for c in children.columns]).alias("child"),
    )
    pairs = salted_join(links, documents, "target", spread, "inner", hot=hot)
    # at most a part's share of links per group, whoever the parent is
    children_of = F.col("_children")
    gathered = F.array_sort(F.collect_list("child"), _by_uri).alias("_children")
    if buckets is None:
        grouped = pairs.groupBy(F.xxhash64("parent").alias("_parent"), "parent", "parent_part").agg(gathered)
    else:
        grouped = pairs.repartition(buckets, "parent", "parent_part").groupBy("parent", "parent_part").agg(gathered)
    same = (out["uri"] == grouped["parent"]) & (out["part"] == grouped["parent_part"])
    if buckets is None:
        same = (out["_hash"] == grouped["_parent"]) & same
    # both sides arrive by these keys, so a second edge does not shuffle parents again
    joined = out.join(grouped, same, "left")
    carried = [F.col(f"`{c}`") for c in out.columns if c != "props"]
    return joined.select(
        *carried, _without_embedded(prop, children_of).alias("props"), children_of.alias(prop)
    )


RESERVED = ("uri", "part", "types", "props")


def frame_documents(
    nodes: Nodes,
    frame: Frame,
    merge_limit: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    built: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Nested documents of one frame, joined bottom-up.

    The result has ``uri, part, types, props`` and one array of child documents
    per framed property, null when nothing was embedded. A reference whose
    target is absent, has another type or falls beyond ``merge_limit`` stays a
    reference in ``props``, as does one that does not meet the conditions of its
    frame. The depth is the frame's, so cycles end. A framed property may not be
    named like a fixed column.

    The documents are read several times: pass the result of
    :func:`store_by_type` or :func:`store_colocated`, or at least a materialized table. A frame's parents
    are read twice, for their links, which are written once, and for themselves;
    nested documents are written once. ``built`` shares them between frames.
    """
    built = {} if built is None else built
    clashing = sorted(set(frame.edges) & set(RESERVED))
    if clashing:
        raise ValueError(f"framed properties cannot be named {clashing}")
    parents = matching(of_type(nodes, frame.type), frame).select(*RESERVED)
    buckets = nodes.buckets if isinstance(nodes, Colocated) else None
    # identifiers share long prefixes; with the hash first the join sorts by a number
    out = parents.withColumn("_hash", F.xxhash64("uri")) if buckets is None else parents
    if frame.edges:
        links = materialize(_links(parents, list(frame.edges)), "links")
    for prop, sub in frame.edges.items():
        name = repr(sub)
        if name not in built:
            children = frame_documents(nodes, sub, merge_limit, rows_per_task, built)
            built[name] = materialize(children, "framed") if sub.edges else children
        mine = links.filter(F.col("prop") == prop).drop("prop")
        members = matching(of_type(nodes, sub.type), sub)
        out = _embed(out, mine, prop, built[name], members, merge_limit, rows_per_task, buckets)
    if frame.keep is not None:
        own = F.map_filter("props", lambda k, _: k.isin([*frame.keep, *frame.edges]))
        out = out.withColumn("props", own)
    return out.drop("_hash")


def apply_frames(
    nodes: Nodes, frames: Mapping[str, Frame], merge_limit: int | None = None
) -> dict[str, DataFrame]:
    """One lazy collection per named frame over the same documents; equal sub-frames are built once."""
    built: dict[str, DataFrame] = {}
    return {name: frame_documents(nodes, f, merge_limit, built=built) for name, f in frames.items()}


def document_rows(nodes: DataFrame, id_field: str = "uri") -> DataFrame:
    """``entity, part, parts, key, value``: JSON text with what a store needs to replace a whole document."""
    fields = document_fields(*[F.col(c) for c in ("uri", "part", "types", "props")], id_field)
    key = document_id(F.col("uri"), F.col("part"))
    return nodes.select(
        F.col("uri").alias("entity"), "part", "parts", key.alias("key"), F.to_json(fields).alias("value")
    )


def flat_document_json(nodes: DataFrame, id_field: str = "uri") -> DataFrame:
    """``key, value`` with the JSON text of flat documents."""
    return document_rows(nodes, id_field).select("key", "value")


def _nested_fields(document: Callable[[str], Column], frame: Frame, id_field: str) -> Column:
    """``map<string, variant>`` of one framed document; ``document`` looks up a field."""

    def below(prop: str, sub: Frame) -> Column:
        return F.transform(
            document(prop),
            lambda c: F.to_variant_object(_nested_fields(lambda name: c[name], sub, id_field)),
        )

    embedded = {prop: below(prop, sub) for prop, sub in frame.edges.items()}
    parts = [document(c) for c in ("uri", "part", "types", "props")]
    return document_fields(*parts, id_field, embedded)


def framed_document_json(framed: DataFrame, frame: Frame, id_field: str = "uri") -> DataFrame:
    """``key, value`` with the JSON text of nested documents."""
    fields = _nested_fields(lambda name: F.col(f"`{name}`"), frame, id_field)
    key = document_id(F.col("uri"), F.col("part"))
    return framed.select(key.alias("key"), F.to_json(fields).alias("value"))

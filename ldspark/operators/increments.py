"""Reduced documents that loads are added to and withdrawn from, and frames that follow them.

A *collection* keeps, per statement, how many loads state it, and beside that the documents. A load that comes or goes
changes the counts of its statements; only subjects that gain or lose a statement get a new document. A *framed
collection* keeps the nested documents of some frames and the links of all documents by target. Its refresh follows a
change up the tree of a frame, from the documents that changed to the roots that show them, and builds only these.

Both are stores of buckets (:mod:`ldspark.operators.store`): what a step does not touch is neither read nor written,
and each step is one commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ldspark.operators.framing import RESERVED, _links, frame_documents, store_by_type
from ldspark.operators.reducing import COLUMNS, VALUES_PER_ROW, reduce_statements, to_nodes, union_all
from ldspark.operators.store import BUCKETS, Buckets, remove_unnamed
from ldspark.operators.versions import commit, forget_versions, read_version
from ldspark.plans.frame import Frame
from ldspark.session import materialize, scratch_scope

def _text_columns(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


_VALUE = T.ArrayType(_text_columns("kind", "v"))
COUNTED = _text_columns(*COLUMNS).add("n", T.LongType())
NODES = (
    _text_columns("uri")
    .add("part", T.IntegerType())
    .add("parts", T.IntegerType())
    .add("types", T.ArrayType(T.StringType()))
    .add("props", T.MapType(T.StringType(), _VALUE))
)
LINKS = _text_columns("target", "prop", "parent").add("types", T.ArrayType(T.StringType()))
SingleValued = Mapping[str, "str | tuple[str, str]"]


@dataclass(frozen=True)
class Collection:
    """One version of a collection, opened for reading."""

    spark: SparkSession
    path: str
    version: int
    statements: Buckets
    documents: Buckets
    loads: Mapping[str, str] = field(default_factory=dict)
    changes: str | None = None
    values_per_row: int = VALUES_PER_ROW
    single_valued: SingleValued = field(default_factory=dict)

    def read_documents(self) -> DataFrame:
        return self.documents.read(self.spark)

    def read_statements(self) -> DataFrame:
        """``s, p, o, kind, n``: every statement with the number of loads that state it."""
        return self.statements.read(self.spark)

    def read_load(self, name: str) -> DataFrame:
        """The statements of one load."""
        if name not in self.loads:
            raise KeyError(f"no load {name!r}")
        return self.spark.read.schema(_text_columns(*COLUMNS)).parquet(f"{self.path}/{self.loads[name]}")

    def _committed(self) -> "Collection":
        content = {
            "statements": self.statements.to_json(),
            "documents": self.documents.to_json(),
            "loads": dict(self.loads),
            "changes": self.changes,
            "values_per_row": self.values_per_row,
            "single_valued": dict(self.single_valued),
        }
        return replace(self, version=commit(self.spark, self.path, self.version, content))


def create_collection(
    spark: SparkSession,
    path: str,
    buckets: int = BUCKETS,
    values_per_row: int = VALUES_PER_ROW,
    single_valued: SingleValued | None = None,
) -> Collection:
    """A collection without loads; there must be none at ``path``. The settings are those of a full reduce."""
    statements = Buckets(f"{path}/statements", "s", buckets, COUNTED)
    documents = Buckets(f"{path}/documents", "uri", buckets, NODES)
    return Collection(
        spark, path, 0, statements, documents, values_per_row=values_per_row, single_valued=single_valued or {}
    )._committed()


def open_collection(spark: SparkSession, path: str, version: int | None = None) -> Collection:
    version, content = read_version(spark, path, version)
    single = {p: rule if isinstance(rule, str) else tuple(rule) for p, rule in content["single_valued"].items()}
    return Collection(
        spark,
        path,
        version,
        Buckets.from_json(f"{path}/statements", content["statements"]),
        Buckets.from_json(f"{path}/documents", content["documents"]),
        content["loads"],
        content["changes"],
        content["values_per_row"],
        single,
    )


def _weighted(statements: DataFrame, weight: int) -> DataFrame:
    return statements.select(*COLUMNS, F.lit(weight).cast("bigint").alias("d"))


def _stored_load(collection: Collection, statements: DataFrame) -> str:
    folder = f"loads/load-{uuid.uuid4().hex}"
    statements.select(*COLUMNS).distinct().write.parquet(f"{collection.path}/{folder}")
    return folder


def _applied(collection: Collection, delta: DataFrame, loads: Mapping[str, str]) -> Collection:
    """The next version, with ``d`` added to the count of each statement of the delta."""
    spark = collection.spark
    with scratch_scope(spark):
        touched = collection.statements.touched(delta)
        stored = collection.statements.read(spark, touched).withColumn("d", F.lit(0).cast("bigint"))
        both = stored.unionByName(delta.withColumn("n", F.lit(0).cast("bigint")))
        summed = both.groupBy(*COLUMNS).agg(F.sum("n").alias("before"), F.sum(F.col("n") + F.col("d")).alias("n"))
        counted = materialize(summed, "counted")
        alive = counted.filter("n > 0")
        statements = collection.statements.replaced(alive.drop("before"), touched)

        changes = f"changes/change-{uuid.uuid4().hex}"
        turned = counted.filter((F.col("before") > 0) != (F.col("n") > 0))
        turned.select(F.col("s").alias("uri")).distinct().write.parquet(f"{collection.path}/{changes}")
        changed = spark.read.schema("uri STRING").parquet(f"{collection.path}/{changes}")
        documents = collection.documents
        rebuilt = documents.touched(changed)
        if rebuilt:
            own = alive.join(changed.withColumnRenamed("uri", "s"), "s", "left_semi")
            nodes = to_nodes(
                reduce_statements(own, single_valued=collection.single_valued or None), collection.values_per_row
            )
            kept = documents.lookup(changed, "left_anti", rebuilt)
            documents = documents.replaced(kept.unionByName(nodes), rebuilt)
    return replace(
        collection, statements=statements, documents=documents, loads=loads, changes=changes
    )._committed()


def add_loads(collection: Collection, loads: Mapping[str, DataFrame]) -> Collection:
    """The next version, with more loads in one step. The statements of a load are a set and are kept, so its name can
    withdraw it.

    A name that is in use is an error; :func:`replace_load` is for new contents.
    """
    used = sorted(set(loads) & set(collection.loads))
    if used:
        raise ValueError(f"loads {used} are there already")
    if not loads:
        return collection
    named = {**collection.loads, **{name: _stored_load(collection, rows) for name, rows in loads.items()}}
    stored = replace(collection, loads=named)
    delta = union_all(*[_weighted(stored.read_load(name), 1) for name in loads])
    return _applied(collection, delta, named)


def add_load(collection: Collection, name: str, statements: DataFrame) -> Collection:
    """The next version, with one more load; see :func:`add_loads`."""
    return add_loads(collection, {name: statements})


def withdraw_load(collection: Collection, name: str) -> Collection:
    """The next version, as if the load had never been added; what other loads state as well stays."""
    delta = _weighted(collection.read_load(name), -1)
    return _applied(collection, delta, {k: v for k, v in collection.loads.items() if k != name})


def replace_load(collection: Collection, name: str, statements: DataFrame) -> Collection:
    """The next version, with other statements under the name of a load; those in both cost nothing further on."""
    loads = {**collection.loads, name: _stored_load(collection, statements)}
    new = _weighted(replace(collection, loads=loads).read_load(name), 1)
    both = new.unionByName(_weighted(collection.read_load(name), -1))
    delta = both.groupBy(*COLUMNS).agg(F.sum("d").alias("d")).filter("d <> 0")
    with scratch_scope(collection.spark):
        return _applied(collection, materialize(delta, "delta"), loads)


def expire_collection(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Forget all but the last ``keep`` versions with their folders; a framed collection cannot follow from before them."""
    kept = forget_versions(spark, path, keep)
    remove_unnamed(spark, f"{path}/statements", [c["statements"] for c in kept])
    remove_unnamed(spark, f"{path}/documents", [c["documents"] for c in kept])


# --- frames that follow a collection ----------------------------------------------


@dataclass(frozen=True)
class FramedCollection:
    """One version of the nested documents of some frames, and of the collection they show."""

    spark: SparkSession
    path: str
    version: int
    base: int
    frames: Mapping[str, Frame]
    roots: Mapping[str, Buckets]
    links: Buckets
    merge_limit: int | None = None

    def read(self, name: str) -> DataFrame:
        """``uri, part, types, props`` and a column per framed property, as :func:`frame_documents` gives them."""
        return self.roots[name].read(self.spark)

    def _committed(self) -> "FramedCollection":
        content: dict[str, Any] = {
            "base": self.base,
            "frames": {name: frame.to_dict() for name, frame in self.frames.items()},
            "roots": {name: buckets.to_json() for name, buckets in self.roots.items()},
            "links": self.links.to_json(),
            "merge_limit": self.merge_limit,
        }
        return replace(self, version=commit(self.spark, self.path, self.version, content))


def _props(frames: Mapping[str, Frame]) -> list[str]:
    """Every property that some frame follows."""
    found: set[str] = set()
    todo = list(frames.values())
    while todo:
        frame = todo.pop()
        found |= set(frame.edges)
        todo += frame.edges.values()
    return sorted(found)


def _link_rows(documents: DataFrame, props: list[str]) -> DataFrame:
    """``target, prop, parent, types``: the references of documents, with the types of the one that refers."""
    wanted = F.map_filter("props", lambda k, _: k.isin(props))
    each = documents.select("uri", "types", F.explode(wanted).alias("prop", "values"))
    references = F.transform(F.filter("values", lambda x: x["kind"] == "iri"), lambda x: x["v"])
    return each.select(F.explode(references).alias("target"), "prop", F.col("uri").alias("parent"), "types")


def create_framed(
    collection: Collection, path: str, frames: Mapping[str, Frame], merge_limit: int | None = None, buckets: int = BUCKETS
) -> FramedCollection:
    """The frames over all documents of a collection, and their links by target; there must be none at ``path``."""
    spark = collection.spark
    documents = collection.read_documents()
    classes = set().union(*[frame.types() for frame in frames.values()])
    with scratch_scope(spark):
        by_type = store_by_type(documents, classes)
        roots = {}
        for name, frame in frames.items():
            framed = frame_documents(by_type, frame, merge_limit)
            schema = T.StructType([T.StructField(f.name, f.dataType) for f in framed.schema])
            roots[name] = Buckets(f"{path}/framed-{name}", "uri", buckets, schema).replaced(framed)
        links = Buckets(f"{path}/links", "target", buckets, LINKS).replaced(_link_rows(documents, _props(frames)))
    return FramedCollection(spark, path, 0, collection.version, frames, roots, links, merge_limit)._committed()


def open_framed(spark: SparkSession, path: str, version: int | None = None) -> FramedCollection:
    version, content = read_version(spark, path, version)
    return FramedCollection(
        spark,
        path,
        version,
        content["base"],
        {name: Frame.from_dict(spec) for name, spec in content["frames"].items()},
        {name: Buckets.from_json(f"{path}/framed-{name}", spec) for name, spec in content["roots"].items()},
        Buckets.from_json(f"{path}/links", content["links"]),
        content["merge_limit"],
    )


def _changed_since(collection: Collection, base: int) -> DataFrame:
    """Identifiers whose documents changed after a version of the collection."""
    spark = collection.spark
    folders = [read_version(spark, collection.path, v)[1]["changes"] for v in range(base + 1, collection.version + 1)]
    paths = [f"{collection.path}/{folder}" for folder in folders if folder]
    if not paths:
        return spark.createDataFrame([], "uri STRING")
    return spark.read.schema("uri STRING").parquet(*paths).distinct()


def _showing(frame: Frame, changed: DataFrame, links: Buckets) -> DataFrame:
    """Identifiers of the frame's type whose nested document shows a changed one: itself, or below by some property.

    ``changed`` has the types a document has or had. Each level looks up the links to what the level below found.
    """
    found = changed.filter(F.array_contains("types", frame.type)).select("uri")
    for prop, sub in frame.edges.items():
        below = _showing(sub, changed, links).withColumnRenamed("uri", "target")
        through = links.lookup(below).filter((F.col("prop") == prop) & F.array_contains("types", frame.type))
        found = found.unionByName(through.select(F.col("parent").alias("uri")))
    return materialize(found.distinct(), "showing")


def _shown(frame: Frame, uris: DataFrame, documents: Buckets) -> list[DataFrame]:
    """The documents a frame needs to be built for some roots, level by level, from their buckets alone."""
    own = documents.lookup(uris).filter(F.array_contains("types", frame.type))
    if not frame.edges:
        return [own]
    own = materialize(own, "shown")
    out = [own]
    for prop, sub in frame.edges.items():
        targets = _links(own, [prop]).select(F.col("target").alias("uri")).distinct()
        out += _shown(sub, materialize(targets, "targets"), documents)
    return out


def refresh_framed(framed: FramedCollection, collection: Collection) -> FramedCollection:
    """The next version, showing a later version of the collection.

    Roots that show no changed document are neither read nor built, and their buckets keep their files unless another
    root in them changed. The collection's versions from the one shown until then on must still be there.
    """
    spark = framed.spark
    if collection.version < framed.base:
        raise ValueError(f"version {framed.base} of the collection is shown already")
    if collection.version == framed.base:
        return framed
    before = open_collection(spark, collection.path, framed.base)
    props = _props(framed.frames)
    with scratch_scope(spark):
        uris = materialize(_changed_since(collection, framed.base), "changed")
        old = materialize(before.documents.lookup(uris).select(*RESERVED), "old")
        new = materialize(collection.documents.lookup(uris).select(*RESERVED), "new")

        gone, come = _link_rows(old, props), _link_rows(new, props)
        touched = framed.links.touched(gone.select("target").union(come.select("target")))
        links = framed.links
        if touched:
            others = links.read(spark, touched).join(uris.withColumnRenamed("uri", "parent"), "parent", "left_anti")
            links = links.replaced(others.unionByName(come), touched)

        changed = materialize(old.select("uri", "types").unionByName(new.select("uri", "types")), "changed-types")
        roots = {}
        for name, frame in framed.frames.items():
            showing = _showing(frame, changed, links)
            rebuilt = framed.roots[name].touched(showing)
            roots[name] = framed.roots[name]
            if not rebuilt:
                continue
            needed, *more = [df.select(*NODES.names) for df in _shown(frame, showing, collection.documents)]
            for df in more:
                needed = needed.unionByName(df)
            by_type = store_by_type(needed.dropDuplicates(["uri", "part"]), frame.types())
            built = frame_documents(by_type, frame, framed.merge_limit).join(showing, "uri", "left_semi")
            kept = framed.roots[name].lookup(showing, "left_anti", rebuilt)
            roots[name] = framed.roots[name].replaced(kept.unionByName(built), rebuilt)
    return replace(framed, base=collection.version, roots=roots, links=links)._committed()

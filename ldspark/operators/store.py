"""Stores keyed by an identifier, in folders by hash, of which a write reads and writes only those it changes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ldspark import files
from ldspark.operators.upsert import latest_by_id
from ldspark.operators.versions import commit, forget_versions, read_version
from ldspark.session import materialize

BUCKETS = 256
BUCKET = "_bucket"


@dataclass(frozen=True)
class Buckets:
    """Rows in folders by the hash of one column: ``folders`` says where each bucket's rows are now.

    A plain value. :meth:`replaced` writes the new rows of some buckets to new folders and gives another value; the
    folders of all other buckets, and those of earlier values, stay as they are. A bucket has as many files as its
    rows ask for, so a key that holds many rows makes a large folder and not a large task. The list of folders, and
    what the driver sees of a write, is as long as the number of buckets.
    """

    path: str
    key: str
    count: int
    schema: T.StructType
    folders: Mapping[int, str] = field(default_factory=dict)

    def of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.count)).cast("int")

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets the keys in the column named as the store's belong to."""
        found = keys.select(self.of(F.col(self.key)).alias(BUCKET)).distinct().collect()
        return sorted(row[BUCKET] for row in found)

    def read(self, spark: SparkSession, only: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets; no other folder is listed."""
        wanted = sorted(self.folders) if only is None else [b for b in only if b in self.folders]
        paths = [f"{self.path}/{self.folders[b]}/{BUCKET}={b}" for b in wanted]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def lookup(self, keys: DataFrame, how: str = "left_semi", only: Sequence[int] | None = None) -> DataFrame:
        """The rows of some keys, from their buckets alone; ``left_anti`` gives the other rows of these buckets."""
        only = self.touched(keys) if only is None else only
        return self.read(keys.sparkSession, only).join(keys.select(self.key).distinct(), self.key, how)

    def replaced(self, rows: DataFrame, touched: Sequence[int] | None = None) -> "Buckets":
        """These rows in place of all rows of the touched buckets, or of the store; they must belong there."""
        spark = rows.sparkSession
        write = f"write-{uuid.uuid4().hex}"
        placed = rows.select(*self.schema.names, self.of(F.col(self.key)).alias(BUCKET))
        placed.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{self.path}/{write}")
        made = [n.partition("=")[2] for n in files.names(spark, f"{self.path}/{write}") if n.startswith(f"{BUCKET}=")]
        gone = set(self.folders if touched is None else touched)
        folders = {b: f for b, f in self.folders.items() if b not in gone} | {int(b): write for b in made}
        return replace(self, folders=folders)

    def to_json(self) -> dict[str, Any]:
        return {
            "key": self.key,
            "count": self.count,
            "schema": json.loads(self.schema.json()),
            "folders": {str(b): f for b, f in sorted(self.folders.items())},
        }

    @classmethod
    def from_json(cls, path: str, spec: Mapping[str, Any]) -> "Buckets":
        folders = {int(b): f for b, f in spec["folders"].items()}
        return cls(path, spec["key"], spec["count"], T.StructType.fromJson(spec["schema"]), folders)


def remove_unnamed(spark: SparkSession, path: str, kept: Sequence[Mapping[str, Any]]) -> list[str]:
    """Remove the folders of writes that none of these contents of :meth:`Buckets.to_json` names."""
    named = {folder for spec in kept for folder in spec["folders"].values()}
    gone = [n for n in files.names(spark, path) if n.startswith("write-") and n not in named]
    for name in gone:
        files.remove(spark, f"{path}/{name}")
    return gone


@dataclass(frozen=True)
class Store:
    """One version of a keyed store, opened for reading; it stays that version whatever is written later."""

    spark: SparkSession
    path: str
    version: int
    buckets: Buckets

    def read(self) -> DataFrame:
        return self.buckets.read(self.spark)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of the identifiers in the column named as the store's key, from their buckets alone."""
        return self.buckets.lookup(keys)

    def _committed(self, buckets: Buckets) -> "Store":
        version = commit(self.spark, self.path, self.version, {"rows": buckets.to_json()})
        return replace(self, version=version, buckets=buckets)


def create_store(
    rows: DataFrame, path: str, id_col: str, order_by: Sequence[str] = (), buckets: int = BUCKETS
) -> Store:
    """A new store of the latest row per identifier; there must be none at ``path``.

    Take as many buckets as give each some gigabytes: an update that names one identifier reads and writes one.
    """
    spark = rows.sparkSession
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    empty = Buckets(f"{path}/rows", id_col, buckets, schema)
    return Store(spark, path, 0, empty)._committed(empty.replaced(latest_by_id(rows, id_col, order_by)))


def open_store(spark: SparkSession, path: str, version: int | None = None) -> Store:
    """The last version of a store, or an earlier one."""
    version, content = read_version(spark, path, version)
    return Store(spark, path, version, Buckets.from_json(f"{path}/rows", content["rows"]))


def upsert_store(store: Store, updates: DataFrame, order_by: Sequence[str] = ()) -> Store:
    """The store's next version: updates replace rows of the same identifier as a whole, or are added.

    Only buckets that have updates are read and written. The updates are written once before they are used twice.
    A writer that was faster makes this one fail with a conflict and the store as that writer left it; the same
    updates again give the same rows.
    """
    key = store.buckets.key
    fresh = materialize(latest_by_id(updates, key, order_by).select(*store.buckets.schema.names), "updates")
    touched = store.buckets.touched(fresh)
    if not touched:
        return store
    rows = store.buckets.lookup(fresh, "left_anti", touched).unionByName(fresh)
    return store._committed(store.buckets.replaced(rows, touched))


def delete_from_store(store: Store, keys: DataFrame) -> Store:
    """The store's next version, without the identifiers in the column named as its key; unknown ones do nothing."""
    known = materialize(store.lookup(keys).select(store.buckets.key), "deleted")
    touched = store.buckets.touched(known)
    if not touched:
        return store
    return store._committed(store.buckets.replaced(store.buckets.lookup(known, "left_anti", touched), touched))


def expire_store(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Forget all but the last ``keep`` versions and remove the folders no version names; returns their names.

    Not while a writer is at work: its folders have no name yet.
    """
    return remove_unnamed(spark, f"{path}/rows", [content["rows"] for content in forget_versions(spark, path, keep)])

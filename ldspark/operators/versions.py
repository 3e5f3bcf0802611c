"""Versions of a collection of files: each is one small text file, made by one atomic step.

A reader opens a version and goes on reading that one, whatever is written meanwhile. A writer names the version its
work is based on; of two writers with the same base one wins, and the other is told.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ldspark import files

Content = dict[str, Any]


class Conflict(RuntimeError):
    """Another writer has made the version after the one this work is based on."""


def _file(path: str, version: int) -> str:
    return f"{path}/versions/{version:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions there are, oldest first."""
    found = [name.removesuffix(".json") for name in files.names(spark, f"{path}/versions")]
    return sorted(int(name) for name in found if name.isdigit())


def read_version(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, Content]:
    """A version's number and content; the last one unless told."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no versions below {path}")
    version = known[-1] if version is None else version
    if version not in known:
        raise FileNotFoundError(f"no version {version} below {path}")
    return version, json.loads(files.read_text(spark, _file(path, version)))


def commit(spark: SparkSession, path: str, based_on: int, content: Content) -> int:
    """Make the version after ``based_on``, 0 for the first; :class:`Conflict` where it is there already."""
    version = based_on + 1
    if not files.write_new(spark, _file(path, version), json.dumps(content, sort_keys=True)):
        raise Conflict(f"version {version} below {path} was made by another writer")
    return version


def forget_versions(spark: SparkSession, path: str, keep: int) -> list[Content]:
    """Remove all but the last ``keep`` versions and return the contents of those that stay."""
    if keep < 1:
        raise ValueError("the current version stays")
    known = versions(spark, path)
    for version in known[:-keep]:
        files.remove(spark, _file(path, version))
    return [read_version(spark, path, version)[1] for version in known[-keep:]]


# --- one name over several tables -------------------------------------------------


def set_alias(spark: SparkSession, path: str, tables: Sequence[str], based_on: int | None = None) -> int:
    """Let the alias at ``path`` name exactly these parquet tables, whatever it named before.

    One step for all readers, and it outlives the session. With ``based_on`` a writer that has seen another version
    than the last one gets :class:`Conflict`; without it the last one is replaced.
    """
    if not tables:
        raise ValueError("an alias needs a table")
    if based_on is None:
        based_on = max(versions(spark, path), default=0)
    return commit(spark, path, based_on, {"tables": list(tables)})


def open_alias(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the tables an alias names now, or named in an earlier version; columns a table lacks are null."""
    _, content = read_version(spark, path, version)
    first, *rest = [spark.read.parquet(table) for table in content["tables"]]
    for table in rest:
        first = first.unionByName(table, allowMissingColumns=True)
    return first


def restore_alias(spark: SparkSession, path: str, version: int) -> int:
    """Let the alias name what it named in an earlier version, as a new version."""
    return set_alias(spark, path, read_version(spark, path, version)[1]["tables"])

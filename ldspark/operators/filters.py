"""Key projections and key filters over records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ldspark.functions.documents import json_value



def parsed_records(records: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """The records whose text is JSON, and those whose text is not."""
    good = F.try_parse_json(F.col(value)).isNotNull()
    return records.filter(good), records.filter(~good)


def checked_records(records: DataFrame, value: str = "value") -> DataFrame:
    """The records as they are; one whose text is no JSON fails the query that reads it, named by its key."""
    broken = F.raise_error(F.concat(F.lit("not JSON, key: "), F.coalesce(F.col("key"), F.lit("null"))))
    good = F.try_parse_json(F.col(value)).isNotNull()
    return records.withColumn(value, F.when(good, F.col(value)).otherwise(broken.cast("string")))


def key_by_field(records: DataFrame, path: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Key JSON text by one of its fields.

    Returns ``(keyed, rejects)``: ``keyed`` has ``key``, the text and ``doc``,
    its variant; text that does not parse or lacks the field is a reject.
    """
    parsed = records.select(
        F.col(value).alias("value"), F.try_parse_json(F.col(value)).alias("doc")
    ).withColumn("key", json_value(F.col("doc"), path))
    keyed = parsed.filter(F.col("key").isNotNull()).select("key", "value", "doc")
    rejects = parsed.filter(F.col("key").isNull()).select("value")
    return keyed, rejects


def keep_keys(records: DataFrame, wanted: Sequence[str] | DataFrame, key: str = "key") -> DataFrame:
    """Records whose key is in a list, or in the single column of a DataFrame.

    A list is a setting of the plan and becomes a pushed-down predicate. Lists
    that come from data belong in a DataFrame, which is deduplicated with
    map-side combine and semi-joined; Spark broadcasts it if it is small when
    measured and splits hot record keys otherwise.
    """
    if not isinstance(wanted, DataFrame):
        return records.filter(F.col(key).isin(list(wanted)))
    (name,) = wanted.columns
    keys = wanted.select(F.col(name).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return records.join(keys, key, "left_semi").select(*records.columns)


def drop_keys(records: DataFrame, unwanted: DataFrame, key: str = "key") -> DataFrame:
    """Records whose key is not in the single column of a DataFrame."""
    (name,) = unwanted.columns
    keys = unwanted.select(F.col(name).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return records.join(keys, key, "left_anti").select(*records.columns)


def constant_key(records: DataFrame, key: str) -> DataFrame:
    """Give every record the same key."""
    return records.withColumn("key", F.lit(key))

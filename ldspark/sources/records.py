"""Readers of keyed and bare records."""

from __future__ import annotations

from typing import Union

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

Schema = Union[str, StructType]


def split_pair(line: Column) -> tuple[Column, Column]:
    """Key and value of a ``key<TAB>value`` line; later tabs belong to the value."""
    pair = F.split(line, "\t", 2)
    return pair[0].alias("key"), F.try_element_at(pair, F.lit(2)).alias("value")


def read_kv_text(spark: SparkSession, path: str) -> DataFrame:
    """``key, value`` from lines of ``key<TAB>json``."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(*split_pair(F.col("value")))


def read_sequence(spark: SparkSession, path: str) -> DataFrame:
    """``key, value`` from a SequenceFile of text pairs.

    Spark has no DataFrame reader for this format, so this is one of the two
    places where rows pass through an RDD.
    """
    return spark.sparkContext.sequenceFile(path).toDF("key STRING, value STRING")


def read_json_lines(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """Typed rows when the schema is known, else the text of each line as ``value``."""
    if schema is not None:
        return spark.read.schema(schema).json(path)
    return spark.read.option("lineSep", "\n").text(path)


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    schema: Schema | None = None,
    header: bool = True,
) -> DataFrame:
    """Delimited text; every column is a string unless a schema is given."""
    reader = spark.read.option("header", header).option("sep", sep).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_records(
    spark: SparkSession,
    path: str,
    kind: str,
    sep: str = ",",
    schema: Schema | None = None,
) -> DataFrame:
    """One entry point for ``text``, ``sequence``, ``json`` and ``csv`` input."""
    if kind == "text":
        return read_kv_text(spark, path)
    if kind == "sequence":
        return read_sequence(spark, path)
    if kind == "json":
        return read_json_lines(spark, path, schema)
    if kind == "csv":
        return read_csv(spark, path, sep, schema)
    raise ValueError(f"unknown input kind {kind!r}: use text, sequence, json or csv")

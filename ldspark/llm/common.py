"""Helpers the operators of this package share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ldspark.session import scratch_path

BATCH_BYTES = 16 << 20
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def bound_batches(spark: SparkSession) -> None:
    """Hold an Arrow batch at about 16 MB, so that long texts cannot fill a worker."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if _as_bytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


_shipped: set[str] = set()


def ready(spark: SparkSession) -> None:
    """Before Python runs on executors: bound its batches and send them this package, once per application."""
    bound_batches(spark)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "ldspark_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def _as_bytes(text: str) -> int:
    digits = "".join(c for c in text if c.isdigit())
    unit = text[len(digits):].strip().lower()[:1]
    return int(digits) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30}.get(unit, 0)


def map_text(
    docs: DataFrame, columns: dict[str, Column], fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` over just the named columns, in batches bounded by bytes."""
    ready(docs.sparkSession)
    return docs.select(*[c.alias(n) for n, c in columns.items()]).mapInArrow(fn, schema)


def text_of(column: str) -> Column:
    """A text column as a string, null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row in one struct, out of the way of an operator's own names."""
    return F.struct(*[F.col(quoted(c)).alias(c) for c in docs.columns])


def unpack(df: DataFrame, struct: str, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(struct).getField(c).alias(c) for c in columns])


def write_scratch(df: DataFrame, label: str) -> DataFrame:
    """Write once below the shared scratch folder and read back: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""One name over several collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def swap_alias(spark: SparkSession, alias: str, tables: Sequence[DataFrame | str]) -> DataFrame:
    """Point ``alias`` at exactly these tables or views, whatever it named before."""
    if not tables:
        raise ValueError("an alias needs a table")
    frames = [spark.table(t) if isinstance(t, str) else t for t in tables]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    out.createOrReplaceTempView(alias)
    return spark.table(alias)

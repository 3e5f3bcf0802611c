"""Reading a document index with a query."""

from __future__ import annotations

from typing import Any, Union

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_index(
    spark: SparkSession,
    path: str,
    query: Union[Column, str, None] = None,
    fmt: str = "parquet",
    schema: Union[str, StructType, None] = None,
    missing_as_empty: bool = False,
    **options: Any,
) -> DataFrame:
    """Rows of an index that match a predicate.

    The predicate is a plain filter, so the source evaluates what it can. With
    ``missing_as_empty`` a path that does not exist gives no rows; this needs a
    schema.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.load(path)
    except AnalysisException as error:
        if not missing_as_empty or error.getCondition() != "PATH_NOT_FOUND":
            raise
        if schema is None:
            raise ValueError("a missing index needs a schema to be read as empty") from error
        df = spark.createDataFrame([], schema)
    return df if query is None else df.filter(query)

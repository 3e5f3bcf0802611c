"""Cells with versions and delete markers, and a layout by row key of which a range reads only its files.

A versioned cell is ``row_key, family, qualifier, version, value, op``. Its ``op`` is one of ``OPS``: ``put`` writes a
value, ``delete_version`` takes back the value of just its version, ``delete_column``, ``delete_family`` and
``delete_row`` take back all values of their column, family or row up to their version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ldspark.operators.cells import scan_cells

CELL = ("row_key", "family", "qualifier")
OPS = ("put", "delete_version", "delete_column", "delete_family", "delete_row")
_SCOPES = {"delete_column": CELL, "delete_family": CELL[:2], "delete_row": CELL[:1]}


def _undeleted(cells: DataFrame) -> DataFrame:
    """The puts no marker takes back. Markers are combined per scope before they are joined with the puts."""
    puts = cells.filter(F.col("op") == "put").select(*CELL, "version", "value")
    for op, scope in _SCOPES.items():
        markers = cells.filter(F.col("op") == op).groupBy(*scope).agg(F.max("version").alias("_upto"))
        joined = puts.join(markers, list(scope), "left")
        puts = joined.filter(F.col("_upto").isNull() | (F.col("version") > F.col("_upto"))).drop("_upto")
    exact = cells.filter(F.col("op") == "delete_version").select(*CELL, "version").distinct()
    return puts.join(exact, [*CELL, "version"], "left_anti")


def latest_versions(
    cells: DataFrame,
    versions: int = 1,
    since: int | None = None,
    before: int | None = None,
    start: str | None = None,
    stop: str | None = None,
    families: Sequence[str] = (),
) -> DataFrame:
    """``row_key, family, qualifier, version, value``: the last ``versions`` values of each cell in a range of
    versions, from ``since`` up to but without ``before``.

    * Two puts of one cell and version are one value, the greatest. An ``op`` of null is a put; any other that is
      not in ``OPS`` is an error.
    * A marker counts whatever the range asked for, and whether it came before or after the puts it takes back. It
      does not hide a later version, nor one that is put again with a version above it.
    * The range of rows, the families and the range of versions are filters on stored columns, so they reach the scan.
      A cell may have any number of versions: its last ones are picked per input partition before the shuffle, up to
      the limit Spark does that for.
    """
    if versions < 1:
        raise ValueError("at least one version")
    scanned = scan_cells(cells, start, stop)
    if since is not None or before is not None:
        low = F.lit(True) if since is None else F.col("version") >= since
        high = F.lit(True) if before is None else F.col("version") < before
        scanned = scanned.filter((F.col("op") != "put") | (low & high))
    if families:
        scanned = scanned.filter(F.col("family").isin(list(families)) | (F.col("op") == "delete_row"))
    known = F.coalesce("op", F.lit("put"))
    wrong = F.raise_error(F.concat(F.lit("unknown op "), known))
    checked = scanned.withColumn("op", F.when(known.isin(*OPS), known).otherwise(wrong))
    values = _undeleted(checked).groupBy(*CELL, "version").agg(F.max("value").alias("value"))
    if families:
        values = values.filter(F.col("family").isin(list(families)))
    newest = Window.partitionBy(*CELL).orderBy(F.col("version").desc())
    ranked = values.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= versions)
    return ranked.drop("_rank")


def write_clustered(cells: DataFrame, path: str, files: int | None = None) -> None:
    """Write cells sorted by row key, and beside them the first and last row key of every file.

    Rows are dealt by sampled splitters of row key, family and version, so a row key that holds many cells is in
    several files, all of which a range that has it reads. The list of files is a table of its own.
    """
    order = [c for c in ("row_key", "family", "qualifier", "version") if c in cells.columns]
    dealt = cells.repartitionByRange(files, *order) if files else cells.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.parquet(f"{path}/cells")
    written = cells.sparkSession.read.schema(cells.schema).parquet(f"{path}/cells")
    name = F.col("_metadata.file_path")
    bounds = written.groupBy(name.alias("file")).agg(F.min("row_key").alias("first"), F.max("row_key").alias("last"))
    bounds.write.parquet(f"{path}/files")


def read_clustered(
    spark: SparkSession,
    path: str,
    schema: str,
    start: str | None = None,
    stop: str | None = None,
    families: Sequence[str] = (),
) -> DataFrame:
    """The cells of a range of row keys, from the files that hold some; the range and the families reach the scan.

    The driver sees the names of the files in the range and no others.
    """
    bounds = spark.read.schema("file STRING, first STRING, last STRING").parquet(f"{path}/files")
    if start is not None:
        bounds = bounds.filter(F.col("last") >= start)
    if stop is not None:
        bounds = bounds.filter(F.col("first") < stop)
    names = [row["file"] for row in bounds.select("file").collect()]
    cells = spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)
    return scan_cells(cells, start, stop, families)

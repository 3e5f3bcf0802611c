"""Wide rows as cells: ``row_key, family, qualifier, value``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ldspark.functions.terms import lexical
from ldspark.operators.reducing import VALUES_PER_ROW
from ldspark.operators.skew import split_groups


def docs_to_cells(df: DataFrame, row_key: str, family: str, columns: Sequence[str]) -> DataFrame:
    """Unpivot columns to cells; nulls give no cell."""
    strings = [
        lexical(df.schema[c].dataType)(F.col(c)).alias(c) for c in columns
    ]
    key = lexical(df.schema[row_key].dataType)(F.col(row_key)).alias("row_key")
    return (
        df.select(key, *strings)
        .unpivot("row_key", list(columns), "qualifier", "value")
        .filter(F.col("value").isNotNull())
        .select("row_key", F.lit(family).alias("family"), "qualifier", "value")
    )


def scan_cells(
    cells: DataFrame,
    start: str | None = None,
    stop: str | None = None,
    families: Sequence[str] = (),
) -> DataFrame:
    """Row keys from ``start`` up to but without ``stop``, of some families."""
    if start is not None:
        cells = cells.filter(F.col("row_key") >= start)
    if stop is not None:
        cells = cells.filter(F.col("row_key") < stop)
    if families:
        cells = cells.filter(F.col("family").isin(list(families)))
    return cells


def current_cells(cells: DataFrame, version: str | None = None) -> DataFrame:
    """One value per cell: the newest by ``version``, else the greatest."""
    value = F.col("value")
    pick = F.max_by(value, F.struct(version, value)) if version else F.max(value)
    return cells.groupBy("row_key", "family", "qualifier").agg(pick.alias("value"))


def cells_to_docs(
    cells: DataFrame, version: str | None = None, cells_per_row: int = VALUES_PER_ROW
) -> DataFrame:
    """``row_key, part, parts, cells MAP<family:qualifier, value>``.

    Row keys with more than ``cells_per_row`` cells continue in further parts,
    as many as their own number of cells asks for.
    """
    current = current_cells(cells, version)
    placed = split_groups(current, ["row_key"], ["family", "qualifier"], cells_per_row)
    name = F.concat_ws(":", "family", "qualifier")
    entries = F.sort_array(F.collect_list(F.struct(name.alias("name"), "value")))
    return placed.groupBy("row_key", "part", "parts").agg(F.map_from_entries(entries).alias("cells"))


def cells_to_columns(
    cells: DataFrame, columns: Sequence[tuple[str, str]], version: str | None = None
) -> DataFrame:
    """One row per row key with the named ``(family, qualifier)`` cells as columns.

    A column is named by its qualifier, or ``family:qualifier`` where two families
    are asked for the same one. A conditional aggregate with one buffer per
    column, combined map-side, so a row key of any width is safe.
    """
    value = F.col("value")
    qualifiers = [q for _, q in columns]

    def is_cell(family: str, qualifier: str) -> Column:
        return (F.col("family") == family) & (F.col("qualifier") == qualifier)

    def pick(family: str, qualifier: str) -> Column:
        name = qualifier if qualifiers.count(qualifier) == 1 else f"{family}:{qualifier}"
        mine = is_cell(family, qualifier)
        if version:
            return F.max_by(value, F.when(mine, F.struct(version, value))).alias(name)
        return F.max(F.when(mine, value)).alias(name)

    wanted = reduce(or_, [is_cell(f, q) for f, q in columns])
    return cells.filter(wanted).groupBy("row_key").agg(*[pick(f, q) for f, q in columns])


def cell_lines(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row per line of a multi-line value."""
    return df.select(F.col(key), F.explode(F.split(value, "\n", -1)).alias("line"))


def cell_documents(df: DataFrame, key: str, value: str) -> DataFrame:
    """One parsed document per line; malformed lines have a null ``doc``."""
    return cell_lines(df, key, value).withColumn("doc", F.try_parse_json("line"))

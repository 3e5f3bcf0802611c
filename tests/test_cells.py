import pytest
from pyspark.sql import functions as F

from helpers import rows
from ldspark.operators import (
    cell_documents,
    cell_lines,
    cells_to_columns,
    cells_to_docs,
    docs_to_cells,
    scan_cells,
)

CELL = "row_key STRING, family STRING, qualifier STRING, value STRING, version INT"


def test_round_trip_without_nulls(spark):
    df = spark.createDataFrame([(1, "a", 2), (2, None, 3), (3, None, None)], "id INT, x STRING, y INT")
    cells = docs_to_cells(df, "id", "f", ["x", "y"])
    assert rows(cells) == [("1", "f", "x", "a"), ("1", "f", "y", "2"), ("2", "f", "y", "3")]
    assert rows(cells_to_docs(cells)) == sorted(
        [("1", 0, 1, {"f:x": "a", "f:y": "2"}), ("2", 0, 1, {"f:y": "3"})], key=repr
    )
    assert rows(cells_to_columns(cells, [("f", "x"), ("f", "y")])) == [("1", "a", "2"), ("2", None, "3")]


def test_the_newest_version_of_a_cell_counts(spark):
    cells = spark.createDataFrame(
        [("r", "f", "q", "old", 1), ("r", "f", "q", "new", 2), ("r", "g", "q", "other", 1)], CELL
    )
    assert rows(cells_to_docs(cells, "version")) == [("r", 0, 1, {"f:q": "new", "g:q": "other"})]
    assert rows(cells_to_columns(cells, [("f", "q")], "version")) == [("r", "new")]
    assert rows(cells_to_docs(cells)) == [("r", 0, 1, {"f:q": "old", "g:q": "other"})]


def test_scan_range_and_families(spark):
    cells = spark.createDataFrame(
        [(k, f, "q", "v", 1) for k in ("a", "b", "c") for f in ("f", "g")], CELL
    )
    assert {r[0] for r in scan_cells(cells, "a", "c").collect()} == {"a", "b"}
    assert scan_cells(cells, families=["g"]).count() == 3
    assert scan_cells(cells).count() == 6


@pytest.mark.parametrize("limit", [7, 1000])
def test_wide_rows_continue_in_parts(spark, limit):
    cells = spark.range(100).select(
        F.lit("wide").alias("row_key"), F.lit("f").alias("family"),
        F.col("id").cast("string").alias("qualifier"), F.lit("v").alias("value"),
    )
    docs = cells_to_docs(cells, cells_per_row=limit)
    got = docs.select(F.explode("cells").alias("k", "v"))
    assert got.select("k").distinct().count() == got.count() == 100
    assert (docs.count() > 1) == (limit < 100)


def test_lines_of_a_cell(spark):
    df = spark.createDataFrame([("a", '{"k":1}\n{broken\n'), ("b", None), ("c", "")], "key STRING, v STRING")
    assert rows(cell_lines(df, "key", "v")) == sorted(
        [("a", '{"k":1}'), ("a", "{broken"), ("a", ""), ("c", "")], key=repr
    )
    parsed = cell_documents(df, "key", "v").select("key", F.to_json("doc")).filter("doc IS NOT NULL")
    assert rows(parsed) == [("a", '{"k":1}')]


def test_one_qualifier_in_two_families(spark):
    data = [("a", "f", "q", "1"), ("a", "g", "q", "2"), ("b", "h", "q", "3"), ("c", "g", "q", "4")]
    cells = spark.createDataFrame(data, "row_key STRING, family STRING, qualifier STRING, value STRING")
    both = cells_to_columns(cells, [("f", "q"), ("g", "q")])
    assert both.columns == ["row_key", "f:q", "g:q"]
    assert rows(both) == [("a", "1", "2"), ("c", None, "4")]
    assert rows(cells_to_columns(cells, [("f", "q")])) == [("a", "1")]

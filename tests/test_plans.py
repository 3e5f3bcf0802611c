"""Plans of the registered queries: built-ins only, no cross joins, bounded broadcasts."""

import os

import pytest

from helpers import plan
from ldspark.catalogue import ORACLE, QUERIES
from ldspark.catalogue import models as m
from ldspark.operators import frame_documents, reduce_statements, to_nodes

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

LAZY = [
    "index_query", "docs_to_cells", "cells_to_docs", "cells_to_columns", "cell_lines", "upsert_by_id",
    "drop_field", "filter_uris_semi", "apply_models_multi", "apply_model_json", "reduce_by_uri",
    "reduce_single_valued", "apply_context", "frame_types", "types_with_uris", "pair_models_roots",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("EvalPython", "InPandas", "MapInArrow", "CartesianProduct", "NestedLoopJoin"):
        assert word not in text


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_mapping_has_no_shuffle(spark):
    for name in ("apply_model_statements", "apply_models_multi", "apply_model_json", "apply_model_ntriples"):
        assert "Exchange" not in plan(QUERIES[name](spark, SF))


def test_index_filter_reaches_the_scan(spark):
    assert "EqualTo(o_orderstatus,F)" in plan(QUERIES["index_query"](spark, SF))


def test_reduce_combines_before_its_shuffle(spark):
    df = reduce_statements(m.entity_statements(spark, SF))
    text = plan(df)
    before, after = text.split("Exchange", 1)
    assert "HashAggregate" in before and "HashAggregate" in after


def test_merge_limit_ranks_before_its_shuffle(spark, tmp_path):
    path = str(tmp_path / "n")
    to_nodes(m.entity_statements(spark, SF, m.CONTEXT)).write.parquet(path)
    framed = frame_documents(spark.read.parquet(path), m.CUSTOMER_FRAME, merge_limit=10)
    text = plan(framed)
    assert "row_number(), 10, Partial" in text and "row_number(), 10, Final" in text

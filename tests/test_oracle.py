"""Every registered query against its SQL over the same tables."""

import os

import pytest

from ldspark.catalogue import ORACLE, QUERIES
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert compare(spark, db, name, QUERIES[name], ORACLE[name], SF) is None

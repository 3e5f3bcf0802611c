"""The library's operators as named queries over the test tables, with SQL twins."""

from ldspark.catalogue.oracle import ORACLE
from ldspark.catalogue.queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]

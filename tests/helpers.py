"""Small builders shared by the tests."""

from __future__ import annotations

STATEMENT = "s STRING, p STRING, o STRING, kind STRING"


def statements(spark, rows):
    return spark.createDataFrame(rows, STATEMENT)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

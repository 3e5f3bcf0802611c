"""Compare registered queries with their SQL twins, values and counts."""

from __future__ import annotations

import collections
import glob
import os
import sys
import time

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a short text on the first difference."""
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    ours = collections.Counter(tuple(r) for r in df.select(*columns).collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} and {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = collections.Counter(tuple(r[i] for i in order) for r in result.fetchall())
    if not theirs:
        return "the SQL gives no rows"
    if ours == theirs:
        return None
    extra, missing = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
    return f"{sum(ours.values())} and {sum(theirs.values())} rows; only ours {extra}; only SQL {missing}"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from ldspark.catalogue import ORACLE, QUERIES
    from ldspark.session import build_session

    sf = sys.argv[1]
    only = sys.argv[2:] or list(QUERIES)
    session = build_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    db = connect(sf)
    for key in only:
        start = time.time()
        try:
            problem = compare(session, db, key, QUERIES[key], ORACLE[key], sf)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {key} {time.time() - start:.2f}s {problem or ''}", flush=True)

"""Versions and delete markers of cells, against a store in a dictionary."""

import random

import pytest
from helpers import plan, rows

from ldspark.operators.cell_versions import CELL, OPS, latest_versions, read_clustered, write_clustered

SCHEMA = "row_key STRING, family STRING, qualifier STRING, version BIGINT, value STRING, op STRING"
ODD = ["v", "é\t", "\U0001f600\n", '"\\', ""]


def kept(cells, versions=1, since=None, before=None, start=None, stop=None, families=()):
    puts = {}
    for row, family, qualifier, version, value, op in cells:
        if op in (None, "put"):
            key = (row, family, qualifier, version)
            puts[key] = max(value, puts.get(key, value))
    for row, family, qualifier, version, _, op in cells:
        for key in list(puts):
            same = {
                "delete_row": key[0] == row,
                "delete_family": key[:2] == (row, family),
                "delete_column": key[:3] == (row, family, qualifier),
            }
            if same.get(op) and key[3] <= version or op == "delete_version" and key == (row, family, qualifier, version):
                del puts[key]
    out = {}
    for (row, family, qualifier, version), value in puts.items():
        inside = (since is None or version >= since) and (before is None or version < before)
        inside &= (start is None or row >= start) and (stop is None or row < stop) and (not families or family in families)
        if inside:
            out.setdefault((row, family, qualifier), []).append((version, value))
    return sorted((*cell, *one) for cell, own in out.items() for one in sorted(own, reverse=True)[:versions])


def made(seed, n=400):
    rng = random.Random(seed)
    return [
        (f"r{rng.randrange(6)}", rng.choice("fg"), rng.choice("ab"), rng.randrange(12), rng.choice(ODD), rng.choice([None] + ["put"] * 14 + list(OPS)))
        for _ in range(n)
    ] + [("hot", "f", "a", i, str(i), "put") for i in range(300)] + [("gone", "f", "a", 1, "x", "put"), ("gone", None, None, 1, None, "delete_row")]


@pytest.mark.parametrize(
    "asked",
    [{}, {"versions": 3}, {"versions": 2, "since": 3, "before": 9}, {"start": "r1", "stop": "r4", "families": ["g"], "versions": 5}, {"versions": 2000}],
)
def test_equals_a_store_in_a_dictionary(spark, asked):
    cells = made(1)
    frame = spark.createDataFrame(cells, SCHEMA).repartition(3)
    assert sorted(map(tuple, latest_versions(frame, **asked).collect())) == kept(cells, **asked)


def test_filters_reach_the_scan_and_versions_are_picked_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "cells")
    spark.createDataFrame(made(2), SCHEMA).write.parquet(path)
    text = plan(latest_versions(spark.read.parquet(path), 2, start="r1", stop="r3", families=["f"]))
    assert "GreaterThanOrEqual(row_key,r1)" in text and "LessThan(row_key,r3)" in text
    assert "WindowGroupLimit" in text and "Python" not in text


def test_range_reads_only_its_files(spark, tmp_path):
    path = str(tmp_path / "clustered")
    cells = [(f"k{i:04d}", "f", "a", 1, ODD[i % 5], "put") for i in range(1000)] + [("k0500", "f", "b", i, "x", "put") for i in range(500)]
    frame = spark.createDataFrame(cells, SCHEMA).repartition(5)
    write_clustered(frame, path, files=12)
    every = read_clustered(spark, path, SCHEMA)
    few = read_clustered(spark, path, SCHEMA, "k0100", "k0150")
    assert len(every.inputFiles()) >= 10 and len(few.inputFiles()) <= 3
    assert rows(few) == rows(frame.filter("row_key >= 'k0100' AND row_key < 'k0150'")) and rows(every) == rows(frame)
    assert "PushedFilters: [IsNotNull(row_key), GreaterThanOrEqual(row_key,k0100), LessThan(row_key,k0150)]" in plan(few)
    hot = read_clustered(spark, path, SCHEMA, "k0500", "k0501", ["f"])
    assert hot.count() == 501 and len(hot.inputFiles()) > 1
    assert read_clustered(spark, path, SCHEMA, "x").isEmpty()


def test_odd_rows(spark):
    assert latest_versions(spark.createDataFrame([], SCHEMA)).isEmpty()
    with pytest.raises(ValueError):
        latest_versions(spark.createDataFrame([], SCHEMA), 0)
    with pytest.raises(Exception, match="unknown op"):
        latest_versions(spark.createDataFrame([("r", "f", "a", 1, "v", "wipe")], SCHEMA)).collect()
    again = [("r", "f", "a", 1, "v", "put"), ("r", "f", "a", 5, None, "delete_column"), ("r", "f", "a", 6, "w", "put")]
    assert rows(latest_versions(spark.createDataFrame(again, SCHEMA), 9)) == [("r", "f", "a", 6, "w")]
    assert CELL == ("row_key", "family", "qualifier")

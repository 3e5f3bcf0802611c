"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from .common import write_scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written to the scratch folder, and their number and digest, observed while they are written."""
    seen = Observation()
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("digest")
    stored = write_scratch(edges.observe(seen, F.count(F.lit(1)).alias("n"), digest), "edges")
    return stored, (seen.get["n"], seen.get["digest"])


def components(edges: DataFrame, left: str = "a", right: str = "b", rounds: int = 60) -> DataFrame:
    """``node``, ``root`` for every node of an edge, ``root`` the smallest node it reaches; each node once.

    Loops, repeated and reversed edges are fine; edges with a null end are left out; no edges give no rows. Each
    round is written to the shared scratch folder, so lineage stays short and lost executors cost one round. The
    neighbourhood of a node, however large, is only ever aggregated to its minimum and joined, never gathered.
    """
    a, b = F.col(left), F.col(right)
    edges, state = _written(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    for _ in range(rounds if state[0] else 0):
        before = state
        edges, state = _written(_small_star(_large_star(edges).distinct()))
        if state == before:
            break
    else:
        if state[0]:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )

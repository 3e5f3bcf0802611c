"""Near-duplicate documents by SimHash fingerprints and multi-index hashing.

Fingerprints of 64 bits are linked at a distance of three or fewer bits. One of the two 32-bit segments of such a
pair then differs in at most one bit: each fingerprint probes the table of each segment with the ball of radius
one around its segment, and complete distances of the matches are verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import ready, text_of, unpack, whole_row, write_scratch
from .components import components

SEED = 42
DISTANCE = 3
SEGMENT = 32
BUCKET_ROWS = 512
_CHUNK = 1 << 15


def fingerprint(text: str, words_per_shingle: int = 3) -> int:
    """SimHash of a text's word shingles; zero without words. A bit is set if over half the hashes have it."""
    words = text.encode().lower().split()
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    shingles = len(words) - k + 1
    set_bits = np.zeros(64, np.int64)
    for start in range(0, shingles, _CHUNK):
        part = words[start : start + _CHUNK + k - 1]
        joined = map(b" ".join, zip(*[part[i:] for i in range(k)]))
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > shingles, bitorder="little").view("<u8")[0])


def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array(np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64).view(np.int64))


def _segments(fingerprints: DataFrame) -> DataFrame:
    """``fp``, ``seg``, ``key`` (the segment's bits), ``rest`` (the other segment's bits)."""
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", SEGMENT)
    return fingerprints.select(
        "fp",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("seg"), low.alias("key"), high.alias("rest")),
                F.struct(F.lit(1).alias("seg"), high.alias("key"), low.alias("rest")),
            )
        ).alias("s"),
    ).select("fp", "s.*")


_ONE_BIT = [1 << i for i in range(SEGMENT)]
_TWO_BITS = [a | b for i, a in enumerate(_ONE_BIT) for b in _ONE_BIT[:i]]


def _masks(values: list[int]):
    return F.array(*[F.lit(v).cast("long") for v in values])


def links(fingerprints: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``a``, ``b``: links between the distinct longs of column ``fp`` that give the components of all pairs at a
    distance of three bits or fewer.

    A table entry of at most ``bucket_rows`` fingerprints is compared with its probes one by one. In a larger one
    fingerprints share a segment, and comparing all would grow with the square of its size. There every member
    names the points within two bits of its other segment, every probe from the next entries those within one
    bit; at a point with a member within one bit, all others are linked to that member. That links exactly what
    the pairs would connect, at no more than 529 rows for a fingerprint, and a point holds at most 529 members.
    """
    index = _segments(fingerprints)
    # The end with a zero in the differing bit probes, so that each pair of entries is met from one side.
    flips = F.concat(F.array(F.lit(0).cast("long")), F.filter(_masks(_ONE_BIT), lambda m: F.col("key").bitwiseAND(m) == 0))
    probes = index.select("fp", "seg", "rest", "key", F.explode(flips).alias("flip")).select(
        "fp", "seg", "rest", "flip", F.col("key").bitwiseXOR(F.col("flip")).alias("key")
    )
    entries = index.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n"))
    # Probes are many times the rows they are made from, which their estimated size does not show: never broadcast.
    met = probes.join(entries.hint("merge"), ["seg", "key"]).where("flip <> 0 OR n > 1")

    other = index.select("seg", "key", F.col("fp").alias("other"))
    pairs = (
        met.where(F.col("n") <= bucket_rows)
        .join(other.hint("merge"), ["seg", "key"])
        .where("flip <> 0 OR fp < other")
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= DISTANCE)
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))
    )

    def ball(rows: DataFrame, masks: list[int], radius: int) -> DataFrame:
        return rows.select("fp", "seg", "key", "flip", F.explode(_masks(masks)).alias("m"), "rest").select(
            "fp", "seg", "key", "flip", F.lit(radius).alias("radius"), F.col("rest").bitwiseXOR(F.col("m")).alias("point")
        )

    large = met.where(F.col("n") > bucket_rows)
    near = ball(large, [0, *_ONE_BIT], 1)
    points = near.union(ball(large.where("flip = 0"), _TWO_BITS, 2))
    member = F.when((F.col("flip") == 0) & (F.col("radius") == 1), F.col("fp"))
    stars = (
        points.withColumn("centre", F.min(member).over(Window.partitionBy("seg", "key", "point")))
        .where("centre IS NOT NULL AND centre <> fp")
        .select(F.col("centre").alias("a"), F.col("fp").alias("b"))
    )
    return pairs.union(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``id``, ``fp`` (long), ``digest`` of the text, ``component_id``: the smallest identifier the row reaches.

    One row per row. Null text counts as empty; texts without words have fingerprint zero, which is linked like
    any other; an empty table gives no rows; other columns are not read. Rows and identifiers may repeat; null
    identifiers never name a component unless it has no other, and then ``component_id`` is null. Equal
    fingerprints meet before any pair is made, so copies cost one row each.
    """
    ready(docs.sparkSession)
    text, fingerprints = text_of(text_col), F.arrow_udf(_fingerprints, "bigint")
    rows = write_scratch(
        docs.select(F.col(id_col).alias("id"), fingerprints(text).alias("fp"), F.xxhash64(text).alias("digest")), "fingerprints"
    )
    distinct = write_scratch(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    linked = components(links(distinct.select("fp"), bucket_rows))
    named = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("id", "fp", "digest", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One document of each component, the one with the smallest identifier, with the columns of ``docs``.

    Rows with a null identifier cannot be told apart and form a component's document only where it has no other.
    """
    found = near_duplicates(docs, id_col, text_col, bucket_rows)
    first = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    # Components that have no identifier share the null group, so the fingerprint keeps them apart.
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp")).alias("lone")]
    keepers = found.groupBy(*group).agg(F.min(first).alias("k")).select(
        F.col("k.id").alias("keep_id"), F.col("k.digest").alias("keep_digest")
    ).distinct()
    rows = docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("digest"))
    # By file size alone Spark may take the rows for the smaller side and broadcast whole texts.
    kept = rows.join(
        keepers.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("digest") == F.col("keep_digest"))
    )
    place = F.row_number().over(Window.partitionBy("id", "digest").orderBy(F.lit(0)))
    return unpack(kept.withColumn("place", place).where("place = 1"), "row", docs.columns)

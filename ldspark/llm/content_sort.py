"""Exact dedup by sorting contents.

Texts are equal when they are the same after every run of ASCII white space became one space. Rows are range
partitioned by sampled splitters on the head of that text and its digest, sorted within each partition, and each
row is compared with its neighbour over the whole text. Everything is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import SPACE, text_of, unpack, whole_row

HEAD = 16
GROUP_ROWS = 1000
LISTED_GROUPS = 1_000_000


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """Every row with what the sort decided: ``row`` (all columns of the input), ``id``, ``keep_id``,
    ``group_size``, ``kept``, ``text_sha256``.

    * Of equal texts the row with the smallest identifier stays; exactly one row of a group, also when rows or
      identifiers repeat. A null identifier sorts last and stays only where a group has no other.
    * A null text counts as empty; an empty table gives no rows; other columns are carried as they are.
    * The splitters are taken from the first characters of the text, its digest and the salt, so what the driver
      samples is short however long the texts are, and texts with a common head are told apart.
    * Groups of more than ``group_rows`` rows (or a millionth of the table, where that is more) are dealt over
      several partitions by a hash of the identifier. Their number is below a million, so their list of digest,
      size and smallest identifier is bounded and broadcast; only these groups are told by their digest.
    """
    norm = F.regexp_replace("text", SPACE, " ")
    keyed = docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    hashed = keyed.select("row", "id", "text", F.sha2(norm, 256).alias("sha"), F.left(norm, F.lit(HEAD)).alias("head"))
    limit = max(group_rows, docs.count() // LISTED_GROUPS)
    large = (
        hashed.groupBy("sha")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("first"))
        .where(F.col("rows") > limit)
    )
    shares = F.ceil(F.col("rows") / F.lit(limit))
    salted = hashed.join(F.broadcast(large), "sha", "left").withColumn(
        "salt", F.when(F.col("rows").isNotNull(), F.pmod(F.xxhash64("id"), shares)).otherwise(F.lit(0)).cast("long")
    )
    dealt = salted.repartitionByRange("head", "sha", "salt").withColumn("norm", norm)
    same = Window.partitionBy("head", "sha", "salt", "norm").orderBy(F.col("id").asc_nulls_last())
    group = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    judged = dealt.select(
        "row",
        "id",
        "sha",
        F.col("rows").isNotNull().alias("spread"),
        "rows",
        "first",
        F.first("id").over(group).alias("local_first"),
        F.count(F.lit(1)).over(group).alias("local_rows"),
        F.row_number().over(same).alias("place"),
    )
    keep = F.when(F.col("spread"), F.col("first")).otherwise(F.col("local_first"))
    # Rows of one identifier share a salt, so the first place of a spread group is unique too; with null
    # identifiers only, all share the salt of null.
    return judged.select(
        "row",
        "id",
        keep.alias("keep_id"),
        F.when(F.col("spread"), F.col("rows")).otherwise(F.col("local_rows")).cast("long").alias("group_size"),
        ((F.col("place") == 1) & F.col("id").eqNullSafe(keep)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    return unpack(content_sort(docs, id_col, text_col).where("kept"), "row", docs.columns)

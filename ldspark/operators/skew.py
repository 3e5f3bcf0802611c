"""Splitting keys that hold too many rows for one task.

Two things are told apart. Where the split shows in the result, as in the parts
of a large document, it depends on the key's own rows alone: they are counted in
full, and the counts of large keys are joined back without a forced broadcast.

Where it only spreads work, as in a join, any list of hot keys gives the same
rows. A key is then hot when it holds more rows than asked for *and* more than
one millionth of all rows. The second condition bounds the list: at most one
million keys can be hot, whatever the data. The list carries a 64-bit hash and a
count per key, about 16 MB at most, so it is the one thing here that may be
broadcast. Rows are counted in a share picked by hash, so that a key at the limit
still has about ``COUNTED_AT_LIMIT`` rows in it.

Splitting is by hash of the row's own values, never by position, so a task that
runs again puts every row where it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ldspark.session import materialize

MAX_HOT_KEYS = 1_000_000
ROWS_PER_TASK = 500_000
COUNTED_AT_LIMIT = 200
MAPPED_ROWS = 100_000
GROUPED_ROWS = 500_000
KEY_BINS = 1 << 18


def hot_keys(
    df: DataFrame, keys: Sequence[str], spread: Sequence[str], rows_per_part: int
) -> DataFrame:
    """``key_hash, parts`` for the keys to split; counted map-side first.

    ``keys`` and ``spread`` together should tell rows apart.
    """
    share = max(1, rows_per_part // COUNTED_AT_LIMIT)
    if share > 1:
        picked = F.pmod(F.xxhash64(*keys, *spread, F.lit(share)), F.lit(share)) == 0
        df = df.filter(picked)
    per_part = rows_per_part / share
    counts = df.groupBy(F.xxhash64(*keys).alias("key_hash")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("n"))
    limit = F.greatest(F.lit(per_part), total.scalar() / F.lit(float(MAX_HOT_KEYS)))
    return counts.filter(F.col("n") > limit).select(
        "key_hash", F.ceil(F.col("n") / per_part).cast("int").alias("parts")
    )


def with_parts(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    marked = df.withColumn("_hash", F.xxhash64(*keys))
    return (
        marked.join(F.broadcast(hot), marked["_hash"] == hot["key_hash"], "left")
        .drop("key_hash")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
    )


def part_of(spread: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*spread), F.col("parts")).cast("int")


def spread_rows(df: DataFrame, rows_per_task: int = MAPPED_ROWS) -> DataFrame:
    """The same rows, dealt to tasks of about ``rows_per_task`` by hash of their values.

    A small file may hold millions of short rows and be one task, whatever the size of a split. For inputs of models:
    a task makes several statements of a row and holds the distinct ones. Rows are counted from the files' footers;
    where one task is enough nothing is moved.
    """
    tasks = tasks_of(df.count(), rows_per_task)
    return df if tasks == 1 else df.repartition(tasks, F.xxhash64(*df.columns))


def tasks_of(rows: int, rows_per_task: int) -> int:
    return max(1, -(-rows // rows_per_task))


def split_groups(
    df: DataFrame, keys: Sequence[str], spread: Sequence[str], rows_per_part: int
) -> DataFrame:
    """Adds ``part`` and ``parts``: the rows of a key with more than
    ``rows_per_part`` of them go to several parts by ``spread``.

    The number of parts is the key's own, whatever else the collection holds. The
    rows are written once and counted from there, so the input is read once. They
    are counted by bins of keys first, of which there are few; a key can only be
    large in a bin that is, and only keys of such bins are counted one by one. The
    list of large keys has a measured size when the join is planned; where it is
    empty there is no join.
    """
    return sized_groups(df, keys, spread, rows_per_part)[0]


def sized_groups(
    df: DataFrame, keys: Sequence[str], spread: Sequence[str], rows_per_part: int
) -> tuple[DataFrame, int]:
    """:func:`split_groups`, and how many tasks its rows should be grouped in."""
    rows = materialize(df, "grouped")
    bin_of = F.pmod(F.xxhash64(*keys), F.lit(KEY_BINS)).cast("int").alias("_bin")
    bins = materialize(rows.groupBy(bin_of).agg(F.count(F.lit(1)).alias("n")), "group-bins")
    tasks = tasks_of(bins.agg(F.sum("n")).first()[0] or 0, GROUPED_ROWS)
    whole = rows.withColumn("parts", F.lit(1)).withColumn("part", F.lit(0))
    full = bins.filter(F.col("n") > rows_per_part).select("_bin")
    if full.isEmpty():
        return whole, tasks
    some = rows.select(*keys, bin_of).join(full, "_bin", "left_semi")
    counts = some.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows_per_part)
    parts = F.ceil(F.col("n") / F.lit(rows_per_part)).cast("int").alias("parts")
    large = materialize(counts.select(*keys, parts), "large-groups")
    if large.isEmpty():
        return whole, tasks
    marked = rows.join(large, list(keys), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    return marked.withColumn("part", part_of(spread)), tasks


def salted_join(
    many: DataFrame,
    one: DataFrame,
    on: str,
    spread: Sequence[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join in which a key of ``many`` may hold any share of the rows.

    Hot keys get a salt on the left, and only their rows of ``one`` are repeated
    per salt; every other row is joined as it is. A list of hot keys that is known
    already may be given; any list gives the same rows.
    """
    if hot is None:
        hot = hot_keys(many, [on], spread, rows_per_task)
    left = with_parts(many, [on], hot).withColumn("_salt", part_of(spread)).drop("parts")
    right = (
        with_parts(one, [on], hot)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .drop("parts")
    )
    # identifiers share long prefixes; with the hash first the join sorts by a number
    return left.join(right, ["_hash", on, "_salt"], how).drop("_hash", "_salt")

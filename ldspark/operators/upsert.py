"""Keyed writes: the latest row per identifier replaces the one before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ldspark.operators.filters import drop_keys
from ldspark.operators.skew import KEY_BINS


def split_by_id(updates: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows with an identifier, and those without."""
    named = F.col(id_col).isNotNull()
    return updates.filter(named), updates.filter(~named)


def latest_by_id(updates: DataFrame, id_col: str, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per identifier; a row without one is an error.

    :func:`split_by_id` sets such rows apart first. With ``order_by`` the greatest row wins and the other columns break ties.
    Without it two rows for one identifier are an error, since an unordered
    collection has no last row. The aggregate keeps one row per identifier and
    task before the shuffle, so a hot identifier costs nothing.
    """
    unnamed = F.raise_error(F.lit(f"a row without {id_col!r}"))
    rest = [c for c in updates.columns if c != id_col and c not in order_by]
    unordered = [
        c for c in rest if isinstance(updates.schema[c].dataType, (T.MapType, T.VariantType))
    ]
    if unordered:
        raise ValueError(f"write {unordered} as JSON text first: such columns have no order")
    ranked = F.struct(*order_by, *rest)
    checked = F.when(F.col(id_col).isNull(), unnamed).otherwise(F.col(id_col))
    named = updates.withColumn(id_col, checked.cast(updates.schema[id_col].dataType))
    if order_by:
        best = named.groupBy(id_col).agg(F.max(ranked).alias("row"))
    else:
        lone = F.when(F.count(F.lit(1)) == 1, F.max(ranked)).otherwise(
            F.raise_error(F.concat(F.lit("several rows for id "), F.col(id_col).cast("string")))
        )
        best = named.groupBy(id_col).agg(lone.alias("row"))
    return best.select(id_col, "row.*").select(*updates.columns)


def upsert_by_id(
    target: DataFrame, updates: DataFrame | None, id_col: str, order_by: Sequence[str] = ()
) -> DataFrame:
    """The target after the updates; whole rows are replaced, not merged."""
    if updates is None:
        return target
    fresh = latest_by_id(updates, id_col, order_by)
    return drop_keys(target, fresh.select(id_col), id_col).unionByName(fresh)


def _batch_path(path: str, run: str, batch_id: int) -> str:
    return f"{path}/run={run}/batch={batch_id}"


def write_batch(
    updates: DataFrame, path: str, batch_id: int, id_col: str, order_by: Sequence[str], run: str = "0"
) -> None:
    """Add one batch of updates below ``path``.

    Only the batch is written, never the rows already there. Its folder is named
    by the run and the batch, so running a batch again replaces it and changes
    nothing, and a run that numbers its batches from 0 again touches no other.
    """
    latest_by_id(updates, id_col, order_by).write.mode("overwrite").parquet(_batch_path(path, run, batch_id))


def read_latest(df: DataFrame, id_col: str, order_by: Sequence[str]) -> DataFrame:
    """Current rows of batches written by :func:`write_batch`."""
    return latest_by_id(df.drop("run", "batch"), id_col, order_by)


DOCUMENT_ORDER = ("run_started", "batch_seq")


def write_document_batch(documents: DataFrame, path: str, batch_id: int, run: str, run_started: str) -> None:
    """Add one batch of ``entity, part, parts, key, value`` documents below ``path``."""
    numbered = documents.withColumns(
        {"run_started": F.lit(run_started).cast("string"), "batch_seq": F.lit(batch_id).cast("bigint")}
    )
    numbered.write.mode("overwrite").parquet(_batch_path(path, run, batch_id))


def read_latest_documents(df: DataFrame) -> DataFrame:
    """Current documents of batches written by :func:`write_document_batch`.

    An entity's document is replaced as a whole: all its parts are those of the
    last batch it was in, so a document that shrinks leaves no part behind.

    Only entities in several batches have documents to leave out. They are looked
    for in bins of hashes that hold several batches; the documents of all other
    bins are read as they lie. The list of bins is bounded, so it is broadcast.
    """
    bin_of = F.pmod(F.xxhash64("entity"), F.lit(KEY_BINS)).cast("int")
    named = df.filter(F.col("entity").isNotNull()).withColumn("_bin", bin_of)
    batches = named.select("_bin", *DOCUMENT_ORDER, "run").distinct()
    mixed = batches.groupBy("_bin").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_bin")
    if mixed.isEmpty():
        return named.drop("run", "batch", "_bin")
    alone = named.join(F.broadcast(mixed), "_bin", "left_anti")
    some = named.join(F.broadcast(mixed), "_bin", "left_semi")
    last = some.groupBy("entity").agg(F.max(F.struct(*DOCUMENT_ORDER, "run")).alias("last"))
    current = some.join(last, "entity").filter(F.struct(*DOCUMENT_ORDER, "run") == F.col("last"))
    return alone.unionByName(current.drop("last")).drop("run", "batch", "_bin")


def write_stated_batch(stated: DataFrame, path: str, batch_id: int, run: str, run_started: str) -> None:
    """Add one batch of ``period, s, part, stated`` sets of statements below ``path``; a replay overwrites itself."""
    numbered = stated.withColumns({"run_started": F.lit(run_started).cast("string"), "batch_seq": F.lit(batch_id).cast("bigint")})
    numbered.select("period", "s", "part", "stated", *DOCUMENT_ORDER).write.mode("overwrite").parquet(
        _batch_path(path, run, batch_id)
    )


def read_stated(df: DataFrame, since: str | None = None) -> DataFrame:
    """Current statements of batches written by :func:`write_stated_batch`, each once.

    A run's last set of a subject holds all that run's earlier ones; the sets of several runs and periods are united.
    ``since`` leaves out periods that begin before that time.
    """
    if since is not None:
        df = df.filter(F.col("period") >= F.lit(since).cast("timestamp"))
    last = df.groupBy("run", "period", "s", "part").agg(F.max_by("stated", F.struct("batch_seq")).alias("stated"))
    return last.select("s", F.inline("stated")).select("s", "p", "o", "kind").distinct()


def compact(current: DataFrame, path: str) -> None:
    """Write what :func:`read_latest` or :func:`read_latest_documents` gave as a new store of one batch.

    The rows keep their order columns, so later batches may be added to it.
    """
    current.write.parquet(_batch_path(path, "compacted", 0))

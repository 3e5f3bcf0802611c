"""Structured Streaming sources and sinks around the batch operators."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ldspark.operators.framing import document_rows
from ldspark.operators.mapping import apply_models
from ldspark.operators.reducing import COLUMNS, VALUES_PER_ROW, reduce_documents
from ldspark.operators.upsert import write_batch, write_document_batch, write_stated_batch
from ldspark.plans.model import Model
from ldspark.session import materialize, scratch_scope
from ldspark.sources.connectors import TOPIC_FORMAT, topic_read_options
from ldspark.sources.records import Schema

EVERY_BATCH = "5 seconds"
EVERY_FILE = "10 seconds"


def _trigger(available_now: bool, every: str) -> dict[str, Any]:
    return {"availableNow": True} if available_now else {"processingTime": every}


def read_topics(
    spark: SparkSession, brokers: str, topics: Sequence[str], from_oldest: bool = False, **more: str
) -> DataFrame:
    """``key, value`` strings of topic records, with the records' own keys."""
    options = topic_read_options(brokers, topics, from_oldest, **more)
    raw = spark.readStream.format(TOPIC_FORMAT).options(**options).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"))


def read_json_stream(
    spark: SparkSession, folder: str, schema: Schema, files_per_batch: int = 1000
) -> DataFrame:
    """Typed rows of JSON-lines files as they appear in a folder."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)
    )


def read_message_files(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """``key, value``: each file of a folder as one message keyed by its path."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("key"), "value")
    )


def _run_of(spark: SparkSession, checkpoint: str) -> tuple[str, str]:
    """The id of a checkpoint and when it was made; both stay when the query starts again."""
    made = F.col("_metadata.file_modification_time").cast("string")
    (row,) = spark.read.text(f"{checkpoint}/metadata", wholetext=True).select("value", made.alias("made")).take(1)
    return json.loads(row["value"])["id"], row["made"]


def write_stream(
    stream: DataFrame,
    fmt: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    every: str = EVERY_BATCH,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to files, a topic or the console."""
    writer = stream.writeStream.format(fmt).outputMode("append")
    return (
        writer.option("checkpointLocation", checkpoint)
        .options(**(options or {}))
        .trigger(**_trigger(available_now, every))
        .start()
    )


def print_stream(stream: DataFrame, every: str = EVERY_BATCH, available_now: bool = False) -> StreamingQuery:
    """Show each batch on the console."""
    writer = stream.writeStream.format("console").outputMode("append")
    return writer.trigger(**_trigger(available_now, every)).start()


def publish_folder(
    spark: SparkSession,
    folder: str,
    fmt: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    files_per_batch: int = 1,
    every: str = EVERY_FILE,
    available_now: bool = False,
) -> StreamingQuery:
    """Send every file of a folder as one message, a few files per interval."""
    messages = read_message_files(spark, folder, files_per_batch)
    return write_stream(messages, fmt, checkpoint, options, every, available_now)


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    id_col: str,
    order_by: Sequence[str],
    every: str = EVERY_BATCH,
    available_now: bool = False,
) -> StreamingQuery:
    """Keyed writes of a stream, one small folder per batch.

    A batch is reduced to its latest row per identifier and written under the
    checkpoint's id and its number, so a batch that is replayed overwrites itself
    and a stream with a new checkpoint overwrites nothing. Readers take the
    latest over all batches with :func:`ldspark.operators.read_latest`.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        run, _ = _run_of(batch.sparkSession, checkpoint)
        write_batch(batch, path, batch_id, id_col, order_by, run)

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(available_now, every)).start()


def upsert_documents_stream(
    stream: DataFrame,
    models: Sequence[Model],
    path: str,
    checkpoint: str,
    every: str = EVERY_BATCH,
    available_now: bool = False,
    publish: Callable[[DataFrame], None] | None = None,
    values_per_row: int = VALUES_PER_ROW,
) -> StreamingQuery:
    """Map, reduce and store each batch's documents.

    A document of a later batch replaces the one before it as a whole, however
    many parts either has; read them with
    :func:`ldspark.operators.read_latest_documents`. ``publish`` gets the stored
    documents of every batch, for example to index them; a batch that is replayed
    is published again, under the same keys.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run, started = _run_of(session, checkpoint)
        with scratch_scope(session):
            nodes = reduce_documents(apply_models(batch, models), values_per_row=values_per_row)
            documents = document_rows(nodes)
            if publish is not None:
                documents = materialize(documents, "batch-documents")
            write_document_batch(documents, path, batch_id, run, started)
            if publish is not None:
                publish(documents)

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(available_now, every)).start()


def _stated(stream: DataFrame, models: Sequence[Model], event_time: str | None, keep_for: str, parts: int) -> DataFrame:
    """``period, s, part, stated``: the statements about a subject so far, each time one is added."""
    if event_time is None:
        once = apply_models(stream, models).dropDuplicates(COLUMNS).withColumn("period", F.lit(None).cast("timestamp"))
    else:
        timed = stream.withWatermark(event_time, keep_for)
        statements = apply_models(timed, models, keep=[event_time])
        dated = statements.select(F.window(event_time, keep_for).alias("period"), *COLUMNS)
        once = dated.dropDuplicatesWithinWatermark(["period", *COLUMNS])
    own = F.array(F.pmod(F.xxhash64("p", "kind", "o"), F.lit(parts)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    placed = once.withColumn("part", F.explode(F.when(F.col("kind") == "type", every).otherwise(own)))
    sets = placed.groupBy("period", "s", "part").agg(F.collect_set(F.struct("p", "o", "kind")).alias("stated"))
    return sets if event_time is None else sets.withColumn("period", F.col("period.start"))


def merge_documents_stream(
    stream: DataFrame,
    models: Sequence[Model],
    path: str,
    checkpoint: str,
    event_time: str | None = None,
    keep_for: str = "30 days",
    parts: int = 1,
    every: str = EVERY_BATCH,
    available_now: bool = False,
    publish: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Map a stream and merge what its batches state about a subject; a later batch adds and replaces nothing.

    The state store holds every statement once and, per subject, the set of them. A batch writes the sets of subjects
    that it adds a statement to, and no others; read them with :func:`ldspark.operators.read_stated`. A batch that is
    replayed writes the same folder again, and a query that starts again goes on from its state. With ``event_time``
    sets are per period of ``keep_for``, and the state of a period is given up once the stream is that much past it:
    what comes later still for it is left out. ``parts`` deals a subject's statements to several sets, each with its
    types, for subjects of very many; large states belong into the store that Spark's
    ``spark.sql.streaming.stateStore.providerClass`` names for disks. ``publish`` gets the changed documents of every
    batch, as :func:`upsert_documents_stream` does.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run, started = _run_of(session, checkpoint)
        with scratch_scope(session):
            if publish is not None:
                batch = materialize(batch, "batch-stated")
            write_stated_batch(batch, path, batch_id, run, started)
            if publish is not None:
                # one row is one document already: its statements are a set
                statements = batch.select("s", "part", F.inline("stated"))
                publish(document_rows(_nodes_of_sets(statements, parts)))

    writer = _stated(stream, models, event_time, keep_for, parts).writeStream.foreachBatch(save).outputMode("update")
    return writer.option("checkpointLocation", checkpoint).trigger(**_trigger(available_now, every)).start()


def _nodes_of_sets(statements: DataFrame, parts: int) -> DataFrame:
    """Documents of ``s, part, p, o, kind`` rows, one per subject and part."""
    is_type = F.col("kind") == "type"
    values = F.collect_list(F.when(~is_type, F.struct("kind", F.col("o").alias("v"))))
    by_property = statements.groupBy("s", "part", "p").agg(
        F.sort_array(values).alias("vals"), F.sort_array(F.collect_list(F.when(is_type, F.col("o")))).alias("own_types")
    )
    entries = F.sort_array(F.collect_list(F.when(F.size("vals") > 0, F.struct("p", "vals"))))
    return by_property.groupBy(F.col("s").alias("uri"), "part").agg(
        F.lit(parts).alias("parts"),
        F.flatten(F.collect_list("own_types")).alias("types"),
        F.map_from_entries(entries).alias("props"),
    )

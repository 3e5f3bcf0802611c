"""Batch and stream jobs for ``spark-submit``: ``python -m ldspark.jobs <job> ...``.

Models, contexts and frames are files Spark reads; records are ``key<TAB>json``
text, SequenceFiles, JSON lines or delimited text.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ldspark import operators as ops, sinks, sources, streaming
from ldspark.functions import drop_json_fields
from ldspark.operators.store import BUCKETS
from ldspark.operators.versions import versions
from ldspark.plans import Model
from ldspark.session import build_session, scratch_scope
from ldspark.sources import connectors

KINDS = ("text", "sequence", "json", "csv")


def _whole_file(spark: SparkSession, path: str) -> str:
    (row,) = sources.read_files(spark, path).select("text").take(2)
    return row["text"]


def load_model(spark: SparkSession, path: str) -> Model:
    return Model.from_json(_whole_file(spark, path))


def load_context(spark: SparkSession, path: str | None) -> dict[str, str]:
    """Term to identifier of one context file; a plan-time setting."""
    if path is None:
        return {}
    rows = ops.parse_contexts(sources.read_files(spark, path)).collect()
    return {r["term"]: r["iri"] for r in rows}


def _models(spark: SparkSession, args: argparse.Namespace) -> list[Model]:
    context = load_context(spark, args.context)
    models = [load_model(spark, path) for path in args.model]
    options = {k: getattr(args, k) for k in ("base", "root") if getattr(args, k)}
    models = [m.with_options(**options) for m in models]
    return [m.compact(context) if context else m for m in models]


def _records(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return sources.read_records(spark, args.input, args.kind, args.sep)


def _usable(records: DataFrame, args: argparse.Namespace) -> DataFrame:
    """Records to map. Text that is no JSON goes to the rejects' folder, or fails the job without one."""
    if args.kind == "csv":
        return records
    if args.kind == "json":
        records = records.select(F.lit(None).cast("string").alias("key"), "value")
    if args.rejects is None:
        return ops.checked_records(records)
    good, bad = ops.parsed_records(records)
    sinks.write_rejects(bad, args.rejects)
    return good


def run_map(spark: SparkSession, args: argparse.Namespace) -> None:
    """Apply models; write documents, or N-Triples lines."""
    statements = ops.apply_models(_usable(_records(spark, args), args), _models(spark, args))
    if args.output_format == "ntriples":
        sinks.write_lines(ops.ntriples(statements), args.output)
        return
    nodes = ops.to_nodes(ops.distinct_statements(statements))
    sinks.write_kv_text(ops.flat_document_json(nodes, args.id_field), args.output)


def run_context(spark: SparkSession, args: argparse.Namespace) -> None:
    """Shorten names in documents that are stored already; nothing else in them changes."""
    documents, bad = ops.context_documents(
        _records(spark, args), load_context(spark, args.context), args.id_field, args.output_id_field
    )
    _set_apart(bad, args)
    sinks.write_kv_text(documents, args.output)


def _set_apart(bad: DataFrame, args: argparse.Namespace) -> None:
    if args.rejects is not None:
        sinks.write_rejects(bad, args.rejects)
    elif not bad.isEmpty():
        raise ValueError(f"unusable records, for example {bad.first().asDict()}; --rejects sets them apart")


def run_frame(spark: SparkSession, args: argparse.Namespace) -> None:
    """Apply models, reduce, frame; one output folder per frame."""
    statements = ops.distinct_statements(
        ops.apply_models(_usable(_records(spark, args), args), _models(spark, args))
    )
    files = sources.read_files(spark, args.frames, "*.json")
    frames = sources.load_frames(ops.list_frames(files))
    classes = set().union(*[frame.types() for frame in frames.values()])
    nodes = ops.store_by_type(ops.to_nodes(statements), classes)
    publish = None
    if args.index:
        def publish(name: str, documents: DataFrame) -> None:
            sinks.write_json_index(documents, _index(args, "uri", name))
    sinks.write_frames(ops.apply_frames(nodes, frames, args.merge_limit), frames, args.output, publish)


def run_filter(spark: SparkSession, args: argparse.Namespace) -> None:
    """Keep the records with the listed keys."""
    kept = ops.keep_keys(_records(spark, args), args.keys.split(","))
    _write_pairs(kept, args.output, args.output_kind)


def run_convert(spark: SparkSession, args: argparse.Namespace) -> None:
    """Pairs between text and SequenceFile, or JSON lines keyed by a field."""
    records = _records(spark, args)
    if args.kind == "json":
        keyed, rejects = ops.key_by_field(records, f"$.{args.key_field}")
        if not rejects.isEmpty():
            raise ValueError(f"records without {args.key_field!r}")
        records = keyed.select("key", "value")
    _write_pairs(records, args.output, args.output_kind)


def _write_pairs(records: DataFrame, path: str, kind: str) -> None:
    (sinks.write_sequence if kind == "sequence" else sinks.write_kv_text)(records, path)


def run_load(spark: SparkSession, args: argparse.Namespace) -> None:
    """Bulk-load JSON documents by an identifier inside them."""
    keyed, bad = ops.key_by_field(_records(spark, args), f"$.{args.key_field}")
    _set_apart(bad, args)
    value = drop_json_fields(F.col("value"), *args.drop) if args.drop else F.col("value")
    documents = keyed.select("key", value.alias("value"))
    if args.output:
        sinks.write_kv_text(documents, args.output)
    if args.index:
        sinks.write_json_index(documents, _index(args, args.key_field))


def _index(args: argparse.Namespace, id_field: str, name: str | None = None) -> dict[str, str]:
    resource = args.index if name is None else f"{args.index}/{name}"
    more = dict(setting.split("=", 1) for setting in args.index_option or ())
    return connectors.json_index_options(args.nodes, args.port, resource, id_field, **more)


def run_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Map topic records as they arrive; keep the latest document per identifier, or merge all of them."""
    bound = {"maxOffsetsPerTrigger": str(args.max_offsets)}
    records = streaming.read_topics(spark, args.brokers, args.topics.split(","), args.from_oldest, **bound)
    publish = None
    if args.index:
        def publish(documents: DataFrame) -> None:
            sinks.write_json_index(documents.select("key", "value"), _index(args, "uri"))
    write = streaming.merge_documents_stream if args.merge else streaming.upsert_documents_stream
    write(ops.checked_records(records), _models(spark, args), args.output, args.checkpoint, publish=publish).awaitTermination()


def _is_store(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def run_add(spark: SparkSession, args: argparse.Namespace) -> None:
    """Apply models and put the statements into a collection under a load's name, in place of what it had."""
    statements = ops.apply_models(_usable(_records(spark, args), args), _models(spark, args))
    if _is_store(spark, args.output):
        collection = ops.open_collection(spark, args.output)
    else:
        collection = ops.create_collection(spark, args.output, args.buckets)
    put = ops.replace_load if args.load in collection.loads else ops.add_load
    put(collection, args.load, statements)


def run_withdraw(spark: SparkSession, args: argparse.Namespace) -> None:
    """Take a load out of a collection."""
    ops.withdraw_load(ops.open_collection(spark, args.collection), args.load)


def run_refresh(spark: SparkSession, args: argparse.Namespace) -> None:
    """Bring a framed collection up to date with its collection, or make one."""
    collection = ops.open_collection(spark, args.collection)
    if _is_store(spark, args.output):
        ops.refresh_framed(ops.open_framed(spark, args.output), collection)
        return
    frames = sources.load_frames(ops.list_frames(sources.read_files(spark, args.frames, "*.json")))
    ops.create_framed(collection, args.output, frames, args.merge_limit, args.buckets)


def run_compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Write the current documents of a stream's store as a new store of one batch."""
    ops.compact(ops.read_latest_documents(spark.read.parquet(args.input)), args.output)


def run_publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """Send each file of a folder to a topic as one message."""
    options = connectors.topic_write_options(args.brokers, args.topic)
    streaming.publish_folder(
        spark, args.input, connectors.TOPIC_FORMAT, args.checkpoint, options
    ).awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ldspark.jobs", description=__doc__)
    jobs = top.add_subparsers(required=True)

    def job(name: str, run, output: bool = True, records: bool = True) -> argparse.ArgumentParser:
        p = jobs.add_parser(name, help=run.__doc__)
        p.set_defaults(run=run)
        if records:
            p.add_argument("input")
            p.add_argument("--kind", choices=KINDS, default="text")
            p.add_argument("--sep", default=",")
        if output:
            p.add_argument("output")
        return p

    def modelled(p: argparse.ArgumentParser) -> argparse.ArgumentParser:
        p.add_argument("--model", action="append", required=True)
        p.add_argument("--context")
        p.add_argument("--base")
        p.add_argument("--root")
        return p

    def rejecting(p: argparse.ArgumentParser) -> argparse.ArgumentParser:
        p.add_argument("--rejects", help="folder for records that cannot be used; without it they fail the job")
        return p

    def indexed(p: argparse.ArgumentParser, required: bool) -> None:
        p.add_argument("--index", required=required)
        p.add_argument("--nodes", default="localhost")
        p.add_argument("--port", type=int, default=9200)
        p.add_argument("--index-option", action="append", help="any other setting of the connector, as name=value")

    p = rejecting(modelled(job("map", run_map)))
    p.add_argument("--output-format", choices=("json", "ntriples"), default="json")
    p.add_argument("--id-field", default="@id")
    p = rejecting(job("context", run_context))
    p.add_argument("--context", required=True)
    p.add_argument("--id-field", default="@id")
    p.add_argument("--output-id-field", default="uri")
    p = rejecting(modelled(job("frame", run_frame)))
    p.add_argument("--frames", required=True)
    p.add_argument("--merge-limit", type=int)
    indexed(p, required=False)
    p = job("filter", run_filter)
    p.add_argument("keys")
    p.add_argument("--output-kind", choices=("text", "sequence"), default="text")
    p = job("convert", run_convert)
    p.add_argument("--output-kind", choices=("text", "sequence"), default="text")
    p.add_argument("--key-field", default="url")
    p = rejecting(job("load", run_load, output=False))
    p.add_argument("--output")
    p.add_argument("--key-field", required=True)
    p.add_argument("--drop", action="append")
    indexed(p, required=False)
    p = modelled(job("stream", run_stream, records=False))
    p.add_argument("--brokers", required=True)
    p.add_argument("--topics", required=True)
    p.add_argument("--from-oldest", action="store_true")
    p.add_argument("--max-offsets", type=int, default=1_000_000, help="most records in one batch")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--merge", action="store_true", help="add to documents instead of replacing them")
    indexed(p, required=False)
    p = rejecting(modelled(job("add", run_add)))
    p.add_argument("--load", required=True)
    p.add_argument("--buckets", type=int, default=BUCKETS)
    p = job("withdraw", run_withdraw, output=False, records=False)
    p.add_argument("collection")
    p.add_argument("--load", required=True)
    p = job("refresh", run_refresh, output=False, records=False)
    p.add_argument("collection")
    p.add_argument("output")
    p.add_argument("--frames", help="folder of frames, for a framed collection that is not there yet")
    p.add_argument("--merge-limit", type=int)
    p.add_argument("--buckets", type=int, default=BUCKETS)
    job("compact", run_compact, records=False).add_argument("--input", required=True)
    p = job("publish", run_publish, output=False)
    p.add_argument("--brokers", required=True)
    p.add_argument("--topic", required=True)
    p.add_argument("--checkpoint", required=True)
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or build_session("ldspark")
    with scratch_scope(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()

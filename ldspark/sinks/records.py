"""Writers of keyed and bare records."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ldspark.operators.framing import framed_document_json
from ldspark.plans.frame import Frame
from ldspark.sources.records import read_kv_text


def pair_line(key: Column, value: Column) -> Column:
    """``key<TAB>value``; a pair the form cannot hold fails instead of changing shape."""
    missing = key.isNull() | value.isNull()
    broken = missing | key.contains("\t") | key.contains("\n") | value.contains("\n")
    message = F.concat(F.lit("not a one-line pair, key: "), F.coalesce(key, F.lit("null")))
    return F.when(broken, F.raise_error(message)).otherwise(F.concat_ws("\t", key, value))


def write_kv_text(records: DataFrame, path: str, mode: str = "errorifexists", **options: str) -> None:
    """Lines of ``key<TAB>json``."""
    line = pair_line(F.col("key"), F.col("value")).alias("value")
    records.select(line).write.mode(mode).options(**options).text(path)


def write_sequence(records: DataFrame, path: str) -> None:
    """SequenceFile of text pairs; the format has no DataFrame writer."""
    records.select("key", "value").rdd.map(tuple).saveAsSequenceFile(path)


def write_lines(df: DataFrame, path: str, column: str = "line", mode: str = "errorifexists") -> None:
    """One column as plain lines, for example N-Triples."""
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).option("escape", '"').csv(path)


def write_json_index(records: DataFrame, options: Mapping[str, str]) -> None:
    """Send JSON text in ``value`` to a search index through its Hadoop output format.

    The connector takes ready JSON only this way; ``es.mapping.id`` names the
    field with the identifier, so a task that runs again rewrites its documents.
    """
    conf = {
        **options,
        "es.input.json": "true",
        "mapreduce.job.outputformat.class": "org.elasticsearch.hadoop.mr.EsOutputFormat",
        "mapreduce.job.output.key.class": "org.apache.hadoop.io.NullWritable",
        "mapreduce.job.output.value.class": "org.apache.hadoop.io.Text",
    }
    texts = records.select(F.lit(None).cast("string").alias("key"), "value")
    texts.rdd.map(tuple).saveAsNewAPIHadoopDataset(conf)


def write_rejects(rejects: DataFrame, path: str) -> None:
    """Records a job could not use, as JSON lines with all their columns."""
    rejects.write.json(path)


def write_frames(
    framed: Mapping[str, DataFrame],
    frames: Mapping[str, Frame],
    path: str,
    publish: Callable[[str, DataFrame], None] | None = None,
) -> list[str]:
    """One folder of ``uri<TAB>json`` per frame.

    ``publish`` gets the name and the stored ``key, value`` documents of every
    frame that has any, for example to index them. Returns those names.
    """
    written = []
    for name, frame in frames.items():
        out = f"{path}/{name}"
        documents = framed_document_json(framed[name], frame)
        write_kv_text(documents, out)
        stored = read_kv_text(documents.sparkSession, out)
        if stored.isEmpty():
            continue
        written.append(name)
        if publish is not None:
            publish(name, stored)
    return written

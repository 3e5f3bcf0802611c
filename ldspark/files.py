"""Small files and folders of whatever file system a path names, through the session's Hadoop configuration."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _resolved(spark: SparkSession, path: str):
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, file = _resolved(spark, path)
    return system.exists(file)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder, sorted; none where there is no folder."""
    system, path = _resolved(spark, folder)
    if not system.exists(path):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(path))


def read_text(spark: SparkSession, path: str) -> str:
    system, file = _resolved(spark, path)
    stream = system.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that is there as a whole or not at all; False, and nothing done, where the path is taken.

    The text goes to a name nobody knows, and that file is renamed without replacing another: a single step for
    a file system with atomic renames.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    system, target = _resolved(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(text.encode())
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
    never_replace = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(target), never_replace)
    except Exception as error:  # py4j wraps whatever Java raised
        system.delete(draft, False)
        if system.exists(target):
            return False
        raise error
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all that is in it."""
    system, entry = _resolved(spark, path)
    system.delete(entry, True)

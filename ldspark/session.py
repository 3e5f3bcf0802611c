"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_scopes = threading.local()


def build_session(app_name: str = "ldspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Partition counts are left to adaptive execution: start from
    ``spark.sql.shuffle.partitions`` sized for the cluster (a few times the core
    count) and let it coalesce or split from there.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it then gets a temporary
    folder, because every task runs on this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="ldspark-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that nothing else uses."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in getattr(_scopes, "open", [])[-1:]:
        paths.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what was written to scratch paths inside the block when it ends.

    For jobs and stream batches, whose results are stored elsewhere by then.
    """
    stack = _scopes.__dict__.setdefault("open", [])
    stack.append([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in stack.pop():
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet in the scratch folder and read it back.

    For results several later plans read. Unlike cached blocks the files outlive
    a lost executor, and the readers get column pruning and filter pushdown.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, column: str, label: str) -> DataFrame:
    """Like :func:`materialize`, in one folder per value of ``column``.

    For a handful of values: every task writes a file for each it has, without a
    shuffle, so the memory of a task is that of the rows it already has.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Cache ``df`` for the plans inside a ``with`` block, then release it.

    For inputs that are cheap to compute again; :func:`materialize` for the rest.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()

"""Options for stores that need a connector jar on the cluster.

Only option dictionaries live here; reading and writing is Spark's. The names are
the connectors' public settings.
"""

from __future__ import annotations

from collections.abc import Sequence

INDEX_FORMAT = "org.elasticsearch.spark.sql"
CELLS_FORMAT = "org.apache.hadoop.hbase.spark"
TOPIC_FORMAT = "kafka"


def index_options(nodes: str, port: int, resource: str, id_field: str | None = None, **more: str) -> dict[str, str]:
    """Where a search index is, and the field with a document's identifier when documents are written.

    ``more`` passes any other setting of the connector; what is not given is the
    connector's own default.
    """
    place = {"es.nodes": nodes, "es.port": str(port), "es.resource": resource}
    named = {} if id_field is None else {"es.mapping.id": id_field}
    return {**place, **named, **more}


def json_index_options(nodes: str, port: int, resource: str, id_field: str, **more: str) -> dict[str, str]:
    """As :func:`index_options` for documents that are JSON text already."""
    return index_options(nodes, port, resource, id_field, **{"es.input.json": "true", **more})


def cell_options(table: str, family: str, qualifiers: Sequence[str], **more: str) -> dict[str, str]:
    """A table of cells with the columns to read; the row key comes first, as ``row_key``."""
    columns = ", ".join(f"{q} STRING {family}:{q}" for q in qualifiers)
    return {"hbase.table": table, "hbase.columns.mapping": f"row_key STRING :key, {columns}", **more}


def topic_read_options(brokers: str, topics: Sequence[str], from_oldest: bool = False, **more: str) -> dict[str, str]:
    """Subscribe to topics from the oldest record or from now on."""
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest" if from_oldest else "latest",
        **more,
    }


def topic_write_options(brokers: str, topic: str, **more: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "topic": topic, **more}

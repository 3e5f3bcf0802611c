"""Operators: functions from DataFrames to lazy DataFrames."""

from ldspark.operators.catalog import (
    frame_types,
    list_frames,
    pair_models,
    types_with_uris,
    unknown_types,
)
from ldspark.operators.cell_versions import latest_versions, read_clustered, write_clustered
from ldspark.operators.cells import (
    cell_documents,
    cell_lines,
    cells_to_columns,
    cells_to_docs,
    docs_to_cells,
    scan_cells,
)
from ldspark.operators.context import apply_context, context_documents, parse_contexts
from ldspark.operators.documents import document_statements, node_statements
from ldspark.operators.filters import (
    checked_records,
    constant_key,
    drop_keys,
    keep_keys,
    key_by_field,
    parsed_records,
)
from ldspark.operators.framing import (
    apply_frames,
    document_rows,
    flat_document_json,
    frame_documents,
    framed_document_json,
    partition_on_types,
    store_by_type,
    store_colocated,
    type_members,
)
from ldspark.operators.full_context import compact_statements, expand_documents
from ldspark.operators.increments import (
    add_load,
    add_loads,
    create_collection,
    create_framed,
    expire_collection,
    open_collection,
    open_framed,
    refresh_framed,
    replace_load,
    withdraw_load,
)
from ldspark.operators.joining import apply_joined_model
from ldspark.operators.mapping import apply_model, apply_models, model_documents, ntriples
from ldspark.operators.recursive import expand_frames, recursive_document_json
from ldspark.operators.reducing import (
    distinct_statements,
    node_values,
    reduce_documents,
    reduce_statements,
    to_nodes,
    union_all,
)
from ldspark.operators.skew import salted_join, split_groups
from ldspark.operators.store import (
    create_store,
    delete_from_store,
    expire_store,
    open_store,
    upsert_store,
)
from ldspark.operators.upsert import (
    compact,
    latest_by_id,
    read_latest,
    read_latest_documents,
    read_stated,
    split_by_id,
    upsert_by_id,
    write_batch,
    write_document_batch,
    write_stated_batch,
)
from ldspark.operators.versions import Conflict, open_alias, restore_alias, set_alias
from ldspark.operators.views import swap_alias

__all__ = [
    "Conflict",
    "add_load",
    "add_loads",
    "apply_context",
    "apply_frames",
    "apply_joined_model",
    "apply_model",
    "apply_models",
    "cell_documents",
    "cell_lines",
    "cells_to_columns",
    "cells_to_docs",
    "checked_records",
    "compact",
    "compact_statements",
    "constant_key",
    "context_documents",
    "create_collection",
    "create_framed",
    "create_store",
    "delete_from_store",
    "distinct_statements",
    "docs_to_cells",
    "document_rows",
    "document_statements",
    "drop_keys",
    "expand_documents",
    "expand_frames",
    "expire_collection",
    "expire_store",
    "flat_document_json",
    "frame_documents",
    "frame_types",
    "framed_document_json",
    "keep_keys",
    "key_by_field",
    "latest_by_id",
    "latest_versions",
    "list_frames",
    "model_documents",
    "node_statements",
    "node_values",
    "ntriples",
    "open_alias",
    "open_collection",
    "open_framed",
    "open_store",
    "pair_models",
    "parse_contexts",
    "parsed_records",
    "partition_on_types",
    "read_clustered",
    "read_latest",
    "read_latest_documents",
    "read_stated",
    "recursive_document_json",
    "reduce_documents",
    "reduce_statements",
    "refresh_framed",
    "replace_load",
    "restore_alias",
    "salted_join",
    "scan_cells",
    "set_alias",
    "split_by_id",
    "split_groups",
    "store_by_type",
    "store_colocated",
    "swap_alias",
    "to_nodes",
    "type_members",
    "types_with_uris",
    "union_all",
    "unknown_types",
    "upsert_by_id",
    "upsert_store",
    "withdraw_load",
    "write_batch",
    "write_clustered",
    "write_document_batch",
    "write_stated_batch",
]

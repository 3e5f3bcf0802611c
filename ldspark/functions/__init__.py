"""Column expressions; everything here is built from Spark's own functions."""

from ldspark.functions.documents import (
    document_fields,
    drop_json_fields,
    json_strings,
    json_value,
)
from ldspark.functions.terms import encode_part, lexical, ntriples_line, resolve_iri

__all__ = [
    "document_fields",
    "drop_json_fields",
    "encode_part",
    "json_strings",
    "json_value",
    "lexical",
    "ntriples_line",
    "resolve_iri",
]

"""Linked entity documents from tables and JSON records, on Spark."""

from ldspark.plans import Const, Field, Frame, Iri, JsonPath, Model, Node, Template
from ldspark.session import build_session, materialize, persisted, scratch_path

__version__ = "0.1.0"

__all__ = [
    "Const",
    "Field",
    "Frame",
    "Iri",
    "JsonPath",
    "Model",
    "Node",
    "Template",
    "build_session",
    "materialize",
    "persisted",
    "scratch_path",
]

"""Plan-time specifications: plain values that shape a DataFrame, no data."""

from ldspark.plans.context import FullContext, Term
from ldspark.plans.frame import Frame, FrameRule, FrameRules, Match
from ldspark.plans.model import RDF_TYPE, Const, Field, Iri, JoinedModel, JoinLink, JsonPath, Model, Node, Template

__all__ = ["Const", "Field", "Frame", "FrameRule", "FrameRules", "FullContext", "Iri", "JoinLink", "JoinedModel", "JsonPath", "Match", "Model", "Node", "RDF_TYPE", "Template", "Term"]

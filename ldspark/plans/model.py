"""Declarative mapping models: how one input row becomes entity statements."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any, Union

RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"

# the name of the current element in a node made for each element of a list
ELEMENT = "_"

_PLACEHOLDER = re.compile(r"\{([^{}]+)\}")


@dataclass(frozen=True)
class Field:
    """A column or a nested path such as ``address.city``."""

    path: str


@dataclass(frozen=True)
class JsonPath:
    """A path into a column of JSON text or of type variant."""

    column: str
    path: str


@dataclass(frozen=True)
class Const:
    value: str


@dataclass(frozen=True)
class Template:
    """Text with ``{column}`` or ``{column:$.path}`` places, values percent-encoded."""

    text: str

    def pieces(self) -> list[Union[str, Field, JsonPath]]:
        """Literal text and value sources, in order."""
        out: list[Union[str, Field, JsonPath]] = []
        end = 0
        for match in _PLACEHOLDER.finditer(self.text):
            if match.start() > end:
                out.append(self.text[end : match.start()])
            column, colon, path = match.group(1).partition(":")
            out.append(JsonPath(column, path) if colon else Field(column))
            end = match.end()
        if end < len(self.text):
            out.append(self.text[end:])
        return out


@dataclass(frozen=True)
class Iri:
    """Marks a property value as an identifier and not as text."""

    source: Union[Field, JsonPath, Const, Template]


Source = Union[Field, JsonPath, Const, Template, Iri]


def as_source(spec: Any) -> Source:
    """A bare string names a column; a mapping is the JSON form of a source."""
    if isinstance(spec, str):
        return Field(spec)
    if isinstance(spec, Mapping):
        (kind, arg), = spec.items()
        if kind == "field":
            return Field(arg)
        if kind == "const":
            return Const(arg)
        if kind == "template":
            return Template(arg)
        if kind == "json":
            column, _, path = arg.partition(":")
            return JsonPath(column, path)
        if kind == "iri":
            return Iri(as_source(arg))  # type: ignore[arg-type]
        raise ValueError(f"unknown value source {kind!r}")
    return spec


@dataclass(frozen=True)
class Node:
    """One entity minted per input row.

    With ``each``, a list-valued field or JSON path, one per element of that
    list: ``_`` is the element, ``_.name`` a field of it, ``{_:$.name}`` a JSON
    path into it.
    """

    id: str
    cls: Union[str, Sequence[str]]
    subject: Any
    props: Mapping[str, Any] = field(default_factory=dict)
    links: Mapping[str, Union[str, Sequence[str]]] = field(default_factory=dict)
    each: Any = None

    @property
    def each_source(self) -> Source:
        return as_source(self.each)

    @property
    def classes(self) -> tuple[str, ...]:
        return (self.cls,) if isinstance(self.cls, str) else tuple(self.cls)

    @property
    def subject_source(self) -> Source:
        return Template(self.subject) if isinstance(self.subject, str) else as_source(self.subject)

    def property_sources(self) -> list[tuple[str, Source]]:
        out = []
        for predicate, spec in self.props.items():
            specs = spec if isinstance(spec, (list, tuple)) else [spec]
            out.extend((predicate, as_source(one)) for one in specs)
        return out

    def link_targets(self) -> list[tuple[str, str]]:
        out = []
        for predicate, target in self.links.items():
            targets = [target] if isinstance(target, str) else list(target)
            out.extend((predicate, one) for one in targets)
        return out


@dataclass(frozen=True)
class Model:
    """Nodes, the base IRI for relative subjects, and the node generation starts at."""

    base: str
    root: str
    nodes: Sequence[Node]

    def __post_init__(self) -> None:
        ids = [n.id for n in self.nodes]
        if len(set(ids)) != len(ids):
            raise ValueError("two nodes share one id")
        known = set(ids)
        for node in self.nodes:
            missing = [t for _, t in node.link_targets() if t not in known]
            if missing:
                raise ValueError(f"node {node.id!r} links to unknown {missing}")
        lists = {n.id: n.each_source for n in self.nodes if n.each is not None}
        for node in self.nodes:
            for _, target in node.link_targets():
                if node.id in lists and lists.get(target, lists[node.id]) != lists[node.id]:
                    raise ValueError(f"{node.id!r} and {target!r} belong to different lists")
        if self.root not in known:
            raise ValueError(f"root {self.root!r} is not a node")

    def with_options(self, **options: Any) -> "Model":
        """A copy with ``base`` or ``root`` replaced."""
        return replace(self, **options)

    def compact(self, context: Mapping[str, str]) -> "Model":
        """The model under a term-to-identifier context.

        Properties and classes are constants of the model, so shortening them
        here costs nothing per row and makes every later shuffle smaller.
        """
        term: dict[str, str] = {}
        for name, iri in sorted(context.items()):
            term.setdefault(iri, name)

        def short(node: Node) -> Node:
            return replace(
                node,
                cls=[term.get(c, c) for c in node.classes],
                props={term.get(p, p): v for p, v in node.props.items()},
                links={term.get(p, p): v for p, v in node.links.items()},
            )

        return replace(self, nodes=[short(n) for n in self.nodes])

    def reachable(self) -> list[Node]:
        """The nodes reached from the root; the others generate nothing."""
        by_id = {n.id: n for n in self.nodes}
        seen = {self.root}
        todo = [self.root]
        while todo:
            for _, target in by_id[todo.pop()].link_targets():
                if target not in seen:
                    seen.add(target)
                    todo.append(target)
        return [n for n in self.nodes if n.id in seen]

    @classmethod
    def from_json(cls, text: str) -> "Model":
        """Read the JSON form: the constructor's arguments as an object."""
        return cls.from_dict(json.loads(text))

    @classmethod
    def from_dict(cls, spec: Mapping[str, Any]) -> "Model":
        nodes = [
            Node(
                id=n["id"],
                cls=n["cls"],
                subject=n["subject"],
                props=n.get("props", {}),
                links=n.get("links", {}),
                each=n.get("each"),
            )
            for n in spec["nodes"]
        ]
        return cls(base=spec["base"], root=spec["root"], nodes=nodes)


@dataclass(frozen=True)
class JoinLink:
    """A link from a node of one input to a node of another, for rows whose columns ``on`` are equal pair by pair.

    ``source`` and ``target`` are ``(input, node)``.
    """

    predicate: str
    source: tuple[str, str]
    target: tuple[str, str]
    on: Sequence[tuple[str, str]]


@dataclass(frozen=True)
class JoinedModel:
    """A model per input, and links between their nodes."""

    inputs: Mapping[str, Model]
    links: Sequence[JoinLink]

    def __post_init__(self) -> None:
        for link in self.links:
            if not link.on:
                raise ValueError(f"link {link.predicate!r} has no columns to join on")
            for name, node in (link.source, link.target):
                if name not in self.inputs:
                    raise ValueError(f"link {link.predicate!r} names the unknown input {name!r}")
                found = [n for n in self.inputs[name].nodes if n.id == node]
                if not found:
                    raise ValueError(f"link {link.predicate!r} names the unknown node {node!r} of {name!r}")
                if found[0].each is not None:
                    raise ValueError(f"node {node!r} of {name!r} is made for each element of a list and takes no join")

    @classmethod
    def from_json(cls, text: str) -> "JoinedModel":
        """``{"inputs": {name: model}, "links": [{"predicate", "source", "target", "on"}]}``."""
        spec = json.loads(text)
        links = [
            JoinLink(x["predicate"], tuple(x["source"]), tuple(x["target"]), tuple(tuple(pair) for pair in x["on"]))
            for x in spec["links"]
        ]
        return cls({name: Model.from_dict(one) for name, one in spec["inputs"].items()}, links)

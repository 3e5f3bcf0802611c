"""Contexts with prefixes, coercions, containers and terms by class, compiled once for the rows they are applied to."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

ABSOLUTE = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:")
CONTAINERS = ("list", "language", "set")


@dataclass(frozen=True)
class Term:
    """What a name stands for: ``kind`` iri or vocab makes its text values references, ``language`` tags them."""

    iri: str
    kind: str | None = None
    container: str | None = None
    language: str | None = None


@dataclass(frozen=True)
class FullContext:
    """Terms by name, and those that hold only within documents of a class, by the class."""

    terms: Mapping[str, Term] = field(default_factory=dict)
    prefixes: Mapping[str, str] = field(default_factory=dict)
    vocab: str | None = None
    base: str = ""
    language: str | None = None
    scoped: Mapping[str, Mapping[str, Term]] = field(default_factory=dict)

    def expand_name(self, name: str) -> str:
        """The identifier of a term, a compact name, or a name of the vocabulary; other names are left as they are."""
        if name in self.terms:
            return self.terms[name].iri
        prefix, colon, rest = name.partition(":")
        if colon and prefix in self.prefixes and not rest.startswith("//"):
            return self.prefixes[prefix] + rest
        if colon and ABSOLUTE.match(name):
            return name
        return (self.vocab or "") + name

    @classmethod
    def from_json(cls, text: str) -> "FullContext":
        """A context document. Text terms that end in one of ``: / ? # [ ] @`` are prefixes, or where ``@prefix`` says so.

        A list of contexts is one after the other, the later winning. Definitions may use each other in any order; one
        that leads back to itself is an error, and so is a container or keyword that is not known here.
        """
        spec = json.loads(text).get("@context", {})
        merged: dict[str, Any] = {}
        for part in spec if isinstance(spec, list) else [spec]:
            merged |= part
        return cls._compiled(merged)

    @classmethod
    def _compiled(cls, spec: Mapping[str, Any]) -> "FullContext":
        unknown = sorted(k for k in spec if k.startswith("@") and k not in ("@vocab", "@base", "@language", "@version"))
        if unknown:
            raise ValueError(f"keywords {unknown} of a context are not known")
        names = {k: v for k, v in spec.items() if not k.startswith("@") and v is not None}
        vocab = spec.get("@vocab")
        known: dict[str, str] = {}

        def definition(name: str) -> Mapping[str, Any]:
            return {"@id": names[name]} if isinstance(names[name], str) else names[name]

        def resolve(name: str, via: tuple[str, ...]) -> str:
            if name in via:
                raise ValueError(f"terms define each other: {sorted(via)}")
            if name in known:
                return known[name]
            if name in names:
                target = definition(name).get("@id", name)
                known[name] = expand(target, (*via, name), own=target == name)
                return known[name]
            return expand(name, via)

        def expand(name: str, via: tuple[str, ...], own: bool = False) -> str:
            if name in names and not own:
                return resolve(name, via)
            prefix, colon, rest = name.partition(":")
            if colon and prefix in names and not rest.startswith("//"):
                return resolve(prefix, via) + rest
            return name if colon else (vocab or "") + name

        terms, prefixes, scopes = {}, {}, {}
        for name in names:
            one = definition(name)
            wrong = sorted(k for k in one if k not in ("@id", "@type", "@container", "@language", "@prefix", "@context"))
            container = (one.get("@container") or "").removeprefix("@") or None
            if wrong or container not in (None, *CONTAINERS):
                raise ValueError(f"term {name!r}: {wrong or container} is not known")
            iri = resolve(name, ())
            kind = {"@id": "iri", "@vocab": "vocab"}.get(one.get("@type"))
            terms[name] = Term(iri, kind, container, one.get("@language"))
            if one.get("@prefix", isinstance(names[name], str) and iri[-1:] in tuple(":/?#[]@")):
                prefixes[name] = iri
            if "@context" in one:
                scopes[iri] = one["@context"]
        scoped = {}
        outer = {k: {i: x for i, x in v.items() if i != "@context"} if isinstance(v, Mapping) else v for k, v in spec.items()}
        for cls_iri, inner in scopes.items():
            both = cls._compiled({**outer, **inner})
            scoped[cls_iri] = {name: both.terms[name] for name in inner if name in both.terms}
        return cls(terms, prefixes, vocab, spec.get("@base", ""), spec.get("@language"), scoped)

"""Frames: the tree of types and properties a nested document follows."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Match:
    """A condition on one property: one of some values, any value at all (``values`` unset), or none (``absent``)."""

    prop: str
    values: tuple[str, ...] | None = None
    absent: bool = False


@dataclass(frozen=True)
class Frame:
    """Root type and, per framed property, the frame of the documents below it.

    ``where`` keeps only documents that meet all of its conditions, or any with ``require_all`` unset. ``defaults``
    are values of properties a document does not have.

    With ``keep`` only those of a document's own properties are written, besides
    the framed ones; without it all are. It bounds what an embedded document
    brings along, for example a customer's name in each of its orders and not the
    list of all its orders.
    """

    type: str
    edges: Mapping[str, "Frame"] = field(default_factory=dict)
    keep: tuple[str, ...] | None = None
    where: tuple[Match, ...] = ()
    require_all: bool = True
    defaults: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, spec: Mapping[str, Any]) -> "Frame":
        """A frame from its JSON form.

        ``"@where"`` has a list of values, ``{}`` for any or ``[]`` for none per property, and ``"@requireAll": false``
        asks for one of them; ``{"@default": value}`` under a property is its default.

        ``"@explicit": true`` keeps only the properties that are named; a named
        property without a frame below it has ``{}``. A list as a sub-frame, or a
        sub-frame without a type, is an error.
        """
        if not isinstance(spec.get("@type"), str):
            raise ValueError("a frame needs one @type")
        named = {k: v for k, v in spec.items() if not k.startswith("@")}
        lists = sorted(k for k, v in named.items() if isinstance(v, (list, tuple)))
        if lists:
            raise ValueError(f"a frame's properties take one frame each, not a list: {lists}")
        defaults = {k: v["@default"] for k, v in named.items() if isinstance(v, Mapping) and set(v) == {"@default"}}
        edges = {k: cls.from_dict(v) for k, v in named.items() if isinstance(v, Mapping) and v and k not in defaults}
        keep = tuple(k for k in named if k not in edges) if spec.get("@explicit") else None
        where = []
        for prop, pattern in spec.get("@where", {}).items():
            if not isinstance(pattern, list) and pattern != {}:
                raise ValueError(f"a condition is a list of values or {{}}: {prop!r}")
            where.append(Match(prop) if pattern == {} else Match(prop, tuple(pattern) or None, not pattern))
        return cls(spec["@type"], edges, keep, tuple(where), spec.get("@requireAll", True), defaults)

    @classmethod
    def from_json(cls, text: str) -> "Frame":
        return cls.from_dict(json.loads(text))

    def to_dict(self) -> dict[str, Any]:
        """The JSON form :meth:`from_dict` reads."""
        spec: dict[str, Any] = {"@type": self.type}
        if self.keep is not None:
            spec |= {"@explicit": True, **{p: {} for p in self.keep}}
        if self.where:
            spec["@where"] = {m.prop: [] if m.absent else {} if m.values is None else list(m.values) for m in self.where}
        if not self.require_all:
            spec["@requireAll"] = False
        spec |= {p: {"@default": value} for p, value in self.defaults.items()}
        return spec | {p: sub.to_dict() for p, sub in self.edges.items()}

    def types(self) -> set[str]:
        out = {self.type}
        for sub in self.edges.values():
            out |= sub.types()
        return out


@dataclass(frozen=True)
class FrameRule:
    """A type and, per framed property, the name of the rule its documents follow."""

    type: str
    edges: Mapping[str, str] = field(default_factory=dict)
    keep: tuple[str, ...] | None = None


@dataclass(frozen=True)
class FrameRules:
    """Frames that name each other, or themselves, so that the data and not the plan ends the nesting."""

    root: str
    rules: Mapping[str, FrameRule]

    def __post_init__(self) -> None:
        named = {self.root, *[target for rule in self.rules.values() for target in rule.edges.values()]}
        unknown = sorted(named - set(self.rules))
        if unknown:
            raise ValueError(f"no frame is named {unknown}")

    def props(self) -> list[str]:
        return sorted({prop for rule in self.rules.values() for prop in rule.edges})

    @classmethod
    def from_json(cls, text: str) -> "FrameRules":
        """``{"root": name, "frames": {name: frame}}``, where a property is framed by the name of a frame.

        ``{}`` names a property that ``"@explicit": true`` keeps.
        """
        spec = json.loads(text)
        rules = {}
        for name, frame in spec["frames"].items():
            if not isinstance(frame.get("@type"), str):
                raise ValueError(f"frame {name!r} needs one @type")
            named = {k: v for k, v in frame.items() if not k.startswith("@")}
            wrong = sorted(k for k, v in named.items() if not isinstance(v, str) and v != {})
            if wrong:
                raise ValueError(f"frame {name!r}: properties take the name of a frame: {wrong}")
            edges = {k: v for k, v in named.items() if v != {}}
            keep = tuple(k for k in named if k not in edges) if frame.get("@explicit") else None
            rules[name] = FrameRule(frame["@type"], edges, keep)
        return cls(spec["root"], rules)

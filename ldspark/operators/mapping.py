"""Rows to statements: apply one or several models in a single pass."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ldspark.functions.documents import json_elements, json_strings, json_value, let
from ldspark.functions.terms import (
    ABSOLUTE_IRI,
    encode_part,
    lexical,
    needs_encoding,
    ntriples_line,
    resolve_iri,
)
from ldspark.operators.reducing import to_nodes
from ldspark.plans.model import (
    ELEMENT,
    RDF_TYPE,
    Const,
    Field,
    Iri,
    JsonPath,
    Model,
    Node,
    Source,
    Template,
)


# an element of a list, inside the expression that maps the list
Element = tuple[Column, T.DataType]


class _Inputs:
    """Names the columns a model needs, so each is computed once per row.

    Subjects and values go into a projection below the generator; the generator
    then only refers to attributes and stays inside generated code. Values of a
    list element are expressions of that element and have no column.
    """

    def __init__(self, df: DataFrame) -> None:
        self.df = df
        self.types = {f.name: f.dataType for f in df.schema}
        self.parsed: dict[str, Column] = {}
        self.columns: dict[str, Column] = {}
        self._names: dict[object, str] = {}

    def _type_of(self, path: str) -> T.DataType:
        return self.types[path] if path in self.types else self.df.select(path).schema[0].dataType

    def _variant(self, column: str, element: Element | None) -> Column:
        if column == ELEMENT and element is not None:
            value, dtype = element
            return value if isinstance(dtype, T.VariantType) else F.try_parse_json(value)
        name = f"_json_{column}"
        if isinstance(self._type_of(column), T.VariantType):
            self.parsed[name] = F.col(column)
        else:
            self.parsed[name] = F.try_parse_json(F.col(column))
        return F.col(name) if element is None else self._named(("json", column), F.col(name))

    def _field(self, path: str, element: Element | None) -> Element:
        first, *rest = path.split(".")
        if first != ELEMENT or element is None:
            column = F.col(path)
            if element is not None:
                column = self._named(("field", path), column)
            return column, self._type_of(path)
        column, dtype = element
        for name in rest:
            inner, many = dtype, isinstance(dtype, T.ArrayType)
            if many:
                inner = inner.elementType
            inner = inner[name].dataType
            column, dtype = column[name], T.ArrayType(inner) if many else inner
        return column, dtype

    def _flat(self, path: str, element: Element | None) -> tuple[Column, T.DataType, bool]:
        """The value, the type of one of it, and whether there are several."""
        column, dtype = self._field(path, element)
        many = False
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
            if many:
                column = F.flatten(column)
            many = True
        return column, dtype, many

    def _template(self, template: Template, element: Element | None) -> Column:
        parts = []
        for piece in template.pieces():
            if isinstance(piece, str):
                parts.append(F.lit(piece))
            elif isinstance(piece, JsonPath):
                text = json_value(self._variant(piece.column, element), piece.path)
                parts.append(encode_part(text))
            else:
                column, dtype, many = self._flat(piece.path, element)
                if many:
                    raise ValueError(f"{piece.path!r} holds a list and cannot fill a template")
                text = lexical(dtype)(column)
                parts.append(encode_part(text) if needs_encoding(dtype) else text)
        return F.concat(*parts)

    def _named(self, key: object, column: Column) -> Column:
        if key not in self._names:
            self._names[key] = f"_c{len(self._names)}"
            self.columns[self._names[key]] = column
        return F.col(self._names[key])

    def value(self, source: Source, element: Element | None = None) -> tuple[Column, bool]:
        """The value as text, and whether it is an array of texts."""
        many = False
        if isinstance(source, Const):
            text = F.lit(source.value)
        elif isinstance(source, Template):
            text = self._template(source, element)
        elif isinstance(source, JsonPath):
            text, many = json_strings(self._variant(source.column, element), source.path), True
        elif isinstance(source, Field):
            column, dtype, many = self._flat(source.path, element)
            text = F.transform(column, lexical(dtype)) if many else lexical(dtype)(column)
        else:
            raise ValueError(f"not a value source: {source!r}")
        return (text if element is not None else self._named(source, text)), many

    def subject(self, node: Node, base: str, element: Element | None = None) -> Column:
        source = node.subject_source
        if isinstance(source, Template):
            first = source.pieces()[0]
            absolute = isinstance(first, str) and re.match(ABSOLUTE_IRI, first)
            text = self._template(source, element)
            iri = text if absolute else F.concat(F.lit(base), text)
        elif isinstance(source, JsonPath):
            text = json_value(self._variant(source.column, element), source.path)
            iri = resolve_iri(text, base)
        elif isinstance(source, Field):
            column, dtype, many = self._flat(source.path, element)
            if many:
                raise ValueError(f"{source.path!r} holds a list and cannot be a subject")
            iri = resolve_iri(lexical(dtype)(column), base)
        else:
            raise ValueError(f"node {node.id!r} needs a template, a field or a JSON path as subject")
        return iri if element is not None else self._named((base, source), iri)

    def elements(self, source: Source) -> tuple[Column, T.DataType]:
        """The list a node is made for each element of, and the element's type."""
        if isinstance(source, JsonPath):
            value = F.try_variant_get(self._variant(source.column, None), source.path, "variant")
            return self._named(("each", source), json_elements(value)), T.VariantType()
        column, dtype, many = self._flat(source.path, None)
        if not many:
            raise ValueError(f"{source.path!r} holds no list")
        return self._named(("each", source), column), dtype


def _statement(s: Column, p: str, o: Column, kind: str) -> Column:
    return F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("kind"))


def _statements_of(
    inputs: _Inputs, nodes: Sequence[Node], subjects: Mapping[str, Column], element: Element | None
) -> tuple[list[Column], list[Column]]:
    """Types, properties and links of some nodes, as single statements and as arrays.

    Links to nodes that are not in ``subjects`` belong to a list and are left to it.
    """
    single, several = [], []
    for node in nodes:
        s = subjects[node.id]
        single += [_statement(s, RDF_TYPE, F.lit(cls), "type") for cls in node.classes]
        for predicate, target in node.link_targets():
            if target in subjects:
                single.append(_statement(s, predicate, subjects[target], "iri"))
        for predicate, source in node.property_sources():
            kind = "iri" if isinstance(source, Iri) else "literal"
            value, many = inputs.value(source.source if isinstance(source, Iri) else source, element)
            if many:
                several.append(_each_value(s, predicate, value, kind))
            else:
                single.append(_statement(s, predicate, value, kind))
    return single, several


def _each_value(s: Column, p: str, values: Column, kind: str) -> Column:
    known = F.coalesce(values, F.array().cast("array<string>"))
    return F.transform(known, lambda o: _statement(s, p, o, kind))


def _joined(single: list[Column], several: list[Column]) -> Column:
    return F.concat(F.array(*single), *several) if several else F.array(*single)


def _list_statements(
    inputs: _Inputs, model: Model, source: Source, nodes: Sequence[Node], outer: Mapping[str, Column]
) -> Column:
    """Statements of the nodes made for each element of one list, and links to them."""
    elements, dtype = inputs.elements(source)
    ids = {n.id for n in nodes}
    into = [
        (n.id, predicate, target)
        for n in model.reachable()
        if n.id in outer
        for predicate, target in n.link_targets()
        if target in ids
    ]

    def of_element(value: Column) -> Column:
        element = (value, dtype)
        # inside a lambda Spark shares nothing: the subjects are made once and looked up
        made = F.struct(*[inputs.subject(n, model.base, element).alias(f"s{i}") for i, n in enumerate(nodes)])

        def with_subjects(subjects: Column) -> Column:
            own = {n.id: subjects[f"s{i}"] for i, n in enumerate(nodes)}
            single, several = _statements_of(inputs, nodes, {**outer, **own}, element)
            single += [_statement(outer[n], predicate, own[t], "iri") for n, predicate, t in into]
            return _joined(single, several)

        return let(made, with_subjects)

    none = F.array().cast("array<struct<s: string, p: string, o: string, kind: string>>")
    return F.coalesce(F.flatten(F.transform(elements, of_element)), none)


def apply_models(df: DataFrame, models: Sequence[Model], keep: Sequence[str] = ()) -> DataFrame:
    """The bag union of every model's statements over one scan of ``df``.

    ``keep`` names input columns to carry along. A null in a referenced column
    yields no statement; a null subject drops the node's statements and the
    links to it. There is no shuffle, and the input may be a stream.
    """
    inputs = _Inputs(df)
    single: list[Column] = []
    several: list[Column] = []
    for model in models:
        nodes = model.reachable()
        plain = [n for n in nodes if n.each is None]
        subjects = {n.id: inputs.subject(n, model.base) for n in plain}
        one, many = _statements_of(inputs, plain, subjects, None)
        single += one
        several += many
        lists: dict[Source, list[Node]] = {}
        for node in nodes:
            if node.each is not None:
                lists.setdefault(node.each_source, []).append(node)
        several += [
            _list_statements(inputs, model, source, members, subjects)
            for source, members in lists.items()
        ]

    if inputs.parsed:
        df = df.select("*", *[c.alias(n) for n, c in inputs.parsed.items()])
    return (
        df.select(*keep, *[c.alias(n) for n, c in inputs.columns.items()])
        .select(*keep, F.inline(_joined(single, several)))
        .filter(F.col("s").isNotNull() & F.col("o").isNotNull())
    )


def apply_model(
    df: DataFrame,
    model: Model,
    root: str | None = None,
    base: str | None = None,
    context: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Statements of one model.

    ``root`` and ``base`` replace the model's own; a term-to-identifier
    ``context`` shortens its properties and classes while mapping.
    """
    options = {k: v for k, v in (("root", root), ("base", base)) if v is not None}
    model = model.with_options(**options)
    return apply_models(df, [model.compact(context) if context else model], keep)


def model_documents(df: DataFrame, model: Model, values_per_row: int | None = None) -> DataFrame:
    """One flat document per entity of one model."""
    statements = apply_model(df, model).distinct()
    return to_nodes(statements, **({"values_per_row": values_per_row} if values_per_row else {}))


def ntriples(statements: DataFrame) -> DataFrame:
    """N-Triples text, one ``line`` per statement."""
    line = ntriples_line(F.col("s"), F.col("p"), F.col("o"), F.col("kind"))
    return statements.select(line.alias("line"))

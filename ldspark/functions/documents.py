"""Column expressions over JSON text and over property maps."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F

JSON_MAP = "map<string, variant>"
PART_OF = "part_of"


def document_id(uri: Column, part: Column) -> Column:
    """A document's own identifier: the entity's, with the part from the second on.

    Stores keyed by identifier must not let one part overwrite another.
    """
    continued = F.concat(uri, F.lit("#part="), part.cast("string"))
    return F.when(part == 0, uri).otherwise(continued)


def drop_json_fields(value: Column, *names: str) -> Column:
    """JSON text of an object without the named top-level fields.

    The fields that stay keep their nesting, because they are held as variants
    and not as strings.
    """
    fields = F.from_json(value, JSON_MAP)
    return F.to_json(F.map_filter(fields, lambda k, _: ~k.isin(*names)))


# A JSON string, and what a text of JSON is made of: an inline context, an @type entry, a name, a string, or
# anything between.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_TYPE = r'"@type"\s*:\s*(?:' + _STRING + r"|\[(?:\s*" + _STRING + r"\s*,?)*+\s*\])"
_NAME = _STRING + r"\s*:"



def _object(levels: int) -> str:
    inner = rf'[^{{}}"]++|{_STRING}' + (f"|{_object(levels - 1)}" if levels else "")
    return rf"\{{(?:{inner})*+\}}"


# An inline context stays whole, with the objects inside it to this many levels.
_CONTEXT = r'"@context"\s*:\s*' + _object(4)
_TOKENS = rf'{_CONTEXT}|{_TYPE}|{_NAME}|{_STRING}|[^"]+'


def rename_json(value: Column, names: Mapping[str, str], classes: Mapping[str, str]) -> Column:
    """JSON text with its names, at any depth, and the values of ``@type`` replaced.

    Everything else stays as it is written: numbers, order, repeated elements,
    white space, an inline context. A string followed by a colon is a name, so
    the text is cut into tokens and no tree is built. Both tables are literals.
    """

    def table(entries: Mapping[str, str]) -> Column:
        pairs = [(json.dumps(k, ensure_ascii=False), json.dumps(v, ensure_ascii=False)) for k, v in entries.items()]
        if not pairs:
            return F.create_map().cast("map<string,string>")
        return F.create_map(*[F.lit(x) for pair in pairs for x in pair])

    named, typed = table(names), table(classes)

    def replaced(text: Column, by: Column) -> Column:
        plain = F.replace(text, F.lit("\\/"), F.lit("/"))
        return F.coalesce(F.try_element_at(by, plain), text)

    def of_type(token: Column) -> Column:
        parts = F.regexp_extract_all(token, F.lit(rf'{_STRING}|[^"]+'), F.lit(0))
        first = F.regexp_extract(token, _STRING, 0)
        rest = F.slice(parts, F.lit(2), F.size(parts))
        return F.concat(
            replaced(first, named),
            F.array_join(F.transform(rest, lambda x: F.when(x.startswith('"'), replaced(x, typed)).otherwise(x)), ""),
        )

    def of_name(token: Column) -> Column:
        text = F.regexp_extract(token, _STRING, 0)
        return F.concat(replaced(text, named), F.substring(token, F.length(text) + 1, F.length(token)))

    def one(token: Column) -> Column:
        return (
            F.when(~token.startswith('"') | token.rlike(f"^{_CONTEXT}$"), token)
            .when(token.rlike(f"^{_TYPE}$"), of_type(token))
            .when(token.endswith(":"), of_name(token))
            .otherwise(token)
        )

    tokens = F.regexp_extract_all(value, F.lit(_TOKENS), F.lit(0))
    return F.array_join(F.transform(tokens, one), "")


def json_value(value: Column, path: str, dtype: str = "string") -> Column:
    """One value out of a variant, null when the path is absent."""
    return F.try_variant_get(value, path, dtype)


def json_strings(value: Column, path: str) -> Column:
    """The values at ``path`` of a variant as an array of strings.

    A list gives one entry per element, anything else an array of one.
    """
    return F.coalesce(
        F.try_variant_get(value, path, "array<string>"),
        F.array(F.try_variant_get(value, path, "string")),
    )


def json_elements(value: Column) -> Column:
    """A variant's elements if it is a list, else the variant alone."""
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array(value))


def is_object(value: Column) -> Column:
    """Whether a variant holds a JSON object."""
    return F.schema_of_variant(value).startswith("OBJECT")


def walk(
    root: Column, below: Callable[[Column], Column], max_depth: int, too_deep: Column
) -> Column:
    """Every variant reached from ``root``, an array of one, level by level.

    ``below`` maps the variants of one level to those of the next. One fold per
    row: the expression does not grow with the depth, and levels that are empty
    cost nothing. Anything below ``max_depth`` levels raises ``too_deep``.
    """
    none = F.array().cast("array<variant>")
    start = F.struct(none.alias("found"), F.coalesce(root, none).alias("level"))

    def step(state: Column, _: Column) -> Column:
        found = F.concat(state["found"], state["level"])
        return F.struct(found.alias("found"), below(state["level"]).alias("level"))

    def finish(state: Column) -> Column:
        return F.when(F.size(state["level"]) > 0, F.raise_error(too_deep)).otherwise(state["found"])

    return F.reduce(F.sequence(F.lit(1), F.lit(max_depth)), start, step, finish)


def value_variants(values: Column) -> Column:
    """An array of variants from a property's ``array<struct<kind, v>>``."""
    return F.transform(values, lambda x: x["v"].cast("variant"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times.

    Inside higher-order functions Spark shares no subexpressions, and nested
    documents would be built again for every mention.
    """
    return F.transform(F.array(value), use)[0]


def one_or_list(variants: Column) -> Column:
    """A lone value as itself, several as a list, none as null."""
    return let(
        variants,
        lambda v: F.when(F.size(v) == 1, v[0]).when(F.size(v) > 1, F.to_variant_object(v)),
    )


def document_fields(
    uri: Column,
    part: Column,
    types: Column,
    props: Column,
    id_field: str = "uri",
    embedded: Mapping[str, Column] | None = None,
) -> Column:
    """``map<string, variant>`` with the fields of one document.

    Parts after the first carry their own identifier and name their entity in
    ``part_of``. ``embedded`` gives, per property, an array of variants to write there before
    the property's own values.
    """
    embedded = embedded or {}
    none = F.array().cast("array<variant>")
    head = F.create_map(
        F.lit(id_field),
        document_id(uri, part).cast("variant"),
        F.lit(PART_OF),
        F.when(part > 0, uri).cast("variant"),
        F.lit("@type"),
        one_or_list(F.transform(types, lambda t: t.cast("variant"))),
    )
    plain = F.map_filter(props, lambda k, _: ~k.isin(*embedded)) if embedded else props
    body = F.transform_values(plain, lambda _, values: one_or_list(value_variants(values)))
    edges = [
        F.create_map(
            F.lit(prop),
            one_or_list(
                F.concat(F.coalesce(documents, none), F.coalesce(value_variants(props[prop]), none))
            ),
        )
        for prop, documents in embedded.items()
    ]
    return F.map_filter(F.map_concat(head, body, *edges), lambda _, value: value.isNotNull())

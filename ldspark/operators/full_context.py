"""Documents to statements and back under contexts with prefixes, coercions, containers and terms by class.

Statements carry what such a context tells apart: ``s, p, o, kind, lang, place``, the language of a text and the place
in a list, both null elsewhere. A context is a setting of the plan: its terms are literal tables that rows look up,
by name on the way in and by identifier and kind of value on the way out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ldspark.functions.documents import JSON_MAP, PART_OF, document_id, is_object, json_elements, json_value
from ldspark.functions.terms import ABSOLUTE_IRI
from ldspark.operators.reducing import VALUES_PER_ROW
from ldspark.operators.skew import sized_groups
from ldspark.plans.context import FullContext, Term
from ldspark.plans.model import RDF_TYPE
from ldspark.session import materialize

FACT = ("s", "p", "o", "kind", "lang", "place")
_SEP = "\x1f"
_VALUE = "array<struct<o: string, kind: string, lang: string, place: int>>"


def _table(entries: Mapping[str, Column], kind: str) -> Column:
    if not entries:
        return F.create_map().cast(f"map<string, {kind}>")
    return F.create_map(*[c for k, v in entries.items() for c in (F.lit(k), v)])


def _looked_up(table: Column, key: Column) -> Column:
    return F.try_element_at(table, key)


def expand_iri(value: Column, context: FullContext, vocab: bool) -> Column:
    """The identifier a text stands for: a compact name, an identifier, a name of the vocabulary or relative to the base."""
    prefixes = _table({k: F.lit(v) for k, v in context.prefixes.items()}, "string")
    parts = F.split(value, ":", 2)
    known, rest = _looked_up(prefixes, parts[0]), F.get(parts, F.lit(1))
    if vocab:
        terms = _table({k: F.lit(t.iri) for k, t in context.terms.items()}, "string")
        other = F.coalesce(_looked_up(terms, value), F.concat(F.lit(context.vocab or ""), value))
    else:
        other = F.concat(F.lit(context.base), value)
    compact = rest.isNotNull() & known.isNotNull() & ~rest.startswith("//")
    return F.when(compact, F.concat(known, rest)).when(value.rlike(ABSOLUTE_IRI), value).otherwise(other)


def _definition(term: Term) -> Column:
    fields = (("iri", term.iri), ("kind", term.kind), ("container", term.container), ("language", term.language))
    return F.struct(*[F.lit(v).cast("string").alias(k) for k, v in fields])


def expand_documents(records: DataFrame, context: FullContext, id_field: str = "@id") -> DataFrame:
    """``s, p, o, kind, lang, place`` of flat JSON documents in ``key, value`` records; no shuffle.

    A document without an identifier is named by the record's key; a part of a large one joins its entity. Names that
    are no terms are compact names, names of the vocabulary, or stay. Objects are references (``@id``), tagged texts
    (``@value``, ``@language``), lists (``@list``), or for a term of languages texts by language; any other object is
    an error. Nulls and text that does not parse give nothing. Terms of a class hold for documents that have it; where
    several classes define one name, the class first by identifier does.
    """
    kind = "struct<iri: string, kind: string, container: string, language: string>"
    terms = _table({name: _definition(t) for name, t in context.terms.items()}, kind)
    scoped = _table(
        {f"{cls}{_SEP}{name}": _definition(t) for cls, own in context.scoped.items() for name, t in own.items()}, kind
    )
    doc = F.try_variant_get(F.try_parse_json("value"), "$", JSON_MAP)
    rows = records.select("key", doc.alias("doc"))
    listed = F.filter(
        F.transform(json_elements(_looked_up(F.col("doc"), F.lit("@type"))), lambda t: json_value(t, "$")), lambda t: t.isNotNull()
    )
    types = F.coalesce(F.transform(listed, lambda t: expand_iri(t, context, vocab=True)), F.array().cast("array<string>"))
    named = F.coalesce(
        json_value(_looked_up(F.col("doc"), F.lit(PART_OF)), "$"), json_value(_looked_up(F.col("doc"), F.lit(id_field)), "$")
    )
    subject = F.coalesce(expand_iri(named, context, vocab=False), F.col("key"))
    # a text that does not parse has no name here; a condition on the document would be moved below and parse it again
    fields = rows.select(subject.alias("s"), types.alias("types"), F.explode_outer("doc").alias("name", "raw")).filter(
        ~F.col("name").isin(id_field, PART_OF, "@context")
    )
    default = F.struct(
        expand_iri(F.col("name"), context, vocab=True).alias("iri"),
        *[F.lit(None).cast("string").alias(k) for k in ("kind", "container", "language")],
    )
    own = F.filter(
        F.transform(F.array_sort("types"), lambda t: _looked_up(scoped, F.concat(t, F.lit(_SEP), F.col("name")))), lambda d: d.isNotNull()
    )
    told = F.coalesce(F.get(own, F.lit(0)), _looked_up(terms, F.col("name")), default)
    told_rows = fields.select("s", "types", "name", "raw", told.alias("d"))
    d, raw = F.col("d"), F.col("raw")

    def value(x: Column, place: Column, lang: Column) -> Column:
        target, text = json_value(x, "$['@id']"), json_value(x, "$['@value']")
        plain = json_value(x, "$")
        refers = F.when(is_object(x), target.isNotNull()).otherwise(d["kind"].isNotNull())
        o = (
            F.when(is_object(x) & target.isNotNull(), expand_iri(target, context, vocab=False))
            .when(is_object(x) & text.isNotNull(), text)
            .when(is_object(x), F.raise_error(F.concat(F.lit("an object that is no value in "), F.col("s"))))
            .when(d["kind"] == "iri", expand_iri(plain, context, vocab=False))
            .when(d["kind"] == "vocab", expand_iri(plain, context, vocab=True))
            .otherwise(plain)
        )
        is_text = F.schema_of_variant(x) == "STRING"
        tag = F.when(is_object(x), json_value(x, "$['@language']")).when(is_text, lang)
        return F.struct(
            o.alias("o"),
            F.when(refers, "iri").otherwise("literal").alias("kind"),
            F.when(~refers, tag).alias("lang"),
            place.cast("int").alias("place"),
        )

    language = F.coalesce(d["language"], F.lit(context.language).cast("string"))
    in_list = F.try_variant_get(raw, "$['@list']", "array<variant>")
    elements = F.coalesce(in_list, json_elements(raw))
    is_list = (d["container"] == "list") | in_list.isNotNull()
    plain = F.transform(elements, lambda x, i: value(x, F.when(is_list, i), language))
    by_language = F.flatten(
        F.transform(
            F.map_entries(F.try_variant_get(raw, "$", JSON_MAP)),
            lambda e: F.transform(json_elements(e["value"]), lambda x: value(x, F.lit(None), e["key"])),
        )
    )
    is_type = F.col("name") == "@type"
    typed = F.transform(
        "types",
        lambda t: F.struct(t.alias("o"), F.lit("type").alias("kind"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("int").alias("place")),
    )
    languages = (d["container"] == "language") & is_object(raw) & json_value(raw, "$['@value']").isNull()
    values = F.when(is_type, typed.cast(_VALUE)).when(languages, by_language.cast(_VALUE)).otherwise(plain.cast(_VALUE))
    p = F.when(is_type, F.lit(RDF_TYPE)).otherwise(d["iri"])
    return told_rows.select("s", p.alias("p"), F.inline(values)).select(*FACT).filter(F.col("o").isNotNull())


# --- and back ------------------------------------------------------------------


def compact_iri(value: Column, context: FullContext, vocab: bool) -> Column:
    """The shortest way to write an identifier that reads back as it: a name of the vocabulary, else the longest prefix."""
    out = F.lit(None).cast("string")
    if vocab and context.vocab:
        rest = F.substring(value, len(context.vocab) + 1, 1 << 30)
        free = ~rest.isin(*context.terms) if context.terms else F.lit(True)
        out = F.when(value.startswith(context.vocab) & (rest != "") & ~rest.contains(":") & ~rest.startswith("@") & free, rest)
    for prefix, iri in sorted(context.prefixes.items(), key=lambda x: (-len(x[1]), x[0])):
        rest = F.substring(value, len(iri) + 1, 1 << 30)
        compact = F.concat(F.lit(prefix + ":"), rest)
        free = ~compact.isin(*context.terms) if vocab and context.terms else F.lit(True)
        out = F.coalesce(out, F.when(value.startswith(iri) & ~rest.startswith("//") & free, compact))
    if not vocab and context.base:
        rest = F.substring(value, len(context.base) + 1, 1 << 30)
        out = F.coalesce(out, F.when(value.startswith(context.base) & (rest != "") & ~rest.contains(":"), rest))
    # an identifier must not read as a compact name; without a way to write it, it stays
    return F.coalesce(out, value)


def _as_name(value: Column, context: FullContext) -> Column:
    """An identifier as a term, else as :func:`compact_iri` writes names."""
    named: dict[str, str] = {}
    for name, term in sorted(context.terms.items(), key=lambda x: (len(x[0]), x[0])):
        named.setdefault(term.iri, name)
    table = _table({iri: F.lit(name) for iri, name in named.items()}, "string")
    return F.coalesce(_looked_up(table, value), compact_iri(value, context, vocab=True))


def _choices(terms: Mapping[str, Term], default: str | None) -> dict[str, dict[str, str]]:
    """Per identifier and kind of value the term that reads back as that kind, the first by length and name."""
    out: dict[str, dict[str, str]] = {}
    for name, term in sorted(terms.items(), key=lambda x: (len(x[0]), x[0])):
        own = out.setdefault(term.iri, {})
        plain = "list" if term.container == "list" else "one"
        if term.container == "language":
            own.setdefault("languages", name)
        elif term.kind:
            own.setdefault(f"{plain}:{term.kind}", name)
        else:
            language = term.language or default
            own.setdefault(f"{plain}:text:{language or ''}", name)
    return out


def _json(text: Column) -> Column:
    """A text as a JSON string."""
    whole = F.to_json(F.array(text))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def compact_statements(
    facts: DataFrame, context: FullContext, id_field: str = "@id", values_per_row: int = VALUES_PER_ROW
) -> DataFrame:
    """``key, value``: JSON documents under a context, from ``s, p, o, kind, lang, place`` statements.

    :func:`expand_documents` reads them back as the same statements. A property is written by the term whose coercion,
    language and container fit the value; where there is none, by a name of the vocabulary, the longest prefix or in
    full, and the value says what it is. Values other than lists are a set, sorted; a list keeps order and repeats.
    A subject has one list at most for a property. Documents of more than ``values_per_row`` values go on in parts,
    each with the types, whose lists stay whole.
    """
    rows = materialize(facts.select(*FACT).distinct(), "facts")
    classes = sorted(context.scoped)
    if classes:
        of_class = rows.filter((F.col("kind") == "type") & F.col("o").isin(*classes))
        scopes = of_class.groupBy("s").agg(F.sort_array(F.collect_set("o")).alias("scopes"))
        rows = rows.join(scopes, "s", "left")
    tables: dict[str, Column] = {}
    for scope, terms in (("", context.terms), *context.scoped.items()):
        hidden = {k: t for k, t in terms.items()}
        for iri, own in _choices(hidden, context.language).items():
            for choice, name in own.items():
                tables[_SEP.join((scope, iri, choice))] = F.lit(name)
    names = _table(tables, "string")
    # a term of a class hides one of the same name where that class is
    hides = sorted({name for own in context.scoped.values() for name in own})

    shape = F.when(F.col("place").isNotNull(), "list").otherwise("one")
    is_iri = F.col("kind") == "iri"
    options = [
        F.when(~is_iri & F.col("lang").isNotNull() & F.col("place").isNull(), F.lit("languages")),
        F.when(is_iri, F.concat(shape, F.lit(":iri"))),
        F.when(~is_iri, F.concat(shape, F.lit(":text:"), F.coalesce("lang", F.lit("")))),
        F.when(is_iri, F.concat(shape, F.lit(":vocab"))),
    ]

    def named(scope: Column, option: Column) -> Column:
        return _looked_up(names, F.concat_ws(_SEP, scope, F.col("p"), option))

    found = []
    for option in options:
        outer = F.when(option.isNotNull(), named(F.lit(""), option))
        if classes:
            inner = F.filter(F.transform("scopes", lambda c: F.when(option.isNotNull(), named(c, option))), lambda n: n.isNotNull())
            # an outer name is no use where a class of the document gives it another meaning
            free = ~F.coalesce(outer.isin(*hides), F.lit(False)) | F.col("scopes").isNull() if hides else F.lit(True)
            found += [F.get(inner, F.lit(0)), F.when(free, outer)]
        else:
            found.append(outer)
    term = F.coalesce(*found)
    by_name = is_iri & F.coalesce(*found[: len(found) - len(found) // len(options)]).isNull() & F.col("term").isNotNull()
    is_type = F.col("kind") == "type"
    chosen = rows.withColumn("term", F.when(~is_type, term)).withColumns({"by_name": by_name}).withColumn(
        "name", F.when(is_type, F.lit("@type")).otherwise(F.coalesce("term", compact_iri(F.col("p"), context, vocab=True)))
    )
    languages = sorted(
        {n for own in (context.terms, *context.scoped.values()) for n, t in own.items() if t.container == "language"}
    )
    in_languages = F.col("term").isin(*languages) if languages else F.lit(False)
    target = compact_iri(F.col("o"), context, vocab=False)
    tagged = F.concat(
        F.lit('{"@value":'), _json(F.col("o")),
        F.when(F.col("lang").isNotNull(), F.concat(F.lit(',"@language":'), _json(F.col("lang")))).otherwise(""), F.lit("}"),
    )
    bare = F.col("term").isNotNull() | (F.col("lang").eqNullSafe(F.lit(context.language).cast("string")))
    text = (
        F.when(is_type | F.col("by_name"), _json(_as_name(F.col("o"), context)))
        .when(is_iri & F.col("term").isNotNull(), _json(target))
        .when(is_iri, F.concat(F.lit('{"@id":'), _json(target), F.lit("}")))
        .when(bare, _json(F.col("o")))
        .otherwise(tagged)
    )
    written = chosen.select(
        "s", "name", F.col("place"), text.alias("text"),
        F.when(in_languages, F.col("lang")).alias("lang"),
        F.when(F.col("place").isNotNull(), F.when(F.col("term").isNull(), "object").otherwise("list")).alias("list"),
        F.when(F.col("place").isNull(), F.concat_ws(_SEP, "p", "o", "lang")).otherwise(F.col("p")).alias("spread"), "kind",
    )
    marked, tasks = sized_groups(written, ["s"], ["spread"], values_per_row)
    placed = marked.withColumn(
        "part", F.explode(F.when(F.col("kind") == "type", F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part")))
    )
    keys = ["s", "part", "parts", "name"]
    by_language = placed.repartition(tasks, "s", "part").groupBy(*keys, "lang", "list").agg(
        F.sort_array(F.collect_list(F.struct("place", "text"))).alias("values")
    )
    texts = F.transform("values", lambda v: v["text"])
    listing = F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))
    always = sorted({n for own in (context.terms, *context.scoped.values()) for n, t in own.items() if t.container == "set"})
    lone = (F.size(texts) == 1) & (~F.col("name").isin(*always) if always else F.lit(True))
    json = (
        F.when(F.col("list") == "object", F.concat(F.lit('{"@list":'), listing, F.lit("}")))
        .when(F.col("list") == "list", listing)
        .when(lone, texts[0])
        .otherwise(listing)
    )
    by_property = by_language.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("lang", json.alias("json")))).alias("languages")
    )
    entries = F.transform("languages", lambda e: F.concat(_json(e["lang"]), F.lit(":"), e["json"]))
    whole = F.when(F.col("languages")[0]["lang"].isNull(), F.col("languages")[0]["json"]).otherwise(
        F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}"))
    )
    by_subject = by_property.groupBy("s", "part").agg(
        F.sort_array(F.collect_list(F.struct("name", whole.alias("json")))).alias("fields")
    )
    body = F.transform("fields", lambda f: F.concat(_json(f["name"]), F.lit(":"), f["json"]))
    key = document_id(F.col("s"), F.col("part"))
    head = F.concat(
        _json(F.lit(id_field)), F.lit(":"), _json(compact_iri(key, context, vocab=False)),
        F.when(F.col("part") > 0, F.concat(F.lit(f',"{PART_OF}":'), _json(compact_iri(F.col("s"), context, vocab=False)))).otherwise(""),
    )
    return by_subject.select(
        key.alias("key"), F.concat(F.lit("{"), F.concat_ws(",", head, F.array_join(body, ",")), F.lit("}")).alias("value")
    )

"""Folders of frames, contexts and models, and the types frames name.

The functions take ``path, text`` tables, as :func:`ldspark.sources.read_files`
gives them, so any number of files is a distributed scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ldspark.functions.documents import JSON_MAP, is_object, json_strings, walk

MAX_FRAME_DEPTH = 64


def _file_name(path: str = "path") -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _folder_name(path: str = "path") -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def list_frames(files: DataFrame, suffix: str = ".json") -> DataFrame:
    """``name, path, text`` of the files with the suffix; the name is without it."""
    name = _file_name()
    return files.filter(name.endswith(suffix)).select(
        name.substr(F.lit(1), F.length(name) - len(suffix)).alias("name"), "path", "text"
    )


def pair_models(
    files: DataFrame, model_suffix: str = "-model.ttl", root_suffix: str = "-root.txt"
) -> DataFrame:
    """``name, url, root`` of every model that has a root file beside it.

    The two files share their folder and the start of their names. The name is
    the folder's, the root is the trimmed text; a model without root is left out.
    """
    name = _file_name()

    def side(suffix: str) -> DataFrame:
        stem = F.col("path").substr(F.lit(1), F.length("path") - len(suffix))
        return files.filter(name.endswith(suffix)).withColumn("stem", stem)

    models = side(model_suffix).select("stem", "path")
    roots = side(root_suffix).select("stem", F.regexp_replace("text", r"^\s+|\s+$", "").alias("root"))
    return models.join(roots, "stem").select(
        _folder_name().alias("name"), F.col("path").alias("url"), "root"
    )


def frame_types(frames: DataFrame, max_depth: int = MAX_FRAME_DEPTH) -> DataFrame:
    """Distinct ``name, type`` over frames ``name, text``.

    Descends objects level by level inside the row, so there is no shuffle
    before the final distinct. Lists are not descended, inline contexts are
    skipped, and a list of types gives each. A frame deeper than ``max_depth``
    is an error, never cut short.
    """
    def below(objects: Column) -> Column:
        return F.flatten(
            F.transform(
                objects,
                lambda v: F.map_values(
                    F.map_filter(
                        F.try_variant_get(v, "$", JSON_MAP),
                        lambda k, c: (k != "@context") & is_object(c),
                    )
                ),
            )
        )

    too_deep = F.concat(F.lit(f"frame deeper than {max_depth}: "), F.col("name"))
    every = walk(F.array(F.try_parse_json("text")), below, max_depth, too_deep)
    named = F.flatten(F.transform(every, lambda v: json_strings(v, "$['@type']")))
    return (
        frames.select("name", F.explode(named).alias("type"))
        .filter(F.col("type").isNotNull())
        .distinct()
    )


def types_with_uris(types: DataFrame, context: DataFrame, strict: bool = True) -> DataFrame:
    """Distinct ``name, uri`` of frame types looked up in a ``term, iri`` context.

    With ``strict`` an unknown type fails the query that reads it, naming it;
    otherwise its uri is null.
    """
    names = types.select(F.col("type").alias("name")).distinct()
    table = context.groupBy("term").agg(F.max("iri").alias("iri"))
    uri = F.col("iri")
    if strict:
        uri = F.coalesce(
            uri, F.raise_error(F.concat(F.lit("type not in the context: "), F.col("name")))
        )
    return names.join(table, names["name"] == table["term"], "left").select(
        "name", uri.alias("uri")
    )


def unknown_types(types: DataFrame, context: DataFrame) -> DataFrame:
    """The types a context does not define."""
    return types_with_uris(types, context, strict=False).filter(F.col("uri").isNull()).select("name")

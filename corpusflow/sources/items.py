"""Nested response items as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow import constants as K
from corpusflow.functions.columns import people_names

_PERSON = "struct<name: string, profile: struct<name: string>>"


def _either_list(text: Column, element: str) -> Column:
    """Elements of ``{"items": [...]}`` or of a plain ``[...]``.

    Nested values are read as text first; the layout that does not fit gives NULL.
    """
    wrapped = F.from_json(text, f"struct<items: array<{element}>>")["items"]
    plain = F.from_json(text, f"array<{element}>")
    return F.when(F.ltrim(text).startswith("{"), wrapped).otherwise(plain)


def explode_search_pages(df: DataFrame, json_col: str) -> DataFrame:
    """One row per item of a search page, with the columns of the page before it.

    Handles both page layouts and items wrapped in ``data``. Adds ``item_pos``,
    the identifier, title and people; items without an identifier drop out.
    """
    rest = [c for c in df.columns if c != json_col]
    tracks = F.get_json_object(json_col, "$.tracks")
    items = df.select(*rest, F.posexplode(_either_list(tracks, "string")).alias("item_pos", "_item"))
    inner = F.coalesce(F.get_json_object("_item", "$.data"), F.col("_item"))
    fields = F.from_json(inner, "struct<id: string, name: string, artists: string>")
    parsed = items.withColumn("_f", fields)
    names = people_names(_either_list(F.col("_f.artists"), _PERSON), struct=True, profile_first=True)
    people = F.nullif(F.array_join(names, ", "), F.lit(""))
    return parsed.filter(F.nullif(F.col("_f.id"), F.lit("")).isNotNull()).select(
        *rest,
        "item_pos",
        F.col("_f.id").alias(K.ID_COL),
        F.coalesce("_f.name", F.lit(K.UNKNOWN)).alias(K.TITLE_COL),
        F.coalesce(people, F.lit(K.UNKNOWN)).alias(K.PEOPLE_COL),
    )


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    out: list[tuple[str, ...]] = []
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            out += _leaves(field.dataType, here)
        else:
            out.append(here)
    return out


def flatten_items(df: DataFrame, json_col: str, schema: T.StructType) -> DataFrame:
    """JSON objects to columns; nested fields get dotted names.

    NULL, empty and unreadable items drop out. Other columns stay in front.
    """
    rest = [c for c in df.columns if c != json_col]
    item = F.from_json(json_col, schema, {"mode": "PERMISSIVE"})
    parsed = df.select(*rest, item.alias("_item"))
    paths = _leaves(schema)

    def leaf(path: tuple[str, ...]) -> Column:
        col = F.col("_item")
        for name in path:
            col = col.getField(name)
        return col

    filled = F.coalesce(*[leaf(p).cast("string") for p in paths]).isNotNull()
    return parsed.filter(filled).select(*rest, *[leaf(p).alias(".".join(p)) for p in paths])

"""People lists in text form, and the one place where a caller's Python runs inside tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.columns import _col, people_names, strip

_PERSON = "struct<name: string, profile: struct<name: string>>"
# An element that is None, not a word inside a name.
_BARE_NONE = r"(?<=[\[,:]\s{0,9})None(?=\s*[,\]}])"


def format_people_text(c: Column | str) -> Column:
    """Names in the text form of a list (``[{'name': …}, 'B', None]``), comma-joined.

    Elements are objects with a name (or a profile with one) or plain texts;
    quotes may be single or double, ``None`` counts as missing. A text that is no
    list, or a broken one, comes back stripped; NULL gives an empty text.
    """
    text = _col(c)
    body = strip(F.coalesce(text, F.lit("")))
    elements = F.from_json(F.regexp_replace(body, _BARE_NONE, "null"), "array<string>")
    person = lambda x: F.from_json(x, _PERSON)
    entries = F.transform(
        elements,
        lambda x: F.when(x.startswith("{"), person(x)).otherwise(
            F.struct(x.alias("name"), F.lit(None).cast("struct<name: string>").alias("profile"))
        ),
    )
    names = F.array_join(people_names(entries, struct=True), ", ")
    return F.when(body.startswith("["), F.coalesce(names, body)).otherwise(body)


def apply_rows(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Run a batch function (pandas in, pandas out) of any per-row library.

    For decoders and detectors Spark has no expression for. ``fn`` gets one
    Arrow batch at a time, so memory does not grow with the partition.
    """

    def batches(frames):
        for frame in frames:
            yield fn(frame)

    return df.mapInPandas(batches, schema)

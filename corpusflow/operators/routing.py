"""Send every text to one of four routes, with the reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions.columns import fill_sentinel
from corpusflow.functions.text import compilation_reason, has_text

ROUTES = ["compilation", "no_text", "foreign", "kept"]


def content_route(
    df: DataFrame,
    title: str,
    text: str,
    keywords: Sequence[str] | None = None,
    sentinel: str = K.NO_TEXT,
) -> DataFrame:
    """Add ``route`` and ``reason`` as far as the content alone decides.

    Missing texts become the sentinel; readable texts of single works stay
    without a route.
    """
    filled = df.withColumn(text, fill_sentinel(text, sentinel))
    why = compilation_reason(title, text, None if keywords is None else list(keywords), sentinel)
    readable = has_text(text, sentinel)
    return filled.withColumn("reason", why).withColumns(
        {
            "route": F.when(F.col("reason").isNotNull(), F.lit("compilation")).when(
                ~readable, F.lit("no_text")
            ),
            "reason": F.coalesce("reason", F.when(~readable, F.lit("no text"))),
        }
    )


def route_by_language(df: DataFrame, target: str, language: str = "language") -> DataFrame:
    """Settle the rows ``content_route`` left open: the target language is kept."""
    open_row = F.col("route").isNull()
    ours = F.coalesce(F.col(language) == target, F.lit(False))
    lang = F.coalesce(F.col(language), F.lit(K.UNKNOWN_LANGUAGE))
    return df.withColumns(
        {
            "route": F.when(open_row, F.when(ours, F.lit("kept")).otherwise(F.lit("foreign"))).otherwise(F.col("route")),
            "reason": F.when(open_row & ~ours, F.concat(F.lit("language "), lang)).otherwise(F.col("reason")),
        }
    )


def split_routes(routed: DataFrame) -> dict[str, DataFrame]:
    """One filtered view per route; together they hold every row once."""
    return {r: routed.filter(F.col("route") == r) for r in ROUTES}


def write_routes(routed: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One pass over the input, one folder per route."""
    routed.write.mode(mode).partitionBy("route").parquet(path)

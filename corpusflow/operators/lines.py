"""Ordered lines put together to texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions.columns import strip


def join_lines(
    df: DataFrame,
    key: str,
    order: str,
    text: str,
    sentinel: str = K.NO_TEXT,
    lines_per_part: int | None = None,
) -> DataFrame:
    """(key, text): stripped, non-blank lines in order, newline-joined, one text per key.

    ``order`` is any sortable number, unique within a key. A text with nothing
    left is the sentinel. For texts too long for one row, ``lines_per_part``
    cuts each into parts of that many lines by their rank, gaps in the numbers
    not counted: (key, part, text).
    """
    line = strip(text)
    kept = F.when(line != "", F.struct(F.col(order).alias("o"), line.alias("t")))
    keys = [key]
    if lines_per_part is not None:
        rank = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
        df = df.withColumn("part", F.floor(rank / F.lit(lines_per_part)).cast("long"))
        keys = [key, "part"]
    joined = F.array_join(F.array_sort(F.collect_list(kept))["t"], "\n")
    return df.groupBy(*keys).agg(F.coalesce(F.nullif(joined, F.lit("")), F.lit(sentinel)).alias(text))

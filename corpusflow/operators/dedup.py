"""Deduplication with a fixed survivor, caps, and set operations on identifiers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.columns import match_key, normalize_id
from corpusflow.operators.index import dense_index


def dedup_first(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column]
) -> DataFrame:
    """The first row of every key in the given order.

    ``order_by`` has to be unique within a key. Spark cuts every map task down
    to one row per key before the shuffle (window group limit), so a key that
    holds a third of all rows costs no more than any other.
    """
    spec = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(spec)).filter("_rank = 1").drop("_rank")


def dedup_by_match_key(
    df: DataFrame, cols: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """``dedup_first`` on case- and blank-insensitive texts."""
    names = {f"_key{i}": match_key(c) for i, c in enumerate(cols)}
    return dedup_first(df.withColumns(names), list(names), order_by).drop(*names)


def cap(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in arrival order; ``order_by`` has to be unique.

    Only the order columns are numbered; rows pass that do not come after the
    n-th of them. Names sort ascending, NULL first.
    """
    if n <= 0:
        return df.limit(0)
    names = [f"_o{i}" for i in range(len(order_by))]
    keys = df.select(*[_column(c).alias(name) for c, name in zip(order_by, names)])
    last = dense_index(keys, names, "_pos").filter(F.col("_pos") == n - 1).drop("_pos").first()
    if last is None:
        return df
    kinds = dict(keys.dtypes)
    bound = F.struct(*[F.lit(last[name]).cast(kinds[name]).alias(name) for name in names])
    return df.filter(F.struct(*[_column(c).alias(name) for c, name in zip(order_by, names)]) <= bound)


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def admit_new(
    batch: DataFrame,
    seen: DataFrame,
    key: str,
    order_by: Sequence[str | Column],
    target: int | None = None,
) -> DataFrame:
    """Rows of a batch with keys not seen so far, first of each key, up to the target size.

    ``target`` bounds seen and new keys together.
    """
    known = seen.select(key).filter(F.col(key).isNotNull()).distinct()
    fresh = dedup_first(
        batch.filter(F.col(key).isNotNull()).join(known, key, "left_anti"), [key], order_by
    )
    return fresh if target is None else cap(fresh, target - known.count(), order_by)


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    """Distinct identifiers as stripped texts; blank, ``nan`` and NULL are none."""
    return df.select(normalize_id(key).alias(key)).filter(F.col(key).isNotNull()).distinct()


def sorted_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key value, sorted by the value."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(key)


def concat_tables(*tables: DataFrame) -> DataFrame:
    """Rows of all tables; a column a table lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def id_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` does not have."""
    return a.select(key).subtract(b.select(key))

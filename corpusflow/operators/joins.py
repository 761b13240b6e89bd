"""Equi-joins on identifiers.

No side is broadcast by hint: Catalyst broadcasts a side only when its known
size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE splits skewed
partitions of the shuffled joins. A left join can split its left side only, so
``enrich_left`` salts the hot keys of its right side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.operators.dedup import dedup_first

# Right rows of one key that a single task may join.
HOT_ROWS = 1_000_000
# Keys that the sketch of frequent ones follows, and those it reports at most.
SKETCH_ITEMS, HOT_KEYS = 100_000, 10_000


def enrich_left(left: DataFrame, right: DataFrame, on: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Left join; of columns both sides have, the left one stays. Fan-out is kept.

    A sketch of the right keys, merged from one per task, finds those with more
    than ``hot_rows`` rows. The right rows of such a key are dealt out under
    salts and its left rows repeated once a salt; a left row that finds nothing
    under one salt is left out there, as it has a partner under another. Which keys
    are salted changes no row. ``None`` is for a right side with unique keys and
    saves the sketch.
    """
    clash = [c for c in right.columns if c in left.columns and c != on]
    right = right.drop(*clash)
    hot = [] if hot_rows is None else hot_keys(right, on, hot_rows)
    if not hot:
        return left.join(right, on, "left")
    kind = right.schema[on].dataType
    # At most HOT_KEYS rows.
    rows = left.sparkSession.createDataFrame(hot, "_hot string, _salts int")
    salts = F.broadcast(rows.select(F.col("_hot").cast(kind).alias("_hot"), "_salts"))
    names = [c for c in right.columns if c != on]

    def salted(df: DataFrame) -> DataFrame:
        return df.join(salts, F.col(f"`{on}`") == F.col("_hot"), "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    every = salted(left).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - F.lit(1))))
    dealt = salted(right).select(
        on,
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.lit(True).alias("met")).alias("_right"),
        F.floor(F.rand(K.SEED) * F.col("_salts")).cast("int").alias("_salt"),
    )
    met = every.join(dealt, [on, "_salt"], "left").filter((F.col("_salts") == 1) | F.col("_right").isNotNull())
    own = [F.col(f"`{c}`") for c in left.columns if c != on]
    return met.select(on, *own, *[F.col(f"_right.c{i}").alias(c) for i, c in enumerate(names)])


def hot_keys(df: DataFrame, on: str, hot_rows: int) -> list[tuple[str, int]]:
    """(key as text, parts of ``hot_rows`` rows) of the keys with more rows than that, by a sketch of frequent items."""
    found = df.filter(F.col(f"`{on}`").isNotNull()).select(F.col(f"`{on}`").alias("k"))
    top = found.selectExpr(f"approx_top_k(k, {HOT_KEYS}, {SKETCH_ITEMS}) AS top").select(F.inline("top"))
    frequent = top.filter(F.col("count") > hot_rows).select(F.col("item").cast("string"), F.ceil(F.col("count") / hot_rows).cast("int"))
    return [tuple(r) for r in frequent.collect()]


def merge_inner(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner join of two tables that are unique on ``on``."""
    return left.join(right, on, "inner")


def reconcile(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Distinct keys matched, only left and only right, in one row.

    Both key lists go through one aggregation, which already drops repeats
    before its shuffle.
    """

    def side(df: DataFrame, in_left: bool) -> DataFrame:
        return df.select(
            F.col(on), F.lit(in_left).alias("in_left"), F.lit(not in_left).alias("in_right")
        )

    keys = (
        side(left, True)
        .unionByName(side(right, False))
        .filter(F.col(on).isNotNull())
        .groupBy(on)
        .agg(F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right"))
    )
    return keys.agg(
        F.count_if(F.col("in_left") & F.col("in_right")).alias("matched"),
        F.count_if(F.col("in_left") & ~F.col("in_right")).alias("only_left"),
        F.count_if(~F.col("in_left") & F.col("in_right")).alias("only_right"),
    )


def pending(requested: DataFrame, done: DataFrame, on: str) -> DataFrame:
    """Requested rows whose key is not done yet."""
    return requested.join(done.select(on), on, "left_anti")


def synced(df: DataFrame, assets: DataFrame, on: str) -> DataFrame:
    """Rows whose asset exists."""
    return df.join(assets.select(on), on, "left_semi")


def complete_from_request(
    requested: DataFrame, got: DataFrame, on: str, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Every requested key appears; what was not delivered is NULL or its default."""
    full = requested.select(on).distinct().join(got, on, "left")
    return full.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()}
    )


def attach_title(
    df: DataFrame, titles: DataFrame | None, on: str, title_col: str = K.TITLE_COL
) -> DataFrame:
    """Add the title where a title table exists, else an empty title."""
    if titles is None:
        return df.withColumn(title_col, F.lit(""))
    return df.join(titles.select(on, title_col), on, "left")


def attach_preferred_asset(
    df: DataFrame,
    assets: DataFrame,
    on: str,
    extension: str = "ext",
    path: str = "path",
    order: Sequence[str] = K.ASSET_EXTENSIONS,
) -> DataFrame:
    """Add the asset with the first available extension; rows without one drop out.

    ``asset_losses`` counts those.
    """
    rank = F.array_position(F.array(*[F.lit(e) for e in order]), F.col(extension))
    ranked = assets.select(on, extension, path, rank.alias("_rank_ext")).filter("_rank_ext > 0")
    best = dedup_first(ranked, [on], ["_rank_ext", path]).drop("_rank_ext")
    return df.join(best, on, "inner")


def asset_losses(
    df: DataFrame,
    assets: DataFrame,
    on: str,
    extension: str = "ext",
    order: Sequence[str] = K.ASSET_EXTENSIONS,
) -> DataFrame:
    """One row: rows that have an asset of an accepted extension, and rows dropped for lack of one."""
    accepted = assets.filter(F.col(extension).isin(list(order))).select(on).distinct()
    marked = df.select(on).join(accepted.withColumn("_has", F.lit(True)), on, "left")
    return marked.agg(
        F.count_if(F.col("_has").isNotNull()).alias("with_asset"),
        F.count_if(F.col("_has").isNull()).alias("without_asset"),
    )

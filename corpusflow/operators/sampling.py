"""Reproducible balanced samples, folds, mixing and batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow import constants as K
from corpusflow.functions.arrays import blend
from corpusflow.functions.columns import seeded_hash, seeded_uniform
from corpusflow.operators.index import chunk, hash_index
from corpusflow.session import CLASS_ROW_BYTES, broadcast_if_small, stage

# Draws of one row that a single join key may get before the key is salted.
DRAWS_PER_KEY = 100_000


def balanced_sample(
    df: DataFrame,
    key: str,
    label: str,
    n: int | None = None,
    seed: int = K.SEED,
    draws_per_key: int = DRAWS_PER_KEY,
) -> DataFrame:
    """``n`` rows drawn with replacement, every class equally likely.

    Adds ``draw`` (0 … n-1). A draw picks a class, then a position inside it,
    and meets the row by an equi-join. Where a rare class would get more than
    ``draws_per_key`` draws per member, its few members are repeated under a
    salt, so no join key gets more than that.
    """
    members = hash_index(df, key, seed, group=label, per_group=True, name="_at")
    order = Window.orderBy(label)  # one row per class
    classes = stage(
        df.filter(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count("*").alias("_size"))
        .withColumns(
            {
                "_class": (F.row_number().over(order) - F.lit(1)).cast("long"),
                "_classes": F.count("*").over(Window.partitionBy()),
                "_rows": F.sum("_size").over(Window.partitionBy()),
            }
        ),
        "classes",
    )
    shape = classes.select("_classes", "_rows").first()
    if shape is None:
        return df.withColumn("draw", F.lit(0).cast("long")).limit(0)
    wanted = shape["_rows"] if n is None else n
    per_member = F.lit(wanted / shape["_classes"]) / F.col("_size")
    classes = classes.select(
        label,
        "_class",
        "_size",
        F.greatest(F.ceil(per_member / F.lit(draws_per_key)), F.lit(1)).cast("long").alias("_salts"),
    )
    class_bytes = shape["_classes"] * CLASS_ROW_BYTES
    draws = df.sparkSession.range(wanted).select(
        F.col("id").alias("draw"),
        F.floor(seeded_uniform("id", f"{seed}:class") * F.lit(shape["_classes"])).alias("_class"),
        seeded_uniform("id", f"{seed}:member").alias("_u"),
    )
    placed = draws.join(broadcast_if_small(classes, class_bytes), "_class").select(
        "draw",
        label,
        F.floor(F.col("_u") * F.col("_size")).alias("_at"),
        (F.col("draw") % F.col("_salts")).alias("_salt"),
    )
    salts = broadcast_if_small(classes.select(label, "_salts"), class_bytes)
    salted = members.join(salts, label).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - F.lit(1)))
    )
    return placed.join(salted, [label, "_at", "_salt"]).select("draw", *df.columns)


def stratified_folds(
    df: DataFrame, key: str, label: str, k: int = K.FOLDS, seed: int = K.SEED
) -> DataFrame:
    """Add ``fold``: shuffled, with class counts and sizes that differ by at most one."""
    indexed = hash_index(df, key, seed, group=label, name="_at")
    return indexed.withColumn("fold", (F.col("_at") % F.lit(k)).cast("int")).drop("_at")


def fold_split(df: DataFrame, fold: int, name: str = "fold") -> tuple[DataFrame, DataFrame]:
    """Training rows and held-out rows of one fold."""
    return df.filter(F.col(name) != fold), df.filter(F.col(name) == fold)


def _beta(alpha: float, seed: int):
    @F.pandas_udf(T.DoubleType())
    def draw(batch: pd.Series) -> pd.Series:
        return pd.Series([np.random.default_rng([seed, int(b)]).beta(alpha, alpha) for b in batch])

    return draw


def mixup(
    df: DataFrame,
    key: str,
    vectors: list[str],
    size: int = 64,
    alpha: float = K.MIXUP_ALPHA,
    seed: int = K.SEED,
    lam: float | None = None,
) -> DataFrame:
    """Mix the array columns of every row with those of another row of its batch.

    Batches of ``size`` follow the key; inside one, row i meets the row that a
    seeded shuffle puts at place i. One lambda per batch, Beta(alpha, alpha)
    unless ``lam`` fixes it. Other columns stay. Adds ``batch`` and ``partner``.
    Rows without a key are in no batch: they come back as they are, with NULL
    for batch, lambda and partner.
    """
    keyless = df.filter(F.col(f"`{key}`").isNull())
    df = df.filter(F.col(f"`{key}`").isNotNull())
    # Only the keys are numbered (and checkpointed); the arrays join by key.
    batches = df.join(chunk(df.select(key), size, [key]), key)
    if alpha <= 0 and lam is None:
        whole = batches.drop("pos").withColumn("partner", F.col(key))
        return whole.unionByName(keyless, allowMissingColumns=True)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    # A group holds at most ``size`` rows.
    grouped = batches.groupBy("batch").agg(
        F.array_sort(F.collect_list(F.struct("pos", row.alias("row")))).alias("_rows"),
        F.array_sort(
            F.collect_list(
                F.struct(
                    seeded_hash(key, seed).alias("h"),
                    F.col("pos"),
                    F.struct(F.col(key), *vectors).alias("row"),
                )
            )
        ).alias("_others"),
    )
    weight = F.lit(lam) if lam is not None else _beta(alpha, seed)("batch")
    pairs = grouped.withColumn("lam", weight).select(
        "batch", "lam", F.explode(F.arrays_zip("_rows", "_others")).alias("p")
    )
    mine, other = F.col("p._rows.row"), F.col("p._others.row")
    mixed = pairs.select(
        "batch",
        "lam",
        other[key].alias("partner"),
        *[
            blend(mine[c], other[c], F.col("lam")).alias(c) if c in vectors else mine[c].alias(c)
            for c in df.columns
        ],
    )
    return mixed.unionByName(keyless, allowMissingColumns=True)


def eval_batches(
    df: DataFrame, key: str, size: int, drop_last: bool = False
) -> DataFrame:
    """Number rows into batches; ``drop_last`` leaves out an incomplete last one."""
    batches = chunk(df, size, [key])
    if not drop_last:
        return batches
    whole = batches.count() // size
    return batches.filter(F.col("batch") <= whole)

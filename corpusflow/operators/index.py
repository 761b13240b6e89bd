"""Global positions, batches and running counts without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions.columns import seeded_hash
from corpusflow.session import fix_rows, stage

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below
_HASH_BITS = 48
# Keys that one task ranks.
BUCKET_ROWS = 500_000


def dense_index(df: DataFrame, order_by: Sequence[str | Column], name: str = "pos") -> DataFrame:
    """0-based position of every row in a global order that has no ties.

    The rows are range-partitioned and sorted, then checkpointed, which fixes
    the partition bounds. Rows before a partition are a running sum over one
    count per partition. Ranges follow the whole sort key, so a hot leading
    value is split. Pass only the columns needed: all are checkpointed.
    """
    cols = df.columns
    fixed = fix_rows(df.repartitionByRange(*order_by).sortWithinPartitions(*order_by))
    placed = fixed.withColumn("_at", F.monotonically_increasing_id())
    part = F.shiftright("_at", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    # One row per partition: bounded by the number of shuffle partitions.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(
            *[F.col(f"`{c}`") for c in cols],
            (F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + F.col("_before")).alias(name),
        )
    )


def hash_index(
    df: DataFrame,
    key: str,
    seed: int = K.SEED,
    group: str | None = None,
    per_group: bool = False,
    name: str = "pos",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """0-based position in a seeded random order; ``key`` has to be unique.

    With ``group`` the order is (group, hash): numbered through, or from 0 in
    every group with ``per_group``; groups are meant to be few, such as classes.
    Keys and groups alone are written once, counted and ranked; other columns
    meet the positions by key. Leading hash bits form buckets of even size, so
    many that one has about ``bucket_rows`` rows: a group with a third of the
    rows spreads like any other. Bucket sizes enter as running sums.
    """
    names = list(dict.fromkeys([key, *([group] if group else [])]))
    placed = df.select(F.col(f"`{key}`").alias("_key"), *([F.col(f"`{group}`").alias("_group")] if group else []))
    keys = stage(placed.withColumn("_hash", seeded_hash("_key", seed)), "keys")
    bits = min(max((keys.count() // bucket_rows).bit_length(), 0), _HASH_BITS // 2)
    bucket = F.shiftright("_hash", _HASH_BITS - bits)
    # A struct as key lets rows without a group keep each other company.
    slot = F.struct(*([F.col("_group").alias("g")] if group else []), bucket.alias("b"))
    hashed = keys.withColumn("_slot", slot)
    before = Window.orderBy("_slot")  # one row per group and bucket
    if per_group and group:
        before = Window.partitionBy("_slot.g").orderBy("_slot")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy("_slot")
        .agg(F.count("*").alias("_rows"))
        .select("_slot", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_slot").orderBy("_hash", "_key")
    # Joined on the window's own key: the ranked rows are not shuffled again.
    ranked = hashed.withColumn("_rank", F.row_number().over(inside)).join(offsets, "_slot")
    at = (F.col("_rank") - F.lit(1) + F.col("_before")).alias(name)
    if set(df.columns) <= set(names):
        own = {key: "_key", **({group: "_group"} if group and group != key else {})}
        return ranked.select(*[F.col(own[c]).alias(c) for c in df.columns], at)
    met = df.join(ranked.select("_key", at), F.col(f"`{key}`").eqNullSafe(F.col("_key")))
    return met.drop("_key")


def chunk(
    df: DataFrame, size: int, order_by: Sequence[str | Column], name: str = "batch"
) -> DataFrame:
    """Number rows into batches of ``size``: adds ``pos`` and the 1-based batch."""
    indexed = dense_index(df, order_by)
    return indexed.withColumn(name, F.floor(F.col("pos") / F.lit(size)).cast("long") + F.lit(1))


def running_progress(
    log: DataFrame,
    run: str,
    seq: str,
    success: Column,
    every: int = 50,
    width: int = 100_000,
) -> DataFrame:
    """Completed, succeeded and failed so far, at every ``every``-th row and the last of a run.

    ``seq`` is the arrival number, unique in a run; it may be sparse, such as a
    time. Rows are ranked first and summed in blocks of ``width`` ranks, blocks in
    groups of ``width`` blocks, so no task holds a run; what comes before
    enters as sums.
    """
    light = log.select(F.col(f"`{run}`").alias("_run"), F.col(f"`{seq}`").alias("_seq"), F.coalesce(success.cast("int"), F.lit(0)).alias("_s"))
    ranked = dense_index(light, ["_run", "_seq"], "_pos").withColumn("_n", F.lit(1))
    # Structs as keys keep the rows without a run together.
    inner = F.struct("_run", F.floor(F.col("_pos") / F.lit(width)).alias("b"))
    outer = F.struct("_block._run", F.floor(F.col("_block.b") / F.lit(width)).alias("b"))
    rows = ranked.select("_seq", "_n", "_s", inner.alias("_block"))
    blocks = _sums(rows, "_block").withColumn("_group", outer)
    groups = _sums(blocks, "_group").withColumn("_run", F.struct("_group._run"))
    runs = groups.groupBy("_run").agg(F.sum("_n").alias("total"))
    groups = _before(groups, "_run", "_group").join(runs, "_run").select("_group", "total", "_n0", "_s0")
    inside = _before(blocks, "_group", "_block").withColumnsRenamed({"_n0": "_n1", "_s0": "_s1"})
    offsets = inside.join(groups, "_group").select(
        "_block", "total", (F.col("_n0") + F.col("_n1")).alias("_n0"), (F.col("_s0") + F.col("_s1")).alias("_s0")
    )
    so_far = Window.partitionBy("_block").orderBy("_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = (
        rows.withColumns({"_n": F.sum("_n").over(so_far), "_s": F.sum("_s").over(so_far)})
        .join(offsets, "_block")
        .select(
            F.col("_block._run").alias(run),
            F.col("_seq").alias(seq),
            (F.col("_n") + F.col("_n0")).alias("completed"),
            (F.col("_s") + F.col("_s0")).alias("success"),
            "total",
        )
    )
    return running.filter(
        (F.col("completed") % F.lit(every) == 0) | (F.col("completed") == F.col("total"))
    ).withColumn("fail", F.col("completed") - F.col("success"))


def _sums(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"))


def _before(df: DataFrame, part: str, order: str) -> DataFrame:
    """``df`` with the sums ``_n0`` and ``_s0`` of the rows before each."""
    earlier = Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.select("*", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in ("_n", "_s")])

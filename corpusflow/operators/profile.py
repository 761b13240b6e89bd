"""Counts, shares, coverage and weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions.columns import quadrant_name
from corpusflow.session import CLASS_ROW_BYTES, broadcast_if_small, stage


def quadrant_counts(df: DataFrame, include_empty: bool = False, col: str = "quadrant") -> DataFrame:
    """Rows per quadrant; with ``include_empty`` all four appear."""
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    if not include_empty:
        return counts.orderBy(col)
    counts = counts.filter(F.col(col).between(0, 3))  # four rows at most
    every = df.sparkSession.range(4).select(F.col("id").cast("int").alias(col))
    full = every.join(F.broadcast(counts), col, "left")
    return full.select(col, F.coalesce("n", F.lit(0)).alias("n")).orderBy(col)


def distribution_report(df: DataFrame, col: str = "quadrant") -> DataFrame:
    """Count, percentage and text bar for each of the four quadrants."""
    counts = quadrant_counts(df, include_empty=True, col=col)
    # Four rows: the window without a partition is harmless.
    total, top = F.sum("n").over(Window.partitionBy()), F.max("n").over(Window.partitionBy())
    sized = counts.withColumns({"_total": total, "_top": top})
    length = F.coalesce(F.floor(F.try_divide("n", "_top") * F.lit(K.BAR_LENGTH)), F.lit(0))
    return sized.select(
        col,
        quadrant_name(col).alias("name"),
        "n",
        F.coalesce(F.try_divide("n", "_total") * F.lit(100.0), F.lit(0.0)).alias("pct"),
        length.cast("int").alias("bar_length"),
        F.expr(f"repeat('█', cast(coalesce(floor(try_divide(n, _top) * {K.BAR_LENGTH}), 0) as int))").alias("bar"),
    ).orderBy(col)


def imbalance(
    df: DataFrame,
    dominant: float = K.DOMINANT_PCT,
    scarce: float = K.SCARCE_PCT,
    include_empty: bool = False,
    col: str = "quadrant",
) -> DataFrame:
    """Largest and smallest share and whether they raise the alarm.

    By default only the quadrants present count; ``include_empty`` lets an
    absent one count as 0 %.
    """
    counts = quadrant_counts(df, include_empty, col)
    shares = counts.agg(
        F.try_divide(F.max("n"), F.sum("n")).alias("_max"),
        F.try_divide(F.min("n"), F.sum("n")).alias("_min"),
    ).select((F.col("_max") * 100.0).alias("max_pct"), (F.col("_min") * 100.0).alias("min_pct"))
    alarm = (F.col("max_pct") > dominant) | (F.col("min_pct") < scarce)
    return shares.withColumn("imbalanced", F.coalesce(alarm, F.lit(False)))


def flag_imbalance(
    report: DataFrame,
    dominant: float = K.DOMINANT_PCT,
    scarce: float = K.SCARCE_PCT,
    include_empty: bool = False,
) -> DataFrame:
    """The verdict of ``imbalance`` next to the four rows of a distribution report."""
    whole = Window.partitionBy()  # four rows
    present = F.col("pct") if include_empty else F.when(F.col("n") > 0, F.col("pct"))
    alarm = (F.max(present).over(whole) > dominant) | (F.min(present).over(whole) < scarce)
    return report.withColumn("imbalanced", F.coalesce(alarm, F.lit(False)))


def status_class(
    status: Column,
    success: str = K.STATUS_SUCCESS,
    skipped: str = K.STATUS_SKIP,
    http_error: str = K.STATUS_HTTP_ERROR,
    network_error: str = K.STATUS_NETWORK_ERROR,
) -> Column:
    """Outcome of one fetch: exact match for the good ones, prefix for the errors."""
    return (
        F.when(status == success, F.lit("success"))
        .when(status == skipped, F.lit("skipped"))
        .when(status.startswith(http_error), F.lit("http_error"))
        .when(status.startswith(network_error), F.lit("network_error"))
        .otherwise(F.lit("other"))
    )


def status_rollup(log: DataFrame, status: str = "Status", **names: str) -> DataFrame:
    """One row with the number of fetches per outcome."""
    outcome = status_class(F.col(status), **names)
    kinds = ["success", "skipped", "http_error", "network_error"]
    return log.agg(
        *[F.count_if(outcome == k).alias(k) for k in kinds], F.count("*").alias("total")
    )


def batch_outcome(rows: DataFrame, batch: str, delivered: Column) -> DataFrame:
    """Delivered and empty rows per batch; a batch is ok if anything was delivered."""
    per_batch = rows.groupBy(batch).agg(
        F.count("*").alias("n_rows"), F.count_if(delivered).alias("n_valid")
    )
    return per_batch.withColumns(
        {"n_null": F.col("n_rows") - F.col("n_valid"), "ok": F.col("n_valid") > 0}
    )


def batch_summary(outcome: DataFrame) -> DataFrame:
    """Batches ok and failed over all batches."""
    return outcome.agg(
        F.count("*").alias("batches"),
        F.count_if("ok").alias("ok_batches"),
        F.count_if(~F.col("ok")).alias("failed_batches"),
    )


def coverage(
    df: DataFrame, cols: Sequence[str], features: Sequence[str] = K.FEATURE_COLS
) -> DataFrame:
    """Rows, filled values of chosen columns, and how many feature columns are there."""
    return df.agg(
        F.count("*").alias("n_rows"),
        *[
            (F.count(F.col(f"`{c}`")) if c in df.columns else F.lit(0).cast("long")).alias(f"n_{c}")
            for c in cols
        ],
    ).select(
        "*",
        F.lit(sum(f in df.columns for f in features)).alias("features_present"),
        F.lit(len(df.columns)).alias("n_columns"),
    )


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n_class"))


def class_weights(df: DataFrame, label: str, classes: int | None = None) -> DataFrame:
    """Weight n / (classes * class count) for each class.

    ``classes`` defaults to the number of classes present. Rows without a label
    are no class and are not counted.
    """
    counts = class_counts(df.filter(F.col(label).isNotNull()), label)
    whole = Window.partitionBy()  # one row per class
    k = F.count("*").over(whole) if classes is None else F.lit(classes)
    weight = F.sum("n_class").over(whole) / (k * F.col("n_class"))
    return counts.withColumn("weight", weight)


def attach_class_weights(df: DataFrame, label: str, classes: int | None = None) -> DataFrame:
    """Every row with the weight of its class; NULL for rows without a label.

    The class table is stored and counted first: the few classes of a balanced
    task are broadcast, so a class with most of the rows is not gathered anywhere.
    """
    weights = stage(class_weights(df, label, classes).select(label, "weight"), "class-weights")
    return df.join(broadcast_if_small(weights, weights.count() * CLASS_ROW_BYTES), label, "left")



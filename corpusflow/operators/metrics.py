"""Evaluation of two-axis predictions (columns y_v, y_e, p_v, p_e)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions.columns import quadrant, smooth_target


def r_squared(y: str, p: str) -> Column:
    """1 - SSres/SStot (not the squared correlation ``regr_r2``)."""
    residual = F.sum(F.pow(F.col(y) - F.col(p), F.lit(2.0)))
    spread = F.var_pop(y) * F.count(y)
    return F.lit(1.0) - F.try_divide(residual, spread)


def share_pct(hit: Column) -> Column:
    return F.avg(hit.cast("double")) * F.lit(100.0)


def same_side(y: str, p: str, cut: float = K.AXIS_CUT) -> Column:
    return (F.col(y) >= cut) == (F.col(p) >= cut)


def same_quadrant(cut: float = K.AXIS_CUT) -> Column:
    return quadrant("y_v", "y_e", cut) == quadrant("p_v", "p_e", cut)


def regression_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """R² of both axes."""
    return df.groupBy(*by).agg(
        r_squared("y_v", "p_v").alias("r2_v"), r_squared("y_e", "p_e").alias("r2_e")
    )


def accuracy(df: DataFrame, by: Sequence[str] = (), cut: float = K.AXIS_CUT) -> DataFrame:
    """Percent on the right side of each axis, and in the right quadrant."""
    return df.groupBy(*by).agg(
        share_pct(same_side("y_v", "p_v", cut)).alias("acc_v"),
        share_pct(same_side("y_e", "p_e", cut)).alias("acc_e"),
        share_pct(same_quadrant(cut)).alias("acc_4q"),
    )


def per_class_accuracy(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support of every true quadrant."""
    return (
        df.withColumn("quadrant", quadrant("y_v", "y_e"))
        .groupBy(*by, "quadrant")
        .agg(share_pct(same_quadrant()).alias("acc"), F.count("*").alias("support"))
    )


def fold_metrics(df: DataFrame, fold: str = "fold") -> DataFrame:
    """All five measures per fold in one aggregation."""
    return df.groupBy(fold).agg(
        r_squared("y_v", "p_v").alias("r2_v"),
        r_squared("y_e", "p_e").alias("r2_e"),
        share_pct(same_side("y_v", "p_v")).alias("acc_v"),
        share_pct(same_side("y_e", "p_e")).alias("acc_e"),
        share_pct(same_quadrant()).alias("acc_4q"),
    )


def fold_summary(df: DataFrame, fold: str = "fold") -> DataFrame:
    """Mean of each measure over the folds."""
    names = ["r2_v", "r2_e", "acc_v", "acc_e", "acc_4q"]
    return fold_metrics(df, fold).agg(*[F.avg(n).alias(n) for n in names])


def smoothed_loss(
    df: DataFrame,
    by: Sequence[str] = (),
    eps: float = K.SMOOTH_EPS,
    l1_weight: float = K.L1_WEIGHT,
) -> DataFrame:
    """Mean squared plus weighted mean absolute error against smoothed targets, over both axes."""
    gaps = [F.col(p) - smooth_target(y, eps) for y, p in (("y_v", "p_v"), ("y_e", "p_e"))]
    square = (F.avg(gaps[0] * gaps[0]) + F.avg(gaps[1] * gaps[1])) / F.lit(2.0)
    absolute = (F.avg(F.abs(gaps[0])) + F.avg(F.abs(gaps[1]))) / F.lit(2.0)
    return df.groupBy(*by).agg((square + F.lit(l1_weight) * absolute).alias("loss"))

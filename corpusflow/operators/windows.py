"""Sliding windows at several hop sizes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow import constants as K


def frame_size(hop: int, floor: int = K.FRAME_FLOOR, hops: int = K.FRAME_HOPS) -> int:
    """Length of a frame: four hops, but not below the floor."""
    return max(floor, hops * hop)


def multires_windows(
    df: DataFrame,
    ts: str,
    hops: Sequence[int],
    keys: Sequence[str],
    value: str,
    floor: int = K.FRAME_FLOOR,
) -> DataFrame:
    """Count, sum, average and maximum per key in sliding windows of every hop (seconds).

    The events are read once and reduced to panes of the greatest common width;
    all windows are then put together from panes, whose number does not grow
    with the events per pane.
    """
    sizes = {hop: frame_size(hop, floor) for hop in hops}
    pane = reduce(gcd, [*sizes, *sizes.values()])
    panes = df.groupBy(*keys, F.window(ts, f"{pane} seconds").start.alias("_pane")).agg(
        F.count("*").alias("_n"),
        F.count(value).alias("_filled"),
        F.sum(value).alias("_sum"),
        F.max(value).alias("_max"),
    )

    def at(hop: int) -> DataFrame:
        frame = F.window("_pane", f"{sizes[hop]} seconds", f"{hop} seconds")
        return (
            panes.groupBy(*keys, frame.alias("_w"))
            .agg(
                F.sum("_n").alias("n"),
                F.sum("_sum").alias("total"),
                F.sum("_filled").alias("_filled"),
                F.max("_max").alias("top"),
            )
            .select(
                *keys,
                F.lit(hop).alias("hop"),
                F.col("_w.start").alias("w_start"),
                F.col("_w.end").alias("w_end"),
                "n",
                "total",
                F.try_divide("total", "_filled").alias("mean"),
                "top",
            )
        )

    return reduce(DataFrame.unionByName, [at(h) for h in hops])

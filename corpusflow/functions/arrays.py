"""Functions on array columns: padding, resizing, scaling."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions.columns import _col


def pad_or_truncate(arr: Column | str, n: int, fill: Column) -> Column:
    """First ``n`` elements, filled up on the right."""
    head = F.slice(_col(arr), 1, n)
    return F.concat(head, F.array_repeat(fill, F.lit(n) - F.size(head)))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, not at every mention inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _doubles(arr: Column | str) -> Column:
    return F.transform(_col(arr), lambda x: x.cast("double"))


def resample_linear(arr: Column | str, n: int) -> Column:
    """Linear resize of a series to ``n`` points, end points kept.

    A series that already has ``n`` points comes back unchanged.
    """

    def resized(a: Column) -> Column:
        last = F.size(a) - F.lit(1)

        def point(i: Column) -> Column:
            x = i.cast("double") * last.cast("double") / F.lit(float(max(n - 1, 1)))
            lo = F.least(F.floor(x).cast("int"), last)
            left, right = F.get(a, lo), F.get(a, F.least(lo + F.lit(1), last))
            return left + (right - left) * (x - lo.cast("double"))

        points = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), point)
        return F.when(F.size(a) == F.lit(n), a).when(F.size(a) > F.lit(0), points)

    return _bind(_doubles(arr), resized)


def minmax_scale(arr: Column | str, eps: float = K.SCALE_EPS) -> Column:
    """Shift and scale one array to [0, 1)."""

    def scaled(a: Column) -> Column:
        bounds = F.struct(F.array_min(a).alias("lo"), F.array_max(a).alias("hi"))
        return _bind(
            bounds, lambda b: F.transform(a, lambda x: (x - b["lo"]) / (b["hi"] - b["lo"] + F.lit(eps)))
        )

    return _bind(_doubles(arr), scaled)


def power_to_db(arr: Column | str, floor: float = K.DB_FLOOR, db_range: float = K.DB_RANGE) -> Column:
    """Decibels relative to the array's maximum, cut off ``db_range`` below it."""

    def relative(db: Column) -> Column:
        top = F.array_max(db)
        return _bind(top, lambda t: F.transform(db, lambda x: F.greatest(x - t, F.lit(-db_range))))

    decibels = F.transform(
        _col(arr), lambda x: F.log10(F.greatest(x.cast("double"), F.lit(floor))) * F.lit(10.0)
    )
    return _bind(decibels, relative)


def blend(a: Column, b: Column, lam: Column) -> Column:
    """lam*a + (1-lam)*b element by element."""
    return F.zip_with(a, b, lambda x, y: x.cast("double") * lam + y.cast("double") * (F.lit(1.0) - lam))

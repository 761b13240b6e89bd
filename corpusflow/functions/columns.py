"""Scalar column functions: identifiers, numbers, names, URLs, two-axis classes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow import constants as K

# What a lenient number parser accepts (plain and exponent forms, infinities);
# Java's extra forms such as "1d" or "0x1p3" are not numbers here.
_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace (plain ``trim`` knows only spaces)."""
    return F.btrim(_col(c), F.lit(K.WHITESPACE))


def normalize_id(c: Column | str) -> Column:
    """Identifier as stripped text; blank and ``nan`` become NULL."""
    text = strip(_col(c).cast("string"))
    return F.when(~F.lower(text).isin("", "nan"), text)


def to_number(c: Column | str, dtype: str = "float") -> Column:
    """Text or number to ``dtype``; whatever is no number becomes NULL.

    For whole-number types a fraction is no number: it is not cut off.
    """
    text = strip(_col(c).cast("string"))
    value = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    if dtype in ("float", "double"):
        return value.try_cast(dtype)
    return F.when(value % F.lit(1.0) == F.lit(0.0), value).try_cast(dtype)


def match_key(c: Column | str) -> Column:
    """Case- and blank-insensitive comparison key; NULL compares as ``nan``."""
    return strip(F.lower(F.coalesce(_col(c).cast("string"), F.lit("nan"))))


def valid_url(c: Column | str) -> Column:
    """The stripped URL if it starts with ``http``, otherwise an empty text."""
    text = strip(c)
    return F.when(text.startswith("http"), text).otherwise(F.lit(""))


def fill_sentinel(c: Column | str, sentinel: str = K.NO_TEXT) -> Column:
    return F.coalesce(_col(c), F.lit(sentinel))




def people_names(items: Column, struct: bool = False, profile_first: bool = False) -> Column:
    """Non-empty stripped names of an array column."""

    def name_of(item: Column) -> Column:
        if not struct:
            return item
        plain, nested = F.nullif(item["name"], F.lit("")), F.nullif(item["profile"]["name"], F.lit(""))
        return F.coalesce(nested, plain) if profile_first else F.coalesce(plain, nested)

    present = F.filter(F.transform(items, name_of), lambda n: n.isNotNull() & (n != ""))
    return F.transform(present, strip)


def format_people(c: Column | str, struct: bool = False) -> Column:
    """Names joined by a comma; NULL or nothing left gives an empty text.

    ``struct=True`` for elements ``struct<name, profile: struct<name>>``.
    """
    return F.coalesce(F.array_join(people_names(_col(c), struct), ", "), F.lit(""))


def quadrant(v: Column | str, e: Column | str, cut: float = K.AXIS_CUT) -> Column:
    """0..3 from two axes: two for a high first axis plus one for a high second.

    A missing axis counts as low (Spark itself ranks NaN above all numbers).
    """
    high = []
    for axis in (v, e):
        x = F.nanvl(_col(axis).cast("double"), F.lit(None).cast("double"))
        high.append(F.coalesce(x >= F.lit(cut), F.lit(False)).cast("int"))
    return high[0] * F.lit(2) + high[1]


def quadrant_name(q: Column | str) -> Column:
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in K.QUADRANT_NAMES.items())
    return F.create_map(*pairs)[_col(q)]


def smooth_target(c: Column | str, eps: float = K.SMOOTH_EPS) -> Column:
    return _col(c) * F.lit(1 - eps) + F.lit(0.5 * eps)


def seeded_hash(key: Column | str, seed: int | str = K.SEED) -> Column:
    """48-bit non-negative number from seed and key; the same on every run and layout."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def seeded_uniform(key: Column | str, seed: int | str = K.SEED) -> Column:
    """Uniform value in [0, 1) from seed and key."""
    return seeded_hash(key, seed) / F.lit(float(2**48))

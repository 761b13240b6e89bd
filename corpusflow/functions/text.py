"""Text functions: compilation rules, tokens, tones, character n-grams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions.columns import _col, strip


def has_text(c: Column | str, sentinel: str = K.NO_TEXT) -> Column:
    """True for a text that is neither missing, blank nor the sentinel."""
    text = strip(c)
    return F.coalesce((text != "") & (text != F.lit(sentinel)), F.lit(False))


def title_matches(c: Column | str, keywords: list[str] | None = None) -> Column:
    """True if the lower-cased, then stripped title contains any keyword."""
    words = K.COMPILATION_KEYWORDS if keywords is None else keywords
    # A keyword that holds another one adds nothing.
    needed = [w for w in words if not any(o != w and o in w for o in words)]
    title = strip(F.lower(_col(c)))
    # Plain substring tests: compiled, and several times faster than one alternation.
    found = reduce(Column.__or__, [F.contains(title, F.lit(w)) for w in needed], F.lit(False))
    return F.coalesce(found, F.lit(False))


def marker_lines(c: Column | str) -> Column:
    """Number of lines that hold nothing but a bracketed title."""
    return F.coalesce(F.regexp_count(strip(c), F.lit(K.MARKER_LINE)), F.lit(0))


def many_markers(c: Column | str, least: int = K.MIN_MARKER_LINES) -> Column:
    return marker_lines(c) >= F.lit(least)


def too_long(c: Column | str, limit: int = K.MAX_TEXT_CHARS) -> Column:
    """True if the stripped text has more than ``limit`` characters."""
    return F.coalesce(F.char_length(strip(c)) > F.lit(limit), F.lit(False))


def compilation_reason(
    title: Column | str,
    text: Column | str,
    keywords: list[str] | None = None,
    sentinel: str = K.NO_TEXT,
) -> Column:
    """``title``, ``markers`` or ``length``, the first rule that holds, else NULL."""
    readable = has_text(text, sentinel)
    return (
        F.when(title_matches(title, keywords), F.lit("title"))
        .when(readable & many_markers(text), F.lit("markers"))
        .when(readable & too_long(text), F.lit("length"))
    )


def tokenize(c: Column | str, max_tokens: int | None = None) -> Column:
    """Lower-cased runs of letters, digits and underscores.

    Punctuation and combining marks separate tokens. ``max_tokens`` keeps the
    first ones only, for fixed-width encodings.
    """
    tokens = F.regexp_extract_all(F.lower(_col(c)), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return tokens if max_tokens is None else F.slice(tokens, 1, max_tokens)


def tone(token: Column | str, legacy_tone_table: bool = False) -> Column:
    """Class 0..5 of the first tone-bearing letter, 0 if there is none."""
    return _tone_of(F.lower(_col(token)), legacy_tone_table)


def _tone_of(token: Column, legacy_tone_table: bool) -> Column:
    groups = list(K.TONE_LETTERS)
    if legacy_tone_table:
        groups[3] = K.LEGACY_TONE_4
    letters = "".join(groups)
    classes = "".join(str(i) * len(g) for i, g in enumerate(groups, start=1))
    first = F.regexp_extract(token, f"[{letters}]", 0)
    # Pure ASCII tokens, the bulk of most languages, need no search.
    ascii_only = F.octet_length(token) == F.char_length(token)
    found = F.coalesce(F.translate(first, letters, classes).try_cast("int"), F.lit(0))
    return F.when(ascii_only, F.lit(0)).otherwise(found)


def tones(tokens: Column | str, legacy_tone_table: bool = False) -> Column:
    """Stored tone classes of lower-cased tokens: class + 1, as 0 is padding."""
    return F.transform(_col(tokens), lambda t: _tone_of(t, legacy_tone_table) + F.lit(1))


def letters_only(c: Column | str) -> Column:
    """Lower-cased text with every run of non-letters as one blank, blank-framed."""
    # Only plain blanks are left, so ``trim`` does.
    body = F.trim(F.regexp_replace(F.lower(_col(c)), r"[^\p{L}]+", " "))
    return F.concat(F.lit(" "), body, F.lit(" "))


def trigrams(c: Column | str) -> Column:
    """All overlapping three-character pieces, in one pass over the text."""
    # Looks three characters ahead and moves on by one whole character.
    pattern = r"(?s)(?=(...))."
    return F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(1))


def clean_lines(lines: Column | str, sentinel: str = K.NO_TEXT) -> Column:
    """Array of lines: stripped, blanks dropped, newline-joined; nothing left gives the sentinel."""
    kept = F.filter(F.transform(_col(lines), strip), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.nullif(F.array_join(kept, "\n"), F.lit("")), F.lit(sentinel))


def item_text(item: Column | str, sentinel: str = K.NO_TEXT) -> Column:
    """Text of one response item ``struct<error, lyrics: struct<lines: array<struct<words>>>>``."""
    it = _col(item)
    lines = F.transform(it["lyrics"]["lines"], lambda line: line["words"])
    failed = F.coalesce(it["error"], F.lit("")) != ""
    return F.when(failed, F.lit(sentinel)).otherwise(clean_lines(lines, sentinel))

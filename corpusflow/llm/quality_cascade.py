"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a boolean column over the text. On a bounded sample each rule's cost (time for a row) and
selectivity (share of rows it rejects) are measured; rules then stand in the order of rejection per
cost, and a row is tested until the first rule rejects it. The order decides the work, never the
verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.session import stage

# Rows on which cost and selectivity are measured.
SAMPLE_ROWS = 2_000
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Maximal runs of characters other than space and \\t to \\r; NULL has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES)), " ")
    return F.filter(parts, lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), SPACES, "")).cast("long")


def n_symbols(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.translate(x, SPACES, "") != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(text: Column, width: int = 3) -> Column:
    """Words that lie in a window of ``width`` words found twice or more in the text.

    Windows are compared by 64-bit hashes within one text. Equal windows are neighbours after
    sorting, so a text of n words takes n log n steps.
    """

    def windows(h: Column) -> Column:
        at = F.slice(h, F.lit(1), F.greatest(F.size(h) - (width - 1), F.lit(0)))
        return F.transform(at, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, width)]))

    def repeated(v: Column) -> Column:
        pairs = F.sort_array(F.transform(v, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(
            pairs,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False))
                        | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)),
                    ),
                    lambda e: e["i"],
                )
            ),
        )

    def covered(v: Column) -> Column:
        start = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            repeated(v),
            start,
            lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(width), x - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    def count(v: Column) -> Column:
        return F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(covered(v))

    hashes = F.transform(words(text), lambda w: F.xxhash64(w))
    return let(hashes, lambda h: let(windows(h), count)).cast("long")


@dataclass(frozen=True)
class Rule:
    """A name and the column that is true for rows it rejects."""

    name: str
    rejects: Column


def text_counts(text: Column) -> dict[str, Column]:
    """What the standard rules look at; each is dear enough to be worked out once a row."""
    return {
        "n_words": n_words(text),
        "word_chars": word_chars(text),
        "n_symbols": n_symbols(text),
        "n_dup_lines": n_dup_lines(text),
        "n_repeat_words": n_repeat_words(text),
        "n_lines": F.size(F.split(F.coalesce(text, F.lit("")), "\n")),
    }


def rules_on(counts: dict[str, Column]) -> list[Rule]:
    """Rejects texts with few words, much repetition, many symbols, repeated lines or odd word lengths."""
    n = counts["n_words"]
    return [
        Rule("few_words", n < 50),
        Rule("repeated_words", 100 * counts["n_repeat_words"] > 50 * n),
        Rule("symbols", 100 * counts["n_symbols"] > 30 * n),
        Rule("duplicate_lines", 100 * counts["n_dup_lines"] > 50 * counts["n_lines"]),
        Rule("word_length", let(F.struct(counts["word_chars"].alias("c"), n.alias("n")), lambda x: (x["c"] < 2 * x["n"]) | (x["c"] > 20 * x["n"]))),
    ]


def standard_rules(text: Column) -> list[Rule]:
    return rules_on(text_counts(text))


@dataclass(frozen=True)
class Measured:
    """A rule with what the sample showed: seconds a row and share of rows rejected."""

    rule: Rule
    cost: float
    selectivity: float


def measure_rules(df: DataFrame, rules: list[Rule], columns: list[str], sample_rows: int = SAMPLE_ROWS) -> list[Measured]:
    """The rules in the order in which to test them: most rejection per cost first.

    ``columns`` are those that the rules read. The sample takes ``sample_rows`` of all rows on
    average, dealt over the whole table, and is written once to the shared folder.
    """
    total = df.count()
    names = {c: f"`{c}`" for c in columns}
    sample = stage(df.select(*names.values()).sample(min(1.0, sample_rows / max(total, 1)), seed=17), "quality-sample")
    rows = max(sample.count(), 1)
    rejected = sample.agg(*[F.sum(F.coalesce(r.rejects, F.lit(False)).cast("long")).alias(f"r{i}") for i, r in enumerate(rules)]).first()

    def seconds(column: Column) -> float:
        probe = sample.agg(F.max(column))
        probe.collect()
        begun = time.perf_counter()
        probe.collect()
        return time.perf_counter() - begun

    idle = seconds(F.lit(True))
    found = [Measured(r, max(seconds(r.rejects) - idle, 1e-4) / rows, (rejected[i] or 0) / rows) for i, r in enumerate(rules)]
    return sorted(found, key=lambda m: (-m.selectivity / m.cost, m.cost, m.rule.name))


def apply_cascade(df: DataFrame, ordered: list[Rule], out: str = "rejected_by") -> DataFrame:
    """``df`` with the name of the first rule that rejects a row, NULL for rows that pass all.

    Later rules are not evaluated for a rejected row. A rule that gives NULL does not reject. A column
    already named ``out`` is replaced; an empty table stays empty.
    """
    verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        verdict = F.when(rule.rejects, F.lit(rule.name)).otherwise(verdict)
    return df.withColumn(out, verdict)


def filter_quality(df: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``df`` that pass the standard rules; NULL and empty texts have too few words."""
    ordered = [m.rule for m in measure_rules(df, standard_rules(F.col(f"`{text}`")), [text], sample_rows)]
    passed = apply_cascade(df, ordered, "_quality.rejected_by")
    return passed.where("`_quality.rejected_by` is null").drop("_quality.rejected_by")

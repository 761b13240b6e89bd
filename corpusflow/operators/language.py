"""Language profiles of character trigrams, and detection with them.

A trigram is three code points packed into one whole number. A profile is a direct-address table: the
hash of a packed trigram names a slot, the slot its few trigrams and their whole-number scores, one for
each language. So a text is scored where it stands, without a row for each trigram, a join or a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions.text import letters_only
from corpusflow.session import BROADCAST_BYTES, stage

# Share of a text's trigrams that some profile has to know, as a fraction 1 / KNOWN_PART.
KNOWN_PART = 2
# Log-probabilities are kept as whole millionths: their sums are exact and do
# not depend on the order in which tasks add them up.
SCORE_UNIT = 1_000_000
# More languages than this are a wrong column.
MAX_LANGUAGES = 256
# Whole texts go to Python in batches of bounded size and are scored by so many characters at once.
BATCH_ROWS, BATCH_BYTES, SLICE_CHARS = 1_024, 16 << 20, 1 << 18
# Bits of a code point in a packed trigram.
POINT_BITS = 21
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class LanguageProfiles:
    """Trigram scores (columns ``gram, w0, w1, …``; ``gram`` packed), one column per language."""

    languages: list[str]
    unseen: list[int]
    table: DataFrame
    size_bytes: int


class GramTable:
    """Direct-address table of packed trigrams; ``place`` gives a trigram's row, or ``len(grams)``."""

    def __init__(self, grams: np.ndarray, scores: np.ndarray, unseen: list[int]):
        self.shift = np.uint64(64 - max(1, int(2 * len(grams)).bit_length()))
        slot = self._slot(grams)
        order = np.argsort(slot, kind="stable")
        self.grams = grams[order]
        slots = 1 << (64 - int(self.shift))
        self.begin = np.searchsorted(slot[order], np.arange(slots + 1)).astype(np.int32)
        self.deepest = int(np.diff(self.begin).max(initial=0))
        # One row of scores a language; the last column is that of unknown trigrams.
        self.scores = np.concatenate([scores[order], np.array([unseen], np.int64).reshape(1, -1)]).T.copy()

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return (grams.astype(np.uint64) * _SPREAD >> self.shift).astype(np.int64)

    def place(self, grams: np.ndarray) -> np.ndarray:
        slot = self._slot(grams)
        first, size = self.begin[slot], self.begin[slot + 1] - self.begin[slot]
        found = np.full(len(grams), len(self.grams), dtype=np.int64)
        for depth in range(self.deepest):
            open_ = np.flatnonzero(size > depth)
            hit = open_[self.grams[first[open_] + depth] == grams[open_]]
            found[hit] = first[hit] + depth
        return found

    def best(self, grams: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each text (its trigrams end at ``ends``) the number of the likeliest language; -1 without evidence."""
        at = self.place(grams)
        edges = np.concatenate([[0], ends])
        of = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[edges])
        total, known = np.diff(edges), of(at < len(self.grams))
        scores = np.stack([of(own[at]) for own in self.scores])
        return np.where((total == 0) | (known * KNOWN_PART < total), -1, scores.argmax(axis=0))


def _slices(texts: list[str | None]) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= SLICE_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def packed_trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(trigrams of all texts, where those of each text end)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    counts = np.maximum(sizes - 2, 0)
    at = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    grams = points[at] << 2 * POINT_BITS | points[at + 1] << POINT_BITS | points[at + 2] if len(at) else at
    return grams, np.cumsum(counts)


def _letters(text: Column, sample_chars: int | None) -> Column:
    return letters_only(text if sample_chars is None else F.substring(text, 1, sample_chars))


def _bound_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of bounded size: the default of 10,000 rows is made for numbers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _score(count: Column, size: Column) -> Column:
    return F.round(F.log((count + F.lit(1)) / size) * F.lit(SCORE_UNIT)).cast("long")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For Spark: how often each trigram stands in the texts of a language, slice by slice."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        texts = batch.column(1).to_pylist()
        for lang in dict.fromkeys(langs.tolist()):
            for part in _slices([texts[i] for i in np.flatnonzero(langs == lang)]):
                grams, counts = np.unique(packed_trigrams(part)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], names=["lang", "gram", "n"])


def fit_language_profiles(
    labelled: DataFrame, text: str, lang: str, sample_chars: int | None = None
) -> LanguageProfiles:
    """Add-one smoothed trigram log-probabilities of every language in ``labelled``.

    The result is a stored table of distinct trigrams; tasks count their own texts, and only counts are
    shuffled. The list of languages and one total per language pass the driver; more than
    ``MAX_LANGUAGES`` of them are an error.
    """
    _bound_batches(labelled.sparkSession)
    rows = labelled.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), _letters(F.col(text), sample_chars).alias("text"))
    counted = rows.mapInArrow(_count, "lang string, gram long, n long")
    counts = stage(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "trigrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"{lang} has more than {MAX_LANGUAGES} values")
    distinct = counts.select("gram").distinct().count()
    languages = [r["lang"] for r in totals]
    sizes = [F.lit(float(r["n"] + distinct)) for r in totals]
    scores = [
        _score(F.sum(F.when(F.col("lang") == l, F.col("n")).otherwise(F.lit(0))), s).alias(f"w{i}")
        for i, (l, s) in enumerate(zip(languages, sizes))
    ]
    wide = counts.groupBy("gram").agg(*scores) if scores else counts.select("gram")
    unseen = labelled.sparkSession.range(1).select(*[_score(F.lit(0), s) for s in sizes]).first()
    table = stage(wide, "language-profiles")
    # A trigram, its slots, and one 8-byte score per language.
    size = distinct * (24 + 8 * len(languages))
    return LanguageProfiles(languages, list(unseen or []), table, size)


def language_column(text: Column, profiles: LanguageProfiles, sample_chars: int | None = None) -> Column:
    """The language of a text, worked out in its own row; see ``detect_language``.

    Takes profiles within the broadcast limit; ``with_language`` takes all.
    """
    spark = profiles.table.sparkSession
    _bound_batches(spark)
    found = profiles.table.toArrow()
    columns = [found[f"w{i}"].to_numpy() for i in range(len(profiles.languages))]
    scores = np.stack(columns, axis=1) if columns else np.zeros((0, 0), np.int64)
    shared = spark.sparkContext.broadcast(GramTable(found["gram"].to_numpy(), scores, profiles.unseen) if columns else None)

    @F.arrow_udf("int")
    def best(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [np.zeros(0, np.int64)]
            for part in _slices(batch.to_pylist()):
                known = shared.value
                parts.append(known.best(*packed_trigrams(part)) if known else np.full(len(part), -1))
            yield pa.array(np.concatenate(parts).astype(np.int32))

    names = F.array(*map(F.lit, profiles.languages)).cast("array<string>")
    return F.coalesce(F.get(names, best(_letters(text, sample_chars))), F.lit(K.UNKNOWN_LANGUAGE))


def detect_language(
    df: DataFrame,
    key: str,
    text: str,
    profiles: LanguageProfiles,
    sample_chars: int | None = None,
    name: str = "language",
) -> DataFrame:
    """(key, language) of every row: the language under which the text is most likely.

    Ties go to the first code. A text without letters, or just a note mark, is
    ``unknown``, and so is one of whose trigrams no profile knows half: in a
    script or language that was not taught there is no evidence for any. The whole text counts unless ``sample_chars`` says otherwise.
    Profiles within the broadcast limit go to every task, and each row is settled
    where it stands. Larger profiles are met by a shuffled join of (text, trigram) counts.
    """
    return with_language(df.select(key, text), text, profiles, sample_chars, name).select(key, name)


def with_language(
    df: DataFrame, text: str, profiles: LanguageProfiles, sample_chars: int | None = None, name: str = "language"
) -> DataFrame:
    """``df`` with the language of each row's text (see ``detect_language``), in a new or replaced column."""
    if profiles.size_bytes <= BROADCAST_BYTES:
        return df.withColumn(name, language_column(F.col(text), profiles, sample_chars))
    _bound_batches(df.sparkSession)
    # Rows of one text are one text here; without a text there is nothing to look up.
    rows = df.withColumn("_text", _letters(F.col(text), sample_chars)).withColumn("_digest", F.md5("_text"))
    texts = rows.select("_digest", "_text").where("_text is not null").dropDuplicates(["_digest"])

    @F.arrow_udf("array<struct<gram:bigint,n:bigint>>")
    def grams(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for text in batch.to_pylist():
                found, n = np.unique(packed_trigrams([text])[0], return_counts=True)
                out.append([{"gram": g, "n": k} for g, k in zip(found.tolist(), n.tolist())])
            yield pa.array(out, pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())])))

    weights = [f"w{i}" for i in range(len(profiles.languages))]
    pieces = texts.select("_digest", F.explode(grams("_text")).alias("g")).select("_digest", "g.gram", "g.n")
    scored = pieces.join(profiles.table, "gram", "left")
    sums = scored.groupBy("_digest").agg(
        F.sum("n").alias("_grams"),
        F.sum(F.when(F.col(weights[0]).isNotNull(), F.col("n")).otherwise(F.lit(0))).alias("_known"),
        *[F.sum(F.coalesce(w, F.lit(u)) * F.col("n")).alias(w) for w, u in zip(weights, profiles.unseen)],
    )
    best = F.greatest(*weights) if len(weights) > 1 else F.col(weights[0])
    choice = F.when(F.col("_known") * KNOWN_PART < F.col("_grams"), F.lit(K.UNKNOWN_LANGUAGE))
    for w, language in zip(weights, profiles.languages):
        choice = choice.when(F.col(w) == best, F.lit(language))
    found = sums.select("_digest", choice.alias("_language"))
    met = rows.drop(name).join(found, "_digest", "left")
    return met.withColumn(name, F.coalesce("_language", F.lit(K.UNKNOWN_LANGUAGE))).drop("_digest", "_text", "_language")

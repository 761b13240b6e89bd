"""Languages of texts and of the spans of mixed-language texts.

The script of a word narrows the languages it can be in. Each language that is left scores the word by
its character n-grams; the best path through a text's words, where each change of language costs a
penalty (Viterbi), labels its spans. The text's language is that of most of its letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.bpe import spans
from corpusflow.llm.pretokens import mix, powers
from corpusflow.llm.slices import bound_batches, slices
from corpusflow.session import stage

# Labelled texts of each language that the model is fitted on, on average, dealt over the whole table.
FIT_ROWS = 2_000
# Languages a model can have; a table with more values in its label column is refused.
MAX_LANGUAGES = 256
# Hash buckets of character n-grams (the table has 4 bytes for each bucket and language).
BUCKET_BITS = 16
# Cost of a change of language between two words, in nats.
SWITCH_PENALTY = 6.0
# Share of a language's letters in a script from which the language is a candidate there.
SCRIPT_SHARE = 0.01
# Words of a block: blocks of all texts are worked on side by side.
BLOCK = 64

# First and last code point of scripts.
SCRIPTS = [
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F),
    ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF),
    ("gurmukhi", 0xA00, 0xA7F), ("gujarati", 0xA80, 0xAFF), ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F),
    ("kannada", 0xC80, 0xCFF), ("malayalam", 0xD00, 0xD7F), ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF), ("han", 0x20000, 0x2FA1F),
]
SCRIPT_NAMES = ["other", *sorted({name for name, _, _ in SCRIPTS})]
_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MARK = 0x20


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Is a code point part of a word, is it a letter, and its lower-case form."""
    import unicodedata

    alone = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    inside = alone | np.fromiter((unicodedata.category(chr(c))[0] == "M" for c in range(0x110000)), dtype=bool, count=0x110000)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x20000):
        form = chr(c).lower()
        if len(form) == 1:
            lower[c] = ord(form)
    return inside, alone, lower


def script_of(points: np.ndarray) -> np.ndarray:
    """Number (in ``SCRIPT_NAMES``) of the script of each code point."""
    at = np.searchsorted([s for _, s, _ in SCRIPTS], points, side="right") - 1
    ends = np.array([e for _, _, e in SCRIPTS])
    names = np.array([SCRIPT_NAMES.index(n) for n, _, _ in SCRIPTS])
    return np.where((at >= 0) & (points <= ends[at]), names[at], 0)


@dataclass
class LetterWords:
    """Runs of letters of texts in lower case: code points, bounds, hashes, each text's first word and first point."""

    points: np.ndarray
    start: np.ndarray
    end: np.ndarray
    key: np.ndarray
    first: np.ndarray
    edges: np.ndarray


def letter_words(texts: list[str]) -> LetterWords:
    """Runs of letters and marks with a letter in them: a mark alone is no word."""
    inside, alone, lower = _tables()
    raw = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    points, letter = lower[raw], inside[raw]
    before = np.concatenate([[False], letter[:-1]])
    start, end = np.flatnonzero(letter & ~before), np.flatnonzero(~letter & before)
    letters = np.concatenate([[0], np.cumsum(alone[raw])])
    real = letters[end] > letters[start]
    start, end = start[real], end[real]
    sums = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum(mix(points + np.uint64(1)) * powers(len(points), _BASE)[:-1], out=sums[1:])
    key = mix((sums[end] - sums[start]) * powers(len(points), _INVERSE)[start] + (end - start).astype(np.uint64))
    return LetterWords(points, start, end, key, np.searchsorted(start, edges), edges)


def _ngrams(words: LetterWords, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 2- and 3-grams of the chosen words with marks at both ends, and where each word's begin."""
    sizes = words.end[which] - words.start[which]
    held = np.full(int((sizes + 2).sum()), MARK, dtype=np.uint64)
    begins = np.cumsum(sizes + 2) - (sizes + 2)
    held[spans(begins + 1, sizes)] = words.points[spans(words.start[which], sizes)]
    two, three = spans(begins, sizes + 1), spans(begins, sizes)
    low = mix(held[two] << np.uint64(21) | held[two + 1])
    high = mix((held[three] << np.uint64(42) | held[three + 1] << np.uint64(21) | held[three + 2]) + np.uint64(1 << 63))
    starts = np.cumsum(2 * sizes + 1) - (2 * sizes + 1)
    out = np.zeros(int((2 * sizes + 1).sum()), dtype=np.int64)
    shift = np.uint64(64 - BUCKET_BITS)
    out[spans(starts, sizes + 1)] = low >> shift
    out[spans(starts + sizes + 1, sizes)] = high >> shift
    return out, starts


@dataclass
class LanguageModel:
    """Languages in alphabetical order, log-probabilities (bucket, language), candidates (script, language)."""

    languages: list[str]
    table: np.ndarray
    candidates: np.ndarray

    def word_scores(self, words: LetterWords) -> tuple[np.ndarray, np.ndarray]:
        """Score of each word in each language, and whether any language is a candidate for it."""
        keys, at, back = np.unique(words.key, return_index=True, return_inverse=True)
        if not len(keys):
            return np.zeros((0, len(self.languages)), np.float32), np.zeros(0, bool)
        buckets, starts = _ngrams(words, at)
        scores = np.add.reduceat(self.table[buckets], starts, axis=0)
        allowed = self.candidates[script_of(words.points[words.start[at]])]
        some = allowed.any(axis=1)
        scores = scores - scores.max(axis=1, keepdims=True)
        scores[~allowed] -= 50.0
        scores[~some] = 0.0
        return scores[back].astype(np.float32), some[back]


def best_path(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Language of every word on each text's best path; ``first`` bounds the words of the texts.

    Texts are cut into blocks. For each block the best score from every language before it to every
    language at its end is found, for all blocks at once; the blocks of a text are chained; then the
    path within each block is read off between its known ends.
    """
    n, width = scores.shape
    out = np.zeros(n, dtype=np.int64)
    counts = np.diff(first)
    blocks = -(-counts // BLOCK)
    if not blocks.sum():
        return out
    chain = np.cumsum(blocks) - blocks
    begin = spans(first[:-1], np.ones_like(counts)).repeat(blocks) + spans(np.zeros_like(blocks), blocks) * BLOCK
    size = np.minimum(BLOCK, np.repeat(first[1:], blocks) - begin)

    best = np.where(np.eye(width, dtype=bool), 0.0, -penalty).astype(np.float32)[None].repeat(len(begin), axis=0)
    for t in range(BLOCK):
        on = size > t
        if t:
            best = np.maximum(best, best.max(axis=2, keepdims=True) - penalty)
        step = scores[np.where(on, begin + t, 0)]
        step[~on] = 0.0
        if t and not on.all():
            # Blocks that have ended must not change any more: their last values are kept.
            best = np.where(on[:, None, None], best, kept)
        best = best + step[:, None, :]
        kept = best
    texts = np.flatnonzero(blocks)
    texts = texts[np.argsort(-blocks[texts], kind="stable")]
    reach = np.zeros((len(texts), width), dtype=np.float64)
    came = np.zeros((len(begin), width), dtype=np.int64)
    for k in range(int(blocks.max())):
        live = int((blocks[texts] > k).sum())
        at = chain[texts[:live]] + k
        through = reach[:live, :, None] + best[at]
        came[at] = through.argmax(axis=1)
        reach[:live] = through.max(axis=1)
    enter, leave = np.zeros(len(begin), dtype=np.int64), np.zeros(len(begin), dtype=np.int64)
    state = reach.argmax(axis=1)
    for k in range(int(blocks.max()) - 1, -1, -1):
        live = int((blocks[texts] > k).sum())
        at = chain[texts[:live]] + k
        leave[at] = state[:live]
        state[:live] = came[at, state[:live]]
        enter[at] = state[:live]

    score = np.full((len(begin), width), -penalty, dtype=np.float32)
    score[np.arange(len(begin)), enter] = 0.0
    source = np.zeros((BLOCK, len(begin), width), dtype=np.uint8 if width <= 256 else np.int32)
    own = np.arange(width)
    for t in range(BLOCK):
        on = (size > t)[:, None]
        if t:
            top = score.argmax(axis=1)[:, None]
            switched = np.take_along_axis(score, top, axis=1) - penalty
            change = (switched > score) & on
            source[t] = np.where(change, top, own)
            score = np.where(change, switched, score)
        score = score + np.where(on, scores[np.where(on[:, 0], begin + t, 0)], 0.0)
    now = leave
    for t in range(BLOCK - 1, -1, -1):
        on = size > t
        out[begin[on] + t] = now[on]
        if t:
            now = np.where(on, source[t][np.arange(len(begin)), now], now)
    return out


def fit_model(df: DataFrame, text: str, label: str, rows: int = FIT_ROWS) -> LanguageModel:
    """A model from labelled texts; NULL labels and texts are left out.

    The different texts of each label are counted over all rows, then each language gives ``rows`` of them
    on average, chosen by a hash of the text, and all if it has no more. Copies count once. More than ``MAX_LANGUAGES`` labels are an error, not cut off.
    """
    named = df.select(F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").cast("string").alias("lang")).where("text is not null and lang is not null")
    distinct = named.select("lang", F.xxhash64("text").alias("h")).distinct()
    sizes = {r["lang"]: r["n"] for r in distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"{label} has more than {MAX_LANGUAGES} values")
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))
    share = F.element_at(F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, rows / sizes[lang]))]), F.col("lang"))
    chosen = named.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share * (1 << 20))
    # Copies fall together under the hash: one of each keeps the sample within its bound.
    drawn = stage(chosen.dropDuplicates(), "language-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                grams, scripts = held.setdefault(lang, (np.zeros(1 << BUCKET_BITS, np.int64), np.zeros(len(SCRIPT_NAMES), np.int64)))
                for part in slices(t for t, own in zip(texts, langs) if own == lang):
                    words = letter_words(part)
                    grams += np.bincount(_ngrams(words, np.arange(len(words.key)))[0], minlength=len(grams))
                    scripts += np.bincount(script_of(words.points[words.start]), weights=words.end - words.start, minlength=len(scripts)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), *(pa.array([x[k].tobytes() for x in held.values()], pa.binary()) for k in (0, 1))],
            names=["lang", "grams", "scripts"],
        )

    grams = np.zeros((1 << BUCKET_BITS, len(languages)))
    scripts = np.zeros((len(SCRIPT_NAMES), len(languages)))
    # The sample is bounded, and all of a language comes to one task: one row a language comes back.
    for row in drawn.repartition("lang").mapInArrow(count, "lang string, grams binary, scripts binary").collect():
        k = languages.index(row["lang"])
        grams[:, k] += np.frombuffer(row["grams"], dtype=np.int64)
        scripts[:, k] += np.frombuffer(row["scripts"], dtype=np.int64)
    table = np.log(grams + 0.5) - np.log(grams.sum(axis=0) + 0.5 * len(grams))
    shares = scripts / np.maximum(scripts.sum(axis=0), 1)
    return LanguageModel(languages, table.astype(np.float32), shares >= SCRIPT_SHARE)


LANGUAGE = "lang string, score double, spans array<struct<begin:int,end:int,lang:string>>"


def language_column(df: DataFrame, text: Column, model: LanguageModel, penalty: float = SWITCH_PENALTY) -> Column:
    """A struct with ``lang``, ``score`` and ``spans`` of a text column.

    ``lang`` is the language of most letters (``und`` for NULL, for texts without a letter, and if the
    model has no language); ties go to the first in the alphabet. ``score`` is the share of letters in
    words of that language, words in scripts of no language left out of them. ``spans`` are the runs of
    words of one language: first code point, end, language.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))])

    def label(texts: list[str]) -> pa.Array:
        found = shared.value
        width = len(found.languages)
        words = letter_words(texts)
        none = np.diff(words.first) == 0
        if not width:
            none[:] = True
        if none.all():
            langs, shares, cuts, labels = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(0, int), np.zeros(0, int)
            firsts = np.zeros(len(texts) + 1, int)
        else:
            scores, some = found.word_scores(words)
            labels = best_path(scores, words.first, penalty)
            owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
            letters = (words.end - words.start).astype(float)
            by = np.bincount(owner * width + labels, weights=letters * some, minlength=len(texts) * width).reshape(-1, width)
            langs = by.argmax(axis=1)
            shares = by.max(axis=1) / np.maximum(np.bincount(owner, weights=letters, minlength=len(texts)), 1)
            change = np.ones(len(labels), dtype=bool)
            change[1:] = (labels[1:] != labels[:-1]) | (owner[1:] != owner[:-1])
            cuts = np.flatnonzero(change)
            firsts = np.searchsorted(cuts, words.first)
        names = np.array([*found.languages, "und"], dtype=object)
        last = np.append(cuts[1:], len(labels))[: len(cuts)] - 1
        base = np.repeat(words.edges[:-1], np.diff(firsts))
        runs = pa.StructArray.from_arrays(
            [pa.array(words.start[cuts] - base, pa.int32()), pa.array(words.end[last] - base, pa.int32()), pa.array(names[labels[cuts]], pa.string())],
            names=["begin", "end", "lang"],
        )
        lists = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), runs)
        chosen = pa.array(names[np.where(none, width, langs)], pa.string())
        return pa.StructArray.from_arrays([chosen, pa.array(np.where(none, 0.0, shares)), lists], fields=list(kind))

    @F.arrow_udf(f"struct<{', '.join(x.replace(' ', ':', 1) for x in LANGUAGE.split(', '))}>")
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [label(part) for part in slices(batch.to_pylist())]
            yield pa.concat_arrays([pa.array([], kind), *parts])

    return identify(text)


def identify_languages(df: DataFrame, model: LanguageModel, text: str = "text", out: str = "language", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``df`` with a struct ``out`` (see ``language_column``); a column of that name is replaced.

    One row in, one row out, without a shuffle; an empty table stays empty.
    """
    bound_batches(df.sparkSession)
    return df.withColumn(out, language_column(df, F.col(f"`{text}`"), model, penalty))


def fold(doc: Column, folds: int) -> Column:
    """crc32 of an id's text modulo ``folds``; NULL for NULL."""
    return F.crc32(doc.cast("string").cast("binary")) % folds

"""Token counts, vocabulary and fixed-width encodings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow import constants as K
from corpusflow.functions.arrays import pad_or_truncate
from corpusflow.functions.text import tokenize, tone, tones
from corpusflow.operators.index import dense_index
from corpusflow.session import BROADCAST_BYTES, broadcast_if_small, stage

# Tokens of a vocabulary that rows look up where they stand: 16 bytes each in every worker.
LOOKUP_TOKENS = 4_000_000
# Tokens of a larger vocabulary that are broadcast.
HEAD_TOKENS = 1_000_000
# Rows of hashed tokens that go to Python at once, and bytes.
BATCH_ROWS, BATCH_BYTES = 1_024, 16 << 20

_POS_SLOTS = 10_000_000_000  # more than the tokens one text can have
_NO_KEY = str(-(1 << 63) - 1)  # before every long


def token_frequency(df: DataFrame, text: str, max_tokens: int | None = None) -> DataFrame:
    """Occurrences of every token in the corpus."""
    tokens = df.select(F.explode(tokenize(text, max_tokens)).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("freq"))


def _numbered(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``_doc``: the key, or its place among all keys where it is no whole number."""
    if isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return df.withColumn("_doc", F.col(key).cast("long"))
    places = dense_index(df.select(F.col(key).alias("_key")).distinct(), ["_key"], "_doc")
    return df.join(places, F.col(key).eqNullSafe(F.col("_key")))


def build_vocab(
    df: DataFrame,
    key: str,
    text: str,
    min_freq: int = K.MIN_TOKEN_FREQ,
    max_tokens: int | None = None,
) -> DataFrame:
    """(token, token_id, freq) of tokens seen ``min_freq`` times or more.

    Identifiers start at 2 in order of first occurrence by (``key``, position);
    0 is padding and 1 the unknown token. ``max_tokens`` counts only the first
    tokens of each text, as a fixed-width encoding sees them.

    Document and position are packed into one decimal, whose minimum a hash
    aggregate keeps in place; a struct, or a text as key, would make Spark sort
    all tokens. Keys that are no whole numbers are therefore numbered first.
    """
    numbered = _numbered(df.select(key, text), key)
    tokens = numbered.select("_doc", F.posexplode(tokenize(text, max_tokens)).alias("_pos", "token"))
    slots = F.lit(_POS_SLOTS).cast("decimal(11,0)")
    # A row without a key comes first.
    doc = F.coalesce(F.col("_doc").cast("decimal(20,0)"), F.lit(_NO_KEY).cast("decimal(20,0)"))
    place = (doc * slots + F.col("_pos").cast("decimal(10,0)")).cast("decimal(38,0)")
    counted = (
        tokens.groupBy("token")
        .agg(F.count("*").alias("freq"), F.min(place).alias("_first"))
        .filter(F.col("freq") >= min_freq)
    )
    placed = dense_index(counted, ["_first", "token"], "_index")
    return placed.select("token", (F.col("_index") + F.lit(K.FIRST_TOKEN_ID)).alias("token_id"), "freq")


def with_reserved(vocab: DataFrame) -> DataFrame:
    """The vocabulary with its padding and unknown entries, as it is stored with a model."""
    reserved = vocab.sparkSession.createDataFrame(
        [("<PAD>", K.PAD_ID, 0), ("<UNK>", K.UNKNOWN_ID, 0)], vocab.schema
    )
    return reserved.unionByName(vocab)


def _with_ids(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Tokens with their identifiers; unknown ones have NULL.

    A vocabulary within the broadcast limit goes to every task. Of a larger one
    its most frequent part does: that settles nearly all tokens, the hot ones
    among them, and only the rest is shuffled to the remaining vocabulary.
    """
    words = vocab.select("token", "token_id", "freq")
    if _vocab_bytes(words) <= BROADCAST_BYTES:
        return tokens.join(F.broadcast(words.drop("freq")), "token", "left")
    head = stage(words.orderBy(F.desc("freq"), "token").limit(HEAD_TOKENS), "vocabulary-head")
    frequent = broadcast_if_small(head.drop("freq"), _vocab_bytes(head))
    settled = tokens.join(frequent, "token")
    # NULL tokens (empty texts) match nothing and pass the anti-join.
    rest = tokens.join(frequent.select("token"), "token", "left_anti")
    return settled.unionByName(rest.join(words.drop("freq"), "token", "left"))


def _vocab_bytes(words: DataFrame) -> int:
    row = words.agg(F.count("*").alias("n"), F.sum(F.octet_length("token")).alias("b")).first()
    return (row["b"] or 0) + 64 * row["n"] if row else 0


def encode(
    df: DataFrame,
    key: str,
    text: str,
    vocab: DataFrame,
    length: int = K.ENCODED_LENGTH,
    legacy_tone_table: bool = False,
) -> DataFrame:
    """(key, ids, tones): two arrays of exactly ``length`` integers per row.

    The first window of a text, which is the shape of a fixed-width model;
    ``encode_windows`` has all of them. ``key`` has to be unique. Pass a stored
    vocabulary, as it is measured first.
    """
    lookup = _lookup(vocab)
    if lookup is None:
        tokens = df.select(F.col(key), F.posexplode_outer(tokenize(text, length)).alias("_pos", "token"))
        return _padded(tokens, [key], vocab, length, legacy_tone_table)
    pad = F.lit(K.PAD_ID)
    return _looked_up(df.select(key, text), text, lookup, length, legacy_tone_table).select(
        key,
        pad_or_truncate("_ids", length, pad.cast("long")).alias("ids"),
        pad_or_truncate("_tones", length, pad).alias("tones"),
    )


def encode_windows(
    df: DataFrame,
    key: str,
    text: str,
    vocab: DataFrame,
    length: int = K.ENCODED_LENGTH,
    legacy_tone_table: bool = False,
) -> DataFrame:
    """(key, part, ids, tones): the whole text in windows of ``length`` tokens, one after the other.

    Part 0 is the row of ``encode``; the last window is padded; a text without
    tokens is one window of padding. Each row looks its tokens up where it
    stands and its arrays are cut into windows, so no token is shuffled; with a
    vocabulary of more than ``LOOKUP_TOKENS`` tokens they are joined instead, and
    a window, not a text, is what a task collects.
    """
    lookup = _lookup(vocab)
    if lookup is None:
        tokens = df.select(F.col(key), F.posexplode_outer(tokenize(text)).alias("_pos", "token"))
        part = F.coalesce(F.floor(F.col("_pos") / F.lit(length)), F.lit(0)).cast("long")
        return _padded(tokens.withColumn("part", part), [key, "part"], vocab, length, legacy_tone_table)
    pad = F.lit(K.PAD_ID)
    rows = _looked_up(df.select(key, text), text, lookup, None, legacy_tone_table)
    last = F.greatest(F.floor((F.size("_ids") - F.lit(1)) / F.lit(length)), F.lit(0)).cast("int")
    begin = F.col("_part") * F.lit(length) + F.lit(1)
    return rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("_part")).select(
        key,
        F.col("_part").cast("long").alias("part"),
        pad_or_truncate(F.slice("_ids", begin, F.lit(length)), length, pad.cast("long")).alias("ids"),
        pad_or_truncate(F.slice("_tones", begin, F.lit(length)), length, pad).alias("tones"),
    )


def _lookup(vocab: DataFrame):
    """A column function from hashed tokens to their identifiers, or None for a vocabulary beyond ``LOOKUP_TOKENS``.

    Tokens are told apart by 64-bit hashes, sorted; two tokens of the vocabulary
    that share a hash also give None.
    """
    if vocab.count() > LOOKUP_TOKENS:
        return None
    spark = vocab.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    found = vocab.select(F.xxhash64("token").alias("h"), F.col("token_id").cast("long")).toArrow()
    hashes, ids = found["h"].to_numpy(), found["token_id"].to_numpy()
    order = np.argsort(hashes, kind="stable")
    hashes, ids = hashes[order], ids[order]
    if (hashes[1:] == hashes[:-1]).any():
        return None
    shared = spark.sparkContext.broadcast((hashes, ids))

    @F.arrow_udf("array<bigint>")
    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, named = shared.value
        for batch in batches:
            wanted = batch.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
            out = np.full(len(wanted), K.UNKNOWN_ID, np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                out = np.where(known[at] == wanted, named[at], out)
            sizes = np.array(batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
            edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(edges), pa.array(out))

    return look_up


def _looked_up(df: DataFrame, text: str, lookup, max_tokens: int | None, legacy_tone_table: bool) -> DataFrame:
    """``df`` with ``_ids`` and ``_tones`` of each text's tokens; a NULL text has none."""
    tokens = F.coalesce(tokenize(text, max_tokens), F.array().cast("array<string>"))
    split = df.withColumn("_tokens", tokens).drop(text)
    return split.select(
        "*",
        lookup(F.transform("_tokens", lambda t: F.xxhash64(t))).alias("_ids"),
        tones("_tokens", legacy_tone_table).alias("_tones"),
    ).drop("_tokens")


def _padded(tokens: DataFrame, keys: list[str], vocab: DataFrame, length: int, legacy_tone_table: bool) -> DataFrame:
    token_id = F.coalesce(F.col("token_id").cast("long"), F.lit(K.UNKNOWN_ID).cast("long"))
    marked = _with_ids(tokens, vocab).select(
        *keys,
        F.when(
            F.col("_pos").isNotNull(),
            F.struct(
                "_pos",
                token_id.alias("id"),
                (tone("token", legacy_tone_table) + F.lit(1)).alias("tone"),
            ),
        ).alias("_item"),
    )
    rows = marked.groupBy(*keys).agg(F.array_sort(F.collect_list("_item")).alias("_items"))
    pad = F.lit(K.PAD_ID)
    return rows.select(
        *keys,
        pad_or_truncate(F.col("_items.id"), length, pad.cast("long")).alias("ids"),
        pad_or_truncate(F.col("_items.tone"), length, pad).alias("tones"),
    )


def stored_vocab(
    df: DataFrame,
    key: str,
    text: str,
    min_freq: int = K.MIN_TOKEN_FREQ,
    max_tokens: int | None = None,
) -> DataFrame:
    """The vocabulary written once to the shared folder, ready for joins."""
    return stage(build_vocab(df, key, text, min_freq, max_tokens), "vocabulary")

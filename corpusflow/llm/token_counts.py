"""Token counts by a two-tier lookup on the map side.

Tier one is a table of the corpus's frequent pre-tokens with their token counts, found by one pass
over all texts and broadcast. Tier two is each worker's own cache: what it misses is encoded once by
the tokenizer library and remembered. No occurrence of a pre-token is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.pretokens import ByteLevel, Known
from corpusflow.llm.slices import bound_batches, slices

# Rows of the broadcast table; one row has a 64-bit key and a count, so it has 256 KB at most.
TABLE_ROWS = 16_384
# Rows that one task adds to the merge of the frequent pre-tokens, and what it counts at once.
TASK_ROWS = 4_096
TASK_HELD = 1 << 19
# Pre-tokens that a worker's cache holds before it is emptied (16 bytes each).
CACHE_ROWS = 1 << 20
# A longer pre-token is not put into the table.
TABLE_CHARS = 64

_WORKER: dict[str, object] = {}


def _byte_level(path: str) -> ByteLevel:
    if path not in _WORKER:
        _WORKER[path] = ByteLevel(path)
    return _WORKER[path]


def _lengths(path: str, words: list[str]) -> np.ndarray:
    """Token counts of pre-tokens, by the library."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    name = f"library {path}"
    if name not in _WORKER:
        tokenizer = _WORKER[name] = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
    found = _WORKER[name].encode_batch_fast(words, add_special_tokens=False)
    return np.fromiter((len(x) for x in found), dtype=np.int64, count=len(words))


def frequent_pretokens(df: DataFrame, text: str, path: str, rows: int = TABLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Keys and token counts of the ``rows`` most frequent pre-tokens of all texts.

    Each task counts its own pre-tokens (dropping the rarest whenever it holds ``TASK_HELD``) and
    adds ``TASK_ROWS`` of them to the merge. The table decides only the speed: a pre-token that is
    not in it is counted all the same.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = _byte_level(path)
        keys, counts, words = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, object)

        def top(limit: int):
            order = np.argsort(-counts, kind="stable")[:limit]
            order = np.sort(order)
            return keys[order], counts[order], words[order]

        for batch in batches:
            for part in slices(batch.column(0).to_pylist()):
                pre = level.split(part)
                new, at, n = np.unique(pre.key, return_index=True, return_counts=True)
                place = np.minimum(np.searchsorted(keys, new), max(len(keys) - 1, 0))
                old = keys[place] == new if len(keys) else np.zeros(len(new), bool)
                counts[place[old]] += n[old]
                fresh = ~old & (n > 1)  # a word seen once in a slice can wait for its next slice
                spell = np.empty(int(fresh.sum()), dtype=object)
                spell[:] = [pre.text(i) for i in at[fresh]]
                keys, counts, words = (np.concatenate(x) for x in ((keys, new[fresh]), (counts, n[fresh]), (words, spell)))
                order = np.argsort(keys, kind="stable")
                keys, counts, words = keys[order], counts[order], words[order]
                if len(keys) > TASK_HELD:
                    keys, counts, words = top(TASK_HELD // 2)
        keys, counts, words = top(TASK_ROWS)
        keep = np.array([len(w) <= TABLE_CHARS for w in words], dtype=bool)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, k in zip(words, keep) if k], pa.string()), pa.array(counts[keep], pa.int64())],
            names=["word", "n"],
        )

    found = (
        df.select(F.col(f"`{text}`").alias("text"))
        .where("text is not null and text != ''")
        .mapInArrow(count, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(rows)
        .select("word")
        .collect()
    )
    words = [r.word for r in found]
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    level = _byte_level(path)
    keys = np.concatenate([level.split([w]).key for w in words])
    order = np.argsort(keys)
    return keys[order], _lengths(path, words)[order]


def token_count_column(df: DataFrame, text: str, path: str, rows: int = TABLE_ROWS):
    """A column with the token count of ``text``.

    Counts are those of the tokenizer library without added special tokens, truncation or padding;
    special strings inside a text count as the special token. NULL and empty texts count 0.
    """
    table = df.sparkSession.sparkContext.broadcast(frequent_pretokens(df, text, path, rows))

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        level, cache = _byte_level(path), Known(CACHE_ROWS)
        frequent = Known(rows)
        frequent.keys, frequent.values = table.value
        for batch in batches:
            totals = [np.zeros(0, np.int64)]
            for part in slices(batch.to_pylist()):
                pre = level.split(part)
                keys, at, back = np.unique(pre.key, return_index=True, return_inverse=True)
                size, known = frequent.find(keys)
                cached, hit = cache.find(keys)
                size = np.where(known, size, cached)
                miss = np.flatnonzero(~known & ~hit)
                if len(miss):
                    size[miss] = _lengths(path, [pre.text(i) for i in at[miss]])
                    if len(cache.keys) + len(miss) > cache.bound:
                        cache.clear()
                    cache.add(keys[miss], size[miss])
                totals.append(pre.totals(size[back]))
            yield pa.array(np.concatenate(totals), pa.int64())

    return count(F.col(f"`{text}`"))


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens", rows: int = TABLE_ROWS) -> DataFrame:
    """``df`` with the token count of each text; a column already named ``out`` is replaced.

    One row in, one row out: repeated rows are counted each, an empty table gives an empty result.
    """
    bound_batches(df.sparkSession)
    return df.withColumn(out, token_count_column(df, text, path, rows))

"""Find benchmark items in texts, word for word or with a few words changed, left out or put in.

Windows as long as an item are embedded by a random walk: at each step the walk writes down its word and
moves on or stays, as a random bit of that word and step says. Texts a few edits apart mostly fall into
step again, so their embeddings differ in few places, and edit distance becomes Hamming distance. Places
sampled from the embedding are a bucket key; many independent keys from several embeddings make it all but
certain that a window within the bound shares one with its item. What meets in a bucket is verified by
exact edit distance. A window within the bound has a run of some words unchanged (the pigeonhole on its
edits), so only windows around a run of words that an item also has are embedded; that loses none.
Items too short for that can be looked for word for word, by the hashes of all runs of their length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.bpe import spans
from corpusflow.llm.language_id import LetterWords, _tables
from corpusflow.llm.pretokens import mix, powers
from corpusflow.llm.slices import bound_batches, slices
from corpusflow.session import work_path
from corpusflow.sources.tables import read_if_present

# Edits allowed, as a share of an item's words; items of fewer words are looked for word for word or not at all.
MAX_EDITS, MIN_WORDS = 0.2, 8
# Embeddings, keys from each, and places that make one key.
WALKS, KEYS, PLACES = 8, 6, 3
# Bytes of item texts that are broadcast at once; more items are looked for in blocks.
BLOCK_BYTES = 16 << 20
# Windows embedded at once.
WINDOWS = 4096
_PAD = np.uint64(0x2545F4914F6CDD1D)
_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# First and last code point of scripts without spaces (Thai, Lao, Myanmar, Khmer, Tai, kana, bopomofo, Han).
UNSPACED = [
    (0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3005, 0x3007), (0x3040, 0x312F),
    (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
]


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of each code point: 0 no part of a word, 1 letter or mark, 2 digit, 3 a word of its own."""
    inside, _, _ = _tables()
    kinds = inside.astype(np.int8)
    kinds[np.fromiter((chr(c).isnumeric() for c in range(0x110000)), dtype=bool, count=0x110000) & ~inside] = 2
    for low, high in UNSPACED:
        kinds[low : high + 1][kinds[low : high + 1] > 0] = 3
    return kinds


def item_words(texts: list[str]) -> LetterWords:
    """Words of texts in lower case: runs of letters, runs of digits, single code points in scripts without spaces."""
    _, _, lower = _tables()
    raw = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    points, kind = lower[raw], _kinds()[raw]
    change = np.ones(len(kind) + 1, dtype=bool)
    change[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 3)
    start, end = np.flatnonzero(change[:-1] & (kind > 0)), np.flatnonzero(change[1:] & (kind > 0)) + 1
    sums = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum(mix(points + np.uint64(1)) * powers(len(points), _BASE)[:-1], out=sums[1:])
    key = mix((sums[end] - sums[start]) * powers(len(points), _INVERSE)[start] + (end - start).astype(np.uint64))
    return LetterWords(points, start, end, key, np.searchsorted(start, edges), edges)


def walk(keys: np.ndarray, start: np.ndarray, size: np.ndarray, walks: int) -> np.ndarray:
    """(window, walk, step): which word of ``keys`` each of 3 * size steps writes; -1 past the window."""
    steps = int(3 * size.max())
    out = np.full((len(start), walks, steps), -1, dtype=np.int32)
    at = np.zeros((len(start), walks), dtype=np.int64)
    rows = np.arange(walks)[None, :]
    bits = np.zeros((walks, 0))
    for j in range(steps):
        if j % 64 == 0:
            salts = mix(np.arange(walks, dtype=np.uint64) * np.uint64(0x10001) + np.uint64(j + 1))
            bits = np.stack([mix(keys ^ salt) for salt in salts])
        inside = at < size[:, None]
        place = np.where(inside, start[:, None] + at, start[:, None])
        out[:, :, j] = np.where(inside, place, -1)
        move = (bits[rows, place] >> np.uint64(j % 64)) & np.uint64(1)
        at += np.where(inside, move.astype(np.int64), 0)
    return out


def bucket_keys(keys: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(window, key): bucket keys of windows of ``keys``; windows of different sizes never share one."""
    random = np.random.default_rng(20)
    places = random.random((WALKS, KEYS, PLACES))
    written = walk(keys, start, size, WALKS)
    symbols = np.append(keys, _PAD)  # place -1 is the padding
    found = np.zeros((len(start), WALKS, KEYS), dtype=np.uint64)
    window = np.arange(len(start))
    for w in range(WALKS):
        for k in range(KEYS):
            key = mix(size.astype(np.uint64) * np.uint64(1000) + np.uint64(w * KEYS + k))
            for share in places[w, k]:
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + symbols[written[window, w, (share * 3 * size).astype(np.int64)]])
            found[:, w, k] = key
    return found.reshape(len(start), -1)


def edits_within(item: np.ndarray, text: np.ndarray) -> int:
    """Least edit distance of the item to any run of words of the text."""
    row = np.zeros(len(text) + 1, dtype=np.int64)
    along = np.arange(len(text) + 1)
    for i, word in enumerate(item, 1):
        best = np.empty_like(row)
        best[0] = i
        best[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(best - along) + along
    return int(row.min())


@dataclass
class Items:
    """Benchmark items as word hashes, with what is needed to find them."""

    ids: list[int | None]
    words: list[np.ndarray]
    bound: np.ndarray
    size: np.ndarray
    run: int
    seeds: np.ndarray
    seed_size: np.ndarray
    keys: np.ndarray
    key_item: np.ndarray
    vocabulary: np.ndarray
    max_edits: float

    @classmethod
    def build(cls, rows: list[tuple[int | None, str]], max_edits: float, min_words: int) -> Items | None:
        found = item_words([text for _, text in rows])
        every = [found.key[a:b] for a, b in zip(found.first[:-1], found.first[1:])]
        kept = [i for i, w in enumerate(every) if len(w) >= min_words]
        if not kept:
            return None
        words = [every[i] for i in kept]
        size = np.array([len(w) for w in words])
        bound = np.floor(size * max_edits).astype(np.int64)
        run = max(1, int((-(-(size - bound) // (bound + 1))).min()))
        seeds = np.concatenate([_runs(w, run) for w in words])
        of = np.repeat(size, size - run + 1)
        seeds, of = np.unique(np.stack([seeds, of.astype(np.uint64)]), axis=1)
        joined, begin = np.concatenate(words), np.cumsum(size) - size
        keys = np.concatenate([bucket_keys(joined, begin[a : a + 64], size[a : a + 64]) for a in range(0, len(size), 64)])
        order = np.argsort(keys, axis=None, kind="stable")
        return cls([rows[i][0] for i in kept], words, bound, size, run, seeds, of.astype(np.int64), keys.ravel()[order], order // keys.shape[1], np.unique(joined), max_edits)

    def find(self, texts: list[str]) -> list[list[tuple[int | None, int]]]:
        """For each text the (item, edits) that it holds within the bound, by item."""
        words = item_words(texts)
        out: list[list[tuple[int | None, int]]] = [[] for _ in texts]
        if len(words.key) < self.run:
            return out
        runs = _runs(words.key, self.run)
        low, high = np.searchsorted(self.seeds, runs), np.searchsorted(self.seeds, runs, side="right")
        hit = np.flatnonzero(high > low)
        if not len(hit):
            return out
        owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
        # Windows of the item's size that hold the run, inside the run's own text.
        at = np.repeat(hit, (high - low)[hit])
        size = self.seed_size[spans(low[hit], (high - low)[hit])]
        first, last = words.first[:-1][owner[at]], words.first[1:][owner[at]]
        begin = np.maximum(at + self.run - size, first)
        end = np.maximum(np.minimum(at, last - size), begin)  # a text shorter than the item is one window
        count = end - begin + 1
        start, size = spans(begin, count), np.repeat(size, count)
        base = int(size.max()) + 1
        start, size = np.divmod(np.unique(start * base + size), base)
        real = np.minimum(size, words.first[1:][owner[start]] - start)
        # A window within the bound of an item has all words but so many from items.
        known = np.concatenate([[0], np.cumsum(self._is_known(words.key))])
        likely = known[start + real] - known[start] >= size - np.floor(size * self.max_edits)
        start, size, real = start[likely], size[likely], real[likely]
        pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for a in range(0, len(start), WINDOWS):
            part, length = start[a : a + WINDOWS], size[a : a + WINDOWS]
            lowest = int(part.min())
            local = words.key[lowest : int((part + length).max())]
            # A window that ends with its text is padded: its own words, then words that are nowhere else.
            cut = real[a : a + WINDOWS] < length
            keys = np.concatenate([self._keys(local, part[~cut] - lowest, length[~cut]), *(self._padded(words.key[s : s + r], n) for s, r, n in zip(part[cut], real[a : a + WINDOWS][cut], length[cut]))])
            order = np.concatenate([np.flatnonzero(~cut), np.flatnonzero(cut)])
            low, high = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, side="right")
            for w, k in zip(*np.nonzero(high > low)):
                s, n = int(part[order[w]]), int(length[order[w]])
                for item in set(self.key_item[low[w, k] : high[w, k]].tolist()):
                    key = (int(owner[s]), item)
                    old = pairs.get(key, (s, s + n))
                    pairs[key] = (min(old[0], s), max(old[1], s + n))
        for (text, item), (a, b) in sorted(pairs.items()):
            bound = int(self.bound[item])
            a, b = max(a - bound, int(words.first[text])), min(b + bound, int(words.first[text + 1]))
            if np.isin(self.words[item], words.key[a:b]).sum() < len(self.words[item]) - bound:
                continue  # more words are missing than may be
            edits = edits_within(self.words[item], words.key[a:b])
            if edits <= bound:
                out[text].append((self.ids[item], edits))
        return out

    def _is_known(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, keys), len(self.vocabulary) - 1)
        return self.vocabulary[at] == keys

    @staticmethod
    def _keys(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return bucket_keys(words, start, size) if len(start) else np.zeros((0, WALKS * KEYS), dtype=np.uint64)

    @staticmethod
    def _padded(words: np.ndarray, size: int) -> np.ndarray:
        filled = np.concatenate([words, np.full(size - len(words), _PAD)])
        return bucket_keys(filled, np.zeros(1, np.int64), np.array([size]))


def _runs(words: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(max(len(words) - length + 1, 0), dtype=np.uint64)
    for k in range(length):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + len(out)]
    return mix(out)


@dataclass
class ShortItems:
    """Items of few words, to be found word for word: by number of words the sorted hashes and whose they are."""

    ids: list[int | None]
    runs: dict[int, tuple[np.ndarray, np.ndarray]]

    @classmethod
    def build(cls, rows: list[tuple[int | None, str]], min_words: int) -> ShortItems | None:
        found = item_words([text for _, text in rows])
        size = np.diff(found.first)
        runs = {}
        for n in np.unique(size[(size > 0) & (size < min_words)]).tolist():
            own = np.flatnonzero(size == n)
            keys = _runs(found.key, n)[found.first[own]]
            order = np.argsort(keys, kind="stable")
            runs[n] = keys[order], own[order]
        return cls([i for i, _ in rows], runs) if runs else None

    def find(self, texts: list[str]) -> list[list[tuple[int | None, int]]]:
        """For each text the (item, 0) that it holds word for word."""
        words = item_words(texts)
        owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
        out: list[list[tuple[int | None, int]]] = [[] for _ in texts]
        for n, (keys, item) in self.runs.items():
            runs = _runs(words.key, n)
            runs, of = runs[owner[: len(runs)] == owner[n - 1 :]], owner[: len(runs)][owner[: len(runs)] == owner[n - 1 :]]
            hit = np.isin(runs, keys)
            met = np.unique(np.stack([of[hit].astype(np.uint64), runs[hit]]), axis=1)
            low, high = np.searchsorted(keys, met[1]), np.searchsorted(keys, met[1], side="right")
            for text, k in zip(np.repeat(met[0], high - low).tolist(), item[spans(low, high - low)].tolist()):
                out[text].append((self.ids[k], 0))
        return out


def leak_column(df: DataFrame, text: Column, items: Items | ShortItems, shared: Broadcast | None = None) -> Column:
    """Array of (item, edits) that a text holds; ``shared`` is the broadcast of ``items`` where the caller ends it."""
    shared = shared or df.sparkSession.sparkContext.broadcast(items)

    @F.arrow_udf("array<struct<item:bigint,edits:int>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("item", pa.int64()), ("edits", pa.int32())]))
        for batch in batches:
            found = [row for part in slices(batch.to_pylist()) for row in shared.value.find(part)]
            yield pa.array([[{"item": i, "edits": e} for i, e in row] for row in found], kind)

    return find(text)


def find_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    out: str = "leaks",
    max_edits: float = MAX_EDITS,
    min_words: int = MIN_WORDS,
    short_items: bool = False,
) -> DataFrame:
    """``df`` with the benchmark items that each whole text holds: an array of (item, edits), by item.

    Words are runs of letters in lower case, runs of digits, and single code points in scripts without
    spaces. An item is found where a run of the text's words lies within ``floor(max_edits * words)`` edits
    of it. Items of fewer than ``min_words`` words are found word for word with ``short_items``, else not;
    those without a word and NULL ones never. Recall is that of the bucket keys: 1 for exact copies, and measured in the tests
    for changed ones. NULL and empty texts, and an empty benchmark, give empty arrays. One row in, one row
    out; a column already named ``out`` is replaced. Items are broadcast in blocks of ``BLOCK_BYTES``.
    """
    bound_batches(df.sparkSession)
    rows = benchmark.select(F.col(f"`{item}`").cast("long").alias("item"), F.col(f"`{item_text}`").alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // BLOCK_BYTES
    body = F.col(f"`{text}`")

    def block(b: int) -> list[Items | ShortItems]:
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        held = [(r["item"], r["text"]) for r in part.collect()]
        built = (Items.build(held, max_edits, min_words), ShortItems.build(held, min_words) if short_items else None)
        return [items for items in built if items is not None]

    if blocks > 1:
        return _by_block(df, body, blocks, block, out)
    found = [leak_column(df, body, items) for items in block(0)]
    none = F.array().cast("array<struct<item:bigint,edits:int>>")
    return df.withColumn(out, F.array_sort(F.concat(*found)) if len(found) > 1 else found[0] if found else none)


def _by_block(df: DataFrame, body: Column, blocks: int, block: Callable[[int], list[Items | ShortItems]], out: str) -> DataFrame:
    """The leaks of many items: one block at a time is on the driver and broadcast, its leaks are a table.

    What a text holds depends on the text alone, so leaks are kept by two hashes of it and copies share them.
    """
    spark = df.sparkSession
    path = work_path(spark, "leaks")
    names = F.xxhash64(body).alias("h"), F.xxhash64(F.lit(1), body).alias("g")
    for b in range(blocks):
        for k, items in enumerate(block(b)):
            shared = spark.sparkContext.broadcast(items)
            some = df.select(*names, leak_column(df, body, items, shared).alias("leaks")).where(F.size("leaks") > 0)
            some.dropDuplicates(["h", "g"]).write.parquet(f"{path}/block={2 * b + k}")
            shared.destroy()
    schema = "h long, g long, leaks array<struct<item:bigint,edits:int>>"
    held = spark.read.schema(schema).parquet(path) if read_if_present(spark, path) is not None else spark.createDataFrame([], schema)
    leaks = held.groupBy("h", "g").agg(F.array_sort(F.flatten(F.collect_list("leaks"))).alias("leaks"))
    row = F.struct(*[f"`{c}`" for c in df.columns if c != out]).alias("row")
    met = df.select(row, *names).join(leaks, ["h", "g"], "left")
    return met.select("row.*", F.coalesce("leaks", F.array().cast("array<struct<item:bigint,edits:int>>")).alias(out))

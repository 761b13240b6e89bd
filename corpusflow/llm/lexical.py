"""Ranked lexical search in K2-treaps over the term-document grid.

Each shard of documents is a grid: a row for each term, a column for each document, and in a cell how
much the term counts in the document (its impact). The grid is cut into bands of rows as high as the
shard is wide, and each band into quarters again and again (a K2-tree), with the greatest impact of each
quarter. Quarters without a posting are not kept, and one with a single posting is a leaf at once.

For an item the row paths of its terms descend jointly: a range of documents has one quarter for each
term, and the weighted sum of their maxima bounds every score in the range. Ranges are halved best
first, until none can beat the ``k`` documents found; the bound of a single document is its score.

Every row of the table is indexed, so results are exact. Shards are rows of a stored table, compressed by
the worker that builds them and each in a row group of its own; a task that walks them holds one at a time,
however many it has. Items are a stated query set, taken in blocks of bounded size; a task keeps ``k``
documents for each item of the block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.pretokens import mix, powers
from corpusflow.llm.slices import bound_batches, slices
from corpusflow.session import stage, work_path

# What a shard holds at most, unless a single slice of texts has more: documents, and postings.
SHARD_DOCS, SHARD_POSTINGS = 1 << 12, 1 << 19
# Items searched at once: a block's bytes of text.
BLOCK_BYTES = 4 << 20
# Ranges of documents halved at once: few at first, so that good documents are found early.
FIRST_RANGES, MOST_RANGES = 32, 1024
# Impacts are shares of this number; a term's weight is counted in thousandths.
UNIT = 1_000_000

_TERM = np.zeros(256, dtype=bool)
_TERM[0x80:] = True
for _a, _b in ("09", "AZ", "az"):
    _TERM[ord(_a) : ord(_b) + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BITS = np.array([bin(i).count("1") for i in range(16)], dtype=np.int64)
# Which of a node's children is its quarter q, by 4 * mask + q; -1: it has no such quarter.
_CHILD = np.array([_BITS[m & ((1 << q) - 1)] if m >> q & 1 else -1 for m in range(16) for q in range(4)], dtype=np.int64)

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHARD = "ids array<long>, no_id array<boolean>, height int, terms binary, dfs binary, masks binary, maxima binary, leaf_row binary, leaf_col binary"
# What the packed columns of a shard hold.
PACKED = {"terms": np.uint64, "dfs": np.int32, "masks": np.uint8, "maxima": np.uint32, "leaf_row": np.uint16, "leaf_col": np.uint16}
# A shard is megabytes: Spark and Parquet get it compressed, and neither writes nor reads two shards at once.
STORED = {"compression": "none", "parquet.enable.dictionary": "false", "parquet.block.row.count.limit": "1"}
HIT = "item_no long, doc_id long, score long"


def terms_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(which text, term, occurrences) of the distinct terms of each text, and each text's number of terms.

    Terms are runs of ASCII letters, digits and all other code points from U+0080, A-Z in lower case,
    named by 64-bit hashes.
    """
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b" ".join(encoded) + b" ", dtype=np.uint8)]
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)) + 1)])
    inside = _TERM[data]
    before = np.concatenate([[False], inside[:-1]])
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(~inside & before)
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(n, _BASE)[:n], out=sums[1:])
    key = mix((sums[end] - sums[start]) * powers(n, _INVERSE)[start] + (end - start).astype(np.uint64))
    first = np.searchsorted(start, edges)
    counts = np.diff(first)
    names, number = np.unique(key, return_inverse=True)
    pair = np.sort(np.repeat(np.arange(len(texts)), counts) * len(names) + number)
    at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])[: len(pair)])
    owner, number = np.divmod(pair[at], max(len(names), 1))
    return owner, names[number], np.diff(np.append(at, len(pair))), counts


def _pack(array: np.ndarray) -> bytes:
    """An array's bytes, compressed, behind their number."""
    data = np.ascontiguousarray(array).tobytes()
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def _unpack(value: pa.BinaryScalar, kind: type) -> np.ndarray:
    data = value.as_buffer()
    size = int.from_bytes(data[:8].to_pybytes(), "little")
    return np.frombuffer(pa.Codec("zstd").decompress(data[8:], size), kind)


def _morton(row: np.ndarray, col: np.ndarray, height: int) -> np.ndarray:
    code = np.zeros(len(row), dtype=np.int64)
    for bit in range(height):
        code |= (row >> bit & 1) << (2 * bit + 1) | (col >> bit & 1) << (2 * bit)
    return code


@dataclass
class Treap:
    """The K2-treaps of one shard, level by level, the bands' roots first.

    ``masks`` tells which quarters of a node there are (0: a leaf), ``maxima`` its greatest impact;
    leaves have their row within the band and their column besides.
    """

    ids: np.ndarray
    no_id: np.ndarray
    terms: np.ndarray
    dfs: np.ndarray
    height: int
    masks: np.ndarray
    maxima: np.ndarray
    leaf_row: np.ndarray
    leaf_col: np.ndarray

    @classmethod
    def build(cls, ids, no_id, doc, names, row, dfs, impact) -> Treap:
        """From postings (number of the document, number of the term, impact), the terms' names and frequencies."""
        height = max(0, int(len(ids) - 1).bit_length())
        # Terms of like frequency and like documents lie together, so that quarters are full or empty.
        centre = np.bincount(row, weights=doc, minlength=len(names)) / np.maximum(dfs, 1)
        order = np.lexsort((centre, -np.floor(np.log2(np.maximum(dfs, 1)))))
        place = np.empty(len(names), dtype=np.int64)
        place[order] = np.arange(len(names))
        row = place[row]
        band, low = row >> height, row & ((1 << height) - 1)
        code = band << (2 * height) | _morton(low, doc, height)
        order = np.argsort(code, kind="stable")
        code, low, doc, impact = code[order], low[order], doc[order], impact[order].astype(np.uint32)
        masks, maxima, rows, cols = [], [], [], []
        for level in range(height + 1):
            node = code >> 2 * (height - level)
            if not len(node):
                break
            begin = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            size = np.diff(np.append(begin, len(node)))
            single = size == 1
            mask = np.zeros(len(begin), dtype=np.uint8)
            if level < height:
                quarter = np.left_shift(1, code >> 2 * (height - level - 1) & 3).astype(np.uint8)
                mask = np.where(single, 0, np.bitwise_or.reduceat(quarter, begin)).astype(np.uint8)
            masks.append(mask), maxima.append(np.maximum.reduceat(impact, begin))
            rows.append(low[begin[single]]), cols.append(doc[begin[single]])
            rest = np.repeat(~single, size)
            code, low, doc, impact = code[rest], low[rest], doc[rest], impact[rest]
        join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
        names, dfs = names[np.argsort(place)], dfs[np.argsort(place)]
        return cls(ids, no_id, names, dfs, height, join(masks, np.uint8), join(maxima, np.uint32), join(rows, np.uint16), join(cols, np.uint16))

    def __post_init__(self) -> None:
        leaf = self.masks == 0
        # Row and column of each leaf; -1 for other nodes.
        self._row, self._col = (np.full(len(leaf), -1, dtype=np.int32) for _ in range(2))
        self._row[leaf], self._col[leaf] = self.leaf_row, self.leaf_col
        children = _BITS[self.masks]
        # Nodes of a level stand in order, and so do their children behind all nodes of the level.
        bands = -(-len(self.terms) // (1 << self.height))
        self._first = bands + np.cumsum(children) - children
        self._by_name = np.argsort(self.terms)

    def rows_of(self, keys: np.ndarray) -> np.ndarray:
        """The rows of terms; -1 for a term that the shard does not have."""
        if not len(self.terms):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.terms, keys, sorter=self._by_name), len(self.terms) - 1)
        row = self._by_name[at]
        return np.where(self.terms[row] == keys, row, -1)

    def search(self, row: np.ndarray, weight: np.ndarray, found: Found) -> None:
        """Add the shard's best documents for the terms in rows ``row`` with their weights to ``found``.

        The frontier has ranges of documents (``level``, ``start``, ``bound``) and, for each range and each term
        that occurs in it, the quarter on the term's row path.
        """
        height, low, node = self.height, row & ((1 << self.height) - 1), row >> self.height
        own = (self._row[node] < 0) | (self._row[node] == low)
        node, low, weight, owner = node[own], low[own], weight[own], np.zeros(int(own.sum()), np.int64)
        level, start = np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = self._bounds(node, weight, owner, 1)
        ranges = FIRST_RANGES
        while True:
            live, single = bound >= max(found.least, 1), level == height
            if (live & single).any():
                best = np.flatnonzero(live & single)
                found.add(bound[best], self.ids[start[best]], self.no_id[start[best]])
                live = bound >= max(found.least, 1)
            rest = np.flatnonzero(live & ~single)
            if not len(rest):
                return
            take = rest[np.argpartition(-bound[rest], ranges)[:ranges]] if len(rest) > ranges else rest
            taken = np.zeros(len(bound), dtype=bool)
            taken[take] = True
            stay = rest[~taken[rest]]
            number = np.full(len(bound), -1)  # of a range in the next frontier; of its left half if it is taken
            number[stay], number[take] = np.arange(len(stay)), len(stay) + np.arange(len(take))
            halved = taken[owner]
            kept = ~halved & (number[owner] >= 0)
            step = height - 1 - level[take]
            halves = self._halves(node[halved], low[halved], weight[halved], number[owner[halved]], step, len(stay))
            node, low, weight, owner = (
                np.concatenate([x[kept], *(h[k] for h in halves)]) for k, x in enumerate((node, low, weight, number[owner]))
            )
            level = np.concatenate([level[stay], level[take] + 1, level[take] + 1])
            start = np.concatenate([start[stay], start[take], start[take] + (1 << step)])
            bound = self._bounds(node, weight, owner, len(level))
            ranges = min(2 * ranges, MOST_RANGES)

    def _bounds(self, node: np.ndarray, weight: np.ndarray, owner: np.ndarray, ranges: int) -> np.ndarray:
        return np.bincount(owner, weights=self.maxima[node].astype(np.int64) * weight, minlength=ranges).astype(np.int64)

    def _halves(self, node, low, weight, owner, step, first) -> list[tuple[np.ndarray, ...]]:
        """The quarters in the left and in the right halves of ranges, ``first`` being the number of the first range."""
        shift = step[owner - first]
        mask, col, begin = self.masks[node].astype(np.int64), self._col[node], self._first[node]
        upper, side = low >> shift & 1, col >> shift & 1
        out = []
        for half in (0, 1):
            nth = _CHILD[mask * 4 + 2 * upper + half]
            child = np.where(mask == 0, np.where(side == half, node, -1), np.where(nth >= 0, begin + nth, -1))
            row = self._row[child]
            own = np.flatnonzero((child >= 0) & ((row < 0) | (row == low)))
            out.append((child[own], low[own], weight[own], owner[own] + half * len(step)))
        return out

    def row(self) -> tuple:
        return (self.ids, self.no_id, self.height, *(_pack(getattr(self, n).astype(kind)) for n, kind in PACKED.items()))

    @classmethod
    def read(cls, batch: pa.RecordBatch) -> Iterator[Treap]:
        lists = lambda name, i: np.asarray(batch.column(name)[i].values.to_numpy(zero_copy_only=False))
        for i in range(batch.num_rows):
            arrays = {n: _unpack(batch.column(n)[i], kind) for n, kind in PACKED.items()}
            yield cls(ids=lists("ids", i), no_id=lists("no_id", i), height=batch.column("height")[i].as_py(), **arrays)


class Found:
    """The best ``k`` documents of one item so far: higher scores first, then smaller ids, ids that are NULL last."""

    def __init__(self, k: int):
        self.k, self.least = k, 0
        self.score, self.id, self.no_id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        score, ids, no_id = (np.concatenate(x) for x in ((self.score, score), (self.id, ids), (self.no_id, no_id)))
        best = np.lexsort((ids, no_id, -score))[: self.k]
        self.score, self.id, self.no_id = score[best], ids[best], no_id[best]
        self.least = int(self.score[-1]) if len(best) == self.k else 0


@dataclass(frozen=True)
class LexicalIndex:
    """Stored shards, the number of documents with a term, and the number of all their terms."""

    shards: DataFrame
    documents: int
    terms: int


def _shards(documents: int, terms: int):
    """For Spark: treaps of the documents of a task."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        docs = postings = 0
        schema = pa.schema([("ids", pa.list_(pa.int64())), ("no_id", pa.list_(pa.bool_())), ("height", pa.int32()), *((n, pa.binary()) for n in PACKED)])

        def close() -> pa.RecordBatch:
            ids, no_id, doc, term, tf, size = (np.concatenate(x) for x in zip(*held))
            names, row, dfs = np.unique(term, return_inverse=True, return_counts=True)
            at = np.flatnonzero(size)  # documents without a term are in no list
            at = at[np.lexsort((size[at], _leading(doc, row, dfs, tf)))]
            place = np.full(len(ids), -1)
            place[at] = np.arange(len(at))
            length = 10 + 90 * size * documents // max(terms, 1)
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * length[doc])
            treap = Treap.build(ids[at], no_id[at], place[doc], names, row, dfs, impact)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(treap.row(), schema)], schema=schema)

        for batch in batches:
            ids = batch.column(0)
            no_id, ids = np.asarray(ids.is_null()), ids.fill_null(0).to_numpy()
            done = 0
            for part in slices(batch.column(1).to_pylist()):
                for k in range(0, len(part), SHARD_DOCS):
                    texts = part[k : k + SHARD_DOCS]
                    owner, term, tf, size = terms_of(texts)
                    if held and (docs + len(texts) > SHARD_DOCS or postings + len(owner) > SHARD_POSTINGS):
                        yield close()
                        held, docs, postings = [], 0, 0
                    own = slice(done, done + len(texts))
                    held.append((ids[own], no_id[own], owner + docs, term, tf, size))
                    docs, postings, done = docs + len(texts), postings + len(owner), done + len(texts)
        if held:
            yield close()

    return build


def _leading(doc: np.ndarray, row: np.ndarray, dfs: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """For each document with a term, its most frequent one (of like ones the shard's most common): like documents have the same."""
    if not len(doc):
        return np.zeros(0, np.int64)
    begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    rank = np.minimum(tf, 255) << 52 | np.minimum(dfs[row], 1 << 20) << 30 | row
    return np.maximum.reduceat(rank, begin) & ((1 << 30) - 1)


def build_index(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LexicalIndex:
    """The treaps of all rows, as a table in the shared folder.

    Texts are read twice and never shuffled: once for the number of documents with a term and of their
    terms, once for the treaps. NULL and empty texts, and those without a term, are in no shard.
    Repeated rows are documents of their own. A shard has ``SHARD_DOCS`` documents at most.
    """
    bound_batches(df.sparkSession)
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        for batch in batches:
            for part in slices(batch.column(0).to_pylist()):
                data = np.frombuffer((" ".join(part) + " ").encode("utf-8", "surrogatepass"), dtype=np.uint8)
                inside = _TERM[data]
                ends = np.flatnonzero(inside[:-1] & ~inside[1:])
                edges = np.cumsum(np.fromiter((len(t.encode("utf-8", "surrogatepass")) + 1 for t in part), np.int64, len(part)))
                documents += len(np.unique(np.searchsorted(edges, ends, side="right")))
                terms += len(ends)
        yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([terms])], names=["documents", "terms"])

    seen = docs.where("text is not null").select("text").mapInArrow(count, "documents long, terms long")
    seen = seen.agg(F.sum("documents").alias("documents"), F.sum("terms").alias("terms")).first()
    documents, terms = seen["documents"] or 0, seen["terms"] or 0
    shards = docs.where("text is not null").mapInArrow(_shards(documents, terms), SHARD)
    return LexicalIndex(stage(shards, "lexical-index", **STORED), documents, terms)


def _frequencies(shared):
    """For Spark: in how many of a task's documents each term of the items is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value
        total = np.zeros(len(keys), np.int64)
        for batch in batches:
            for terms, dfs in zip(batch.column("terms"), batch.column("dfs")):
                terms, dfs = _unpack(terms, PACKED["terms"]), _unpack(dfs, PACKED["dfs"])
                at = np.minimum(np.searchsorted(keys, terms), max(len(keys) - 1, 0))
                hit = keys[at] == terms if len(keys) else np.zeros(len(terms), bool)
                total[at[hit]] += dfs[hit]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["no", "df"])

    return count


def _hits(shared, k: int):
    """For Spark: the best ``k`` documents of a task's shards for each item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        best = [Found(k) for _ in items]
        for batch in batches:
            for treap in Treap.read(batch):
                for found, (keys, weights) in zip(best, items):
                    row = treap.rows_of(keys)
                    some = row >= 0
                    if some.any():
                        treap.search(row[some], weights[some], found)
        item = np.repeat(np.arange(len(items)), [len(f.score) for f in best]).astype(np.int64)
        join = lambda name, kind: np.concatenate([np.zeros(0, kind), *(getattr(f, name) for f in best)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(join("id", np.int64), mask=join("no_id", bool)), pa.array(join("score", np.int64))],
            names=["item_no", "doc_id", "score"],
        )

    return search


def search_index(
    index: LexicalIndex,
    items: DataFrame,
    k: int = 10,
    item_id: str = "item_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of the highest score above 0 for each item.

    Equal scores come by ascending ``doc_id``, documents without one last. Items equal in id and text are
    one item; different texts under one id, or under none, are searched each and keep that id. Items without
    a term find nothing, and so does every item in an empty index.
    """
    spark = items.sparkSession
    kind = items.schema[item_id].dataType
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
    asked = stage(asked.where("text is not null").dropDuplicates(), "items")
    size = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-size // block_bytes)
    path = work_path(spark, "lexical-hits")
    bound_batches(spark, rows=1)  # a shard each
    try:
        for block in range(blocks):
            mine = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
            _search_block(index, mine.orderBy("item_id", "text").collect(), kind, k, f"{path}/block={block}")
    finally:
        bound_batches(spark)
    if not blocks:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    found = spark.read.schema(f"item_id {kind.simpleString()}, rank int, doc_id long, score long").parquet(path)
    return found.select("item_id", "rank", "doc_id", "score")


def _search_block(index: LexicalIndex, items: list, kind, k: int, path: str) -> None:
    spark = index.shards.sparkSession
    owner, term, _, _ = terms_of([r["text"] for r in items])
    keys = np.unique(term)
    shared = spark.sparkContext.broadcast(keys)
    seen = index.shards.select("terms", "dfs").mapInArrow(_frequencies(shared), "no long, df long")
    df = np.zeros(len(keys), np.int64)
    for r in seen.groupBy("no").agg(F.sum("df").alias("df")).collect():  # a row for each term of the block
        df[r["no"]] = r["df"]
    shared.destroy()
    weight = np.floor(1000 * np.log((2 * index.documents + 2) / (2 * df + 1))).astype(np.int64)
    at = np.searchsorted(keys, term)
    ends = np.searchsorted(owner, np.arange(len(items) + 1))
    asked = [(term[a:b], weight[at[a:b]]) for a, b in zip(ends, ends[1:])]
    shared = spark.sparkContext.broadcast(asked)
    hits = index.shards.mapInArrow(_hits(shared, k), HIT)
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(items)], f"item_no long, item_id {kind.simpleString()}")
    # A block of items has a bounded number of rows.
    best.join(F.broadcast(names), "item_no").select("item_id", "rank", "doc_id", "score").write.parquet(path)
    shared.destroy()


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Index ``docs`` (doc_id, text) and search it for ``items`` (item_id, text)."""
    return search_index(build_index(docs), items, k)

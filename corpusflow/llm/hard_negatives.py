"""Hard negatives of anchor vectors by exact scores in a residue number system.

Components become whole numbers, and a score is a whole inner product. It is worked out modulo
several small primes: residues are multiplied as ``float32`` matrices, which is exact while no sum
passes 2**24, and the signed score comes back from its residues by Chinese remaindering. How many
primes are needed follows from the longest vector, which bounds every score.

Anchors are a stated query set. They are dealt into blocks of bounded size; each block goes to every
task once to find its positives and once to find the negatives in the window of each positive. Tasks
keep a few rows for each anchor, and windows pick the best of what the tasks found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.session import stage, work_path

# Primes below 1024: half of one, squared, times DIMS stays below 2**24.
PRIMES = [1021, 1019, 1013, 1009, 997, 991]
# Components multiplied at once; longer vectors are added up modulo the prime.
DIMS = 64
# Bytes of one block of anchors, as it is broadcast.
BLOCK_BYTES = 16 << 20
# Rows that a task takes, and the tile of scores (anchors x rows) that it holds.
TASK_ROWS = 8_192
TILE_ANCHORS, TILE_ROWS = 512, 2_048
FOUND = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
# No score: below all real ones.
NONE = np.int64(-(1 << 62))


def residues(values: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Whole numbers modulo each prime, nearest to zero, as ``float32``."""
    out = []
    for p in primes:
        r = values % p
        r[r > p // 2] -= p
        out.append(r.astype(np.float32))
    return out


def exact_scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Inner products of all rows of ``a`` with all rows of ``b`` from their residues, as ``int64``.

    Exact while twice the absolute score is below the product of the primes.
    """
    total, product = None, 1
    for x, y, p in zip(a, b, primes):
        r = np.zeros((len(x), len(y)), dtype=np.int64)
        for k in range(0, x.shape[1], DIMS):
            r += (x[:, k : k + DIMS] @ y[:, k : k + DIMS].T).astype(np.int64)
        r %= p
        if total is None:
            total = r
        else:  # the next digit in mixed radix
            total += (r - total) % p * pow(product, -1, p) % p * product
        product *= p
    total[total > product // 2] -= product
    return total


def primes_for(longest: float) -> list[int]:
    """As many primes as scores up to the square ``longest`` of the longest vector ask for."""
    need, product = 2 * (int(longest * 1.000001) + 1) + 1, 1
    for n, p in enumerate(PRIMES, 1):
        product *= p
        if product >= need:
            return PRIMES[:n]
    raise ValueError(f"scores up to {longest:.3g} pass the product of all primes, {product:.3g}")


class Best:
    """The best ``k`` rows of each anchor so far, by descending score, then ascending id."""

    def __init__(self, anchors: int, k: int):
        self.k = k
        self.score = np.full((anchors, k), NONE, dtype=np.int64)
        self.id = np.zeros((anchors, k), dtype=np.int64)

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Rows ``ids`` (ascending) with a score for each anchor ``at``; ``NONE`` where a row is out of question."""
        k = self.k
        least = self.score[at, -1]
        if score.shape[1] > k:
            least = np.maximum(least, np.partition(score, -k, axis=1)[:, -k])
        take = score > least[:, None]
        tie = (score == least[:, None]) & (least > NONE)[:, None]
        take |= tie & (np.cumsum(tie, axis=1) <= k)
        row, col = np.nonzero(take)
        old = np.repeat(np.arange(len(at)), k)
        rows = np.concatenate([old, row])
        scores = np.concatenate([self.score[at].ravel(), score[row, col]])
        names = np.concatenate([self.id[at].ravel(), ids[col]])
        order = np.lexsort((names, -scores, rows))
        rows, scores, names = rows[order], scores[order], names[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < k
        self.score[at[rows[keep]], place[keep]] = scores[keep]
        self.id[at[rows[keep]], place[keep]] = names[keep]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of one width; shorter ones are filled with zeros."""
    sizes = np.diff(np.asarray(column.offsets, dtype=np.int64))
    flat = np.asarray(column.flatten(), dtype=np.int64)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _tiles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, components) of up to ``TILE_ROWS`` rows by ascending id."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= TILE_ROWS:
            yield from _cut(held, width)
            held = []
    if held:
        yield from _cut(held, width)


def _cut(held: list[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    rows = pa.Table.from_batches(held).combine_chunks().sort_by("id")
    for k in range(0, rows.num_rows, TILE_ROWS):
        part = rows.slice(k, TILE_ROWS).combine_chunks()
        yield (
            part["id"].to_numpy(),
            part["label"].to_numpy(),
            _matrix(part["vector"].chunk(0), width),
        )


def _positives(shared, primes: list[int], k: int):
    """For Spark: the best ``k`` other rows of its label that a task has for each anchor."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, _ = shared.value
        anchors, best = residues(vectors, primes), Best(len(ids), k)
        for row_ids, row_labels, rows in _tiles(batches, vectors.shape[1]):
            for label in np.intersect1d(row_labels, labels):
                mine, theirs = np.flatnonzero(labels == label), np.flatnonzero(row_labels == label)
                right = residues(rows[theirs], primes)
                for a in range(0, len(mine), TILE_ANCHORS):
                    at = mine[a : a + TILE_ANCHORS]
                    score = exact_scores([x[at] for x in anchors], right, primes)
                    score[ids[at][:, None] == row_ids[theirs][None, :]] = NONE
                    best.add(at, score, row_ids[theirs])
        at, col = np.nonzero(best.score > NONE)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[at], best.id[at, col], best.score[at, col])], names=["anchor_id", "positive_id", "positive_score"])

    return find


def _negatives(shared, primes: list[int], k: int, num: int, den: int):
    """For Spark: the best ``k`` rows of other labels that a task has in the window of each (anchor, positive)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, (owner, positive, top) = shared.value
        anchors, best = residues(vectors, primes), Best(len(owner), k)
        low = top // den * num - (-(top % den) * num // den)  # the least score s with num * top <= den * s
        for row_ids, row_labels, rows in _tiles(batches, vectors.shape[1]):
            right = residues(rows, primes)
            for a in range(0, len(ids), TILE_ANCHORS):
                score = exact_scores([x[a : a + TILE_ANCHORS] for x in anchors], right, primes)
                score[labels[a : a + TILE_ANCHORS][:, None] == row_labels[None, :]] = NONE
                pairs = np.arange(*np.searchsorted(owner, [a, a + TILE_ANCHORS]))
                for p in range(0, len(pairs), TILE_ANCHORS):
                    at = pairs[p : p + TILE_ANCHORS]
                    own = score[owner[at] - a]
                    own[(own < low[at][:, None]) | (own > top[at][:, None])] = NONE
                    best.add(at, own, row_ids)
        at, col = np.nonzero(best.score > NONE)
        columns = (ids[owner[at]], positive[at], top[at], best.id[at, col], best.score[at, col])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return find


def whole_vectors(df: DataFrame, vec_id: Column, vector: Column, label: Column, scale: int = 256) -> DataFrame:
    """(id, label, vector): the rows that take part, each component as ``floor(scale * x)``.

    Rows without id, label or vector, or with a component that is NULL, NaN or infinite, take no part. Of
    rows with one id the one of the least label, then the least vector, stands for all.
    """
    rows = df.select(vec_id.cast("long").alias("id"), label.cast("long").alias("label"), vector.cast("array<double>").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~odd)
    tasks = max(1, -(-df.count() // TASK_ROWS))
    whole = rows.repartition(tasks, "id").select("id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("vector"))
    first = F.row_number().over(Window.partitionBy("id").orderBy("label", "vector"))
    return whole.withColumn("_first", first).where("_first = 1").drop("_first")


def mine_hard_negatives(
    df: DataFrame,
    vec_id: Column,
    vector: Column,
    label: Column,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    num: int = 80,
    den: int = 100,
    scale: int = 256,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows for which ``is_anchor`` (over column ``id``) holds. Positives of an anchor are its
    first ``positives`` other rows of its label, negatives of a positive the first ``negatives`` rows of
    other labels with ``num * positive_score <= den * negative_score <= den * positive_score``; higher scores
    come first, ties by smaller id. Rows with gaps and repeated ids: see ``whole_vectors``. Vectors of
    different length are compared as if the shorter ended in zeros. An empty table, or one without anchors,
    gives no rows; other columns of ``df`` are not read. Scores whose bound passes about 5e17 are an error.
    """
    spark = df.sparkSession
    rows = stage(whole_vectors(df, vec_id, vector, label, scale), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    seen = rows.agg(F.max(square).alias("square"), F.max(F.size("vector")).alias("width"), F.count_if(is_anchor).alias("anchors")).first()
    width, primes = max(1, seen["width"] or 0), primes_for(seen["square"] or 0.0)
    blocks = max(1, -(-8 * width * seen["anchors"] // block_bytes))
    path = work_path(spark, "hard-negatives")
    anchors = rows.where(is_anchor).withColumn("_block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    for block in range(blocks):
        _mine_block(rows, anchors.where(F.col("_block") == block), width, primes, (positives, negatives, num, den), f"{path}/block={block}")
    found = spark.read.schema(f"{FOUND}, rank int").parquet(path)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _mine_block(rows: DataFrame, anchors: DataFrame, width: int, primes: list[int], wanted: tuple[int, int, int, int], path: str) -> None:
    """Write the negatives of one block of anchors."""
    context, (k_pos, k_neg, num, den) = rows.sparkSession.sparkContext, wanted
    block = anchors.select("id", "label", "vector").orderBy("id").toArrow().combine_chunks()
    ids, labels = block["id"].to_numpy(), block["label"].to_numpy()
    vectors = _matrix(block["vector"].chunk(0), width) if len(ids) else np.zeros((0, width), np.int64)

    shared = context.broadcast((ids, labels, vectors, None))
    found = rows.mapInArrow(_positives(shared, primes, k_pos), "anchor_id long, positive_id long, positive_score long")
    ranked = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    best = found.withColumn("rank", ranked).where(F.col("rank") <= k_pos)
    # At most k_pos rows for each anchor of the block.
    best = best.orderBy("anchor_id", "rank").toArrow().combine_chunks()
    shared.destroy()

    owner = np.searchsorted(ids, best["anchor_id"].to_numpy())
    pairs = (owner, best["positive_id"].to_numpy(), best["positive_score"].to_numpy())
    shared = context.broadcast((ids, labels, vectors, pairs))
    found = rows.mapInArrow(_negatives(shared, primes, k_neg, num, den), FOUND)
    ranked = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    found.withColumn("rank", ranked).where(F.col("rank") <= k_neg).write.parquet(path)
    shared.destroy()

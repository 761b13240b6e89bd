import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import hard_negatives as hn


def brute(rows, every=10, k=5):
    """The contract, pair by pair."""
    whole = {}
    for i, label, v in sorted((r for r in rows if None not in r and all(x is not None and math.isfinite(x) for x in r[2])), key=lambda r: (r[0], r[1], r[2])):
        whole.setdefault(i, (label, [math.floor(256 * x) for x in v]))
    out = []
    for a, (label, v) in whole.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, own) for i, (own, w) in whole.items() if i != a)
        for ps, p, _ in [s for s in scored if s[2] == label][:k]:
            fit = [s for s in scored if s[2] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps][:k]
            out += [(a, p, rank, n, -ps, -ns) for rank, (ns, n, _) in enumerate(fit, 1)]
    return sorted(out)


def vectors(rng, n, dims, near=0.4):
    base = [rng.gauss(0, 1) for _ in range(dims)]
    return [(i, rng.randint(0, 3), [float(np.float32(b + near * rng.gauss(0, 1))) for b in base]) for i in range(n)]


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, label int, embedding array<float>, rank int").repartition(3)
    found = hn.mine_hard_negatives(df, F.col("vec_id"), F.col("embedding"), F.col("label"), F.col("id") % 10 == 0, **more)
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in found.collect())


def test_against_brute_force_with_gaps_ties_and_repeats(spark):
    rng = random.Random(13)
    rows = vectors(rng, 300, 9)
    copy = rows[40][2]
    rows += [(400 + i, i % 3, copy) for i in range(80)]  # one very common vector
    rows += [(500, None, copy), (501, 1, None), (502, 1, [*copy[:8], None]), (503, 2, [*copy[:8], math.nan]), (504, 2, [*copy[:8], math.inf])]
    rows += [(None, 1, copy), (510, 1, copy[:4]), (511, 0, []), rows[3], rows[3], (rows[5][0], 3, copy), (-20, 2, copy), (520, 1, [-x for x in copy])]
    got = run(spark, rows)
    assert got == brute(rows) and len({r[0] for r in got}) > 20


@pytest.mark.parametrize("dims, size", [(3, 0.1), (70, 1.0), (200, 3000.0)])
def test_scores_are_exact_at_every_size(spark, monkeypatch, dims, size):
    monkeypatch.setattr(hn, "TASK_ROWS", 16)
    monkeypatch.setattr(hn, "TILE_ROWS", 7)
    monkeypatch.setattr(hn, "TILE_ANCHORS", 2)
    rows = [(i, label, [size * x for x in v]) for i, label, v in vectors(random.Random(dims), 90, dims, 0.2)]
    rows = [(i, label, [float(np.float32(x)) for x in v]) for i, label, v in rows]
    assert run(spark, rows, block_bytes=dims * 8 * 4) == brute(rows)


def test_residues_give_signed_products_back():
    rng = np.random.default_rng(2)
    for top, dims in ((10, 5), (300, 64), (40_000, 130), (10**6, 64)):
        a, b = rng.integers(-top, top, (20, dims)), rng.integers(-top, top, (30, dims))
        primes = hn.primes_for(float(top) * top * dims)
        assert np.array_equal(hn.exact_scores(hn.residues(a, primes), hn.residues(b, primes), primes), a @ b.T)
    assert (max(hn.PRIMES) // 2) ** 2 * hn.DIMS <= 1 << 24
    assert len(hn.primes_for(1.0)) == 1
    with pytest.raises(ValueError):
        hn.primes_for(1e19)


def test_no_rows_no_anchors(spark):
    rows = vectors(random.Random(1), 9, 3)
    assert run(spark, [r for r in rows if r[0]]) == []
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hn.mine_hard_negatives(empty, F.col("vec_id"), F.col("embedding"), F.col("label"), F.col("id") % 10 == 0).count() == 0

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm.components import components
from corpusflow.llm.jaccard import _blocked, _profile, jaccard_components, jaccard_groups, prefix_entries
from tests.llm.helpers import invented, shingle_set


def brute(rows, width, num, den):
    sets = {i: shingle_set(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def collection(seed):
    """Copies, chains of near copies, a group of many near copies, texts that share a long passage, odd ones."""
    rng = random.Random(seed)
    passage = invented(rng, 60)
    texts = [None, "", "  \n", "One", "one", "one two", "One Two", "a b c", "A b  c"]
    for _ in range(12):
        text = invented(rng, rng.randint(5, 200)).split()
        for _ in range(rng.randint(1, 6)):
            texts.append(" ".join(text))
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = invented(rng, 1)
    base = invented(rng, 150).split()
    for _ in range(60):
        near = list(base)
        near[rng.randrange(len(near))] = invented(rng, 1)
        texts.append(" ".join(near))
    texts += [f"{invented(rng, 30)} {passage} {invented(rng, 30)}" for _ in range(60)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, width, num", [(1, 3, 90), (2, 3, 90), (3, 5, 80), (4, 2, 60)])
def test_components_are_those_of_all_pairs(spark, seed, width, num):
    rows = collection(seed)
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, cls string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(df, width=width, num=num).collect()}
    assert got == brute(rows, width, num, 100)


@pytest.mark.parametrize("num, den", [(90, 100), (80, 100), (60, 100)])
def test_similar_sets_share_an_entry_whatever_is_frequent(num, den):
    rng = np.random.default_rng(4)
    for _ in range(400):
        n = int(rng.integers(2, 300))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        swap = rng.random(len(a)) < rng.random() * (1 - num / den)
        b = np.unique(np.concatenate([a[~swap], rng.integers(0, 1 << 63, int(swap.sum() * rng.random())).astype(np.uint64)]))
        inter = len(np.intersect1d(a, b))
        if not inter or den * inter < num * (len(a) + len(b) - inter) or np.array_equal(a, b):
            continue
        for share in (0.0, 0.5, 1.0):
            # Shingles of one set alone are known as such, or taken for shared ones.
            kinds = []
            for x, y in ((a, b), (b, a)):
                alone = ~np.isin(x, y) & (x % np.uint64(7) < 5)
                kinds.append(np.where(alone, 0, 1 + (x % np.uint64(1000) < np.uint64(int(1000 * share)))))
            one, two = prefix_entries(a, kinds[0], num, den), prefix_entries(b, kinds[1], num, den)
            assert len(np.intersect1d(one[0], two[0])) or len(np.intersect1d(one[1], two[1]))


@pytest.mark.parametrize("seed, block", [(1, 256)])
def test_few_large_sets_leave_blocks_empty(spark, monkeypatch, seed, block):
    monkeypatch.setattr("corpusflow.llm.jaccard.BLOCK_BYTES", block)
    base = invented(random.Random(seed), 60).split()
    texts = [" ".join([*base[:k], "changed", *base[k + 1 :]]) for k in (5, 5, 20, 59)] + [" ".join(base[:40])]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    named = df.selectExpr("doc_id AS doc", "text", "xxhash64(text) AS body")
    profile = _profile(named, 3)
    classes = profile.groupBy("cls").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "body")).alias("rep"))
    members = profile.select(F.lit(1).cast("long").alias("entry"), "cls").distinct()
    known = spark.createDataFrame([], "node long, root long")
    links = _blocked(members, known, named, classes, 3, 80, 100)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    got = {r["doc"]: roots.get(r["cls"], r["cls"]) for r in profile.collect()}
    want = {i: root for i, (_, root) in brute(rows, 3, 80, 100).items()}
    assert all((got[i] == got[j]) == (want[i] == want[j]) for i in got for j in got)
    assert len(set(want.values())) == 2


def test_prefixes_grow_with_the_text_not_its_square():
    tokens = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64) * np.uint64(2))
    entries = lambda kind: [len(x) for x in prefix_entries(tokens, np.full(len(tokens), kind), 90, 100)[:2]]
    assert entries(0) == [0, 0] and entries(1) == [2001, 0] and 0 < entries(2)[1] < len(tokens)


def test_repeated_rows_rows_without_id_and_no_rows(spark):
    schema = "doc_id long, text string"
    text = invented(random.Random(8), 40)
    df = spark.createDataFrame([(4, text), (4, text), (None, text), (9, text), (None, "other words here"), (None, None)], schema)
    got = sorted((r["doc_id"] or -1, r["component_id"]) for r in jaccard_components(df).collect() if r["n_shingles"] > 1)
    assert got == [(-1, 4), (4, 4), (4, 4), (9, 4)]
    assert all(r["component_id"] is None for r in jaccard_components(df).collect() if r["n_shingles"] <= 1)
    assert jaccard_components(spark.createDataFrame([], schema)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_lead_through_documents_without_id(spark):
    words = [f"w{i}" for i in range(200)]
    text = lambda a, b: " ".join(words[a:b])
    chain = [text(0, 160), text(8, 168), text(16, 176)]  # neighbours are similar, the ends are not
    for ids, want in (((1, None, 3), [1, 1, 1]), ((1, 2, 3), [1, 1, 1]), ((None, None, None), [None] * 3)):
        df = spark.createDataFrame([*zip(ids, chain), *zip(ids, chain)], "doc_id long, text string")
        got = jaccard_components(df, num=85).collect()
        assert [r["component_id"] for r in got] == sorted(want * 2, key=str) if want[0] else all(r["component_id"] is None for r in got)
        assert len({r["group"] for r in jaccard_groups(df, num=85).collect()}) == 1


def test_different_texts_under_one_id_link_each_by_itself(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    df = spark.createDataFrame([(2, a), (2, b), (7, a + " x"), (9, b + " y")], "doc_id long, text string")
    got = jaccard_groups(df).collect()
    assert len({r["group"] for r in got}) == 2 and all(r["component_id"] == 2 for r in got)

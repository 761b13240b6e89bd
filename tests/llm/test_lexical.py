import math
import random
import re
from collections import Counter
from urllib.parse import urlparse

import numpy as np
import pyarrow.parquet as pq
import pytest

from corpusflow.llm import lexical
from corpusflow.llm.slices import BATCH_ROWS
from tests.llm.helpers import ASCII_LOWER, invented

TERM = re.compile(lexical.TERM)


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def brute(docs, items, k=10):
    """The contract, document by document."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in dict.fromkeys(items):
        asked = set(terms(text)) & set(df)
        scores = []
        for i, c, n in held:
            m = 10 + 90 * n * n_docs // total
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if no else i, -s) for rank, (s, no, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(rng, n=400):
    docs = [(i, invented(rng, rng.randint(1, 60))) for i in range(n)]
    copy = invented(rng, 30)
    docs += [(1000 + i, copy) for i in range(40)]  # ties
    docs += [(None, copy), (None, None), (2000, None), (2001, ""), (2002, " .,; "), (2003, "Ñandú ÑANDÚ 日本 naïve a1B2 _a1b2"), (5, "twice one id"), (5, "twice one id")]
    docs.append((3000, invented(rng, 20_000)))
    rng.shuffle(docs)
    items = [(i, invented(rng, rng.randint(1, 25))) for i in range(30)]
    items += [(100, copy), (100, copy), (101, None), (102, "?"), (103, "ñandú Ñandú A1b2"), (None, "ka lo"), (104, "unheardofword"), (105, "one id"), (106, docs[3][1] or "ka")]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, score int").repartition(5)
    return d, spark.createDataFrame(items, "item_id long, text string")


def rows(found):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect()), key=str)


@pytest.mark.parametrize("shard_docs, block_bytes", [(4096, 4 << 20), (16, 600), (1, 4 << 20)])
def test_search_against_brute_force(spark, monkeypatch, shard_docs, block_bytes):
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard_docs)
    docs, items = corpus(random.Random(11), 400 if shard_docs > 1 else 60)
    d, q = frames(spark, docs, items)
    index = lexical.build_index(d)
    assert rows(lexical.search_index(index, q, block_bytes=block_bytes)) == brute(docs, items)


def test_every_row_is_indexed(spark):
    docs, _ = corpus(random.Random(3))
    index = lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    with_terms = [i for i, t in docs if terms(t)]
    got = [None if no else i for r in index.shards.collect() for i, no in zip(r["ids"], r["no_id"])]
    assert Counter(got) == Counter(with_terms)
    assert (index.documents, index.terms) == (len(with_terms), sum(len(terms(t)) for _, t in docs))


def test_a_task_holds_one_shard_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_DOCS", 16)
    docs, items = corpus(random.Random(7))
    d, q = frames(spark, docs, items)
    index = lexical.build_index(d.coalesce(1))
    stored = [pq.ParquetFile(urlparse(f).path).metadata for f in index.shards.inputFiles()]
    assert (groups := [m.row_group(g).num_rows for m in stored for g in range(m.num_row_groups)]) == [1] * len(groups) and len(groups) > 20
    hits = lexical._hits

    def one_each(shared, k):
        walk = hits(shared, k)

        def single(batches):
            for batch in batches:
                assert batch.num_rows == 1
                yield batch

        return lambda batches: walk(single(batches))

    monkeypatch.setattr(lexical, "_hits", one_each)
    assert rows(lexical.search_index(index, q)) == brute(docs, items)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == str(BATCH_ROWS)


def test_packed_arrays_come_back():
    for array in (np.zeros(0, np.uint16), np.arange(70_000, dtype=np.uint16), np.array([2**64 - 1, 0], np.uint64)):
        (value,) = lexical.pa.array([lexical._pack(array)], lexical.pa.binary())
        assert lexical._unpack(value, array.dtype.type).tolist() == array.tolist()


def test_bounds_hold_and_prune(monkeypatch):
    monkeypatch.setattr(lexical, "FIRST_RANGES", 1)
    monkeypatch.setattr(lexical, "MOST_RANGES", 1)
    rng = random.Random(5)
    texts = [invented(rng, 60) for _ in range(900)]
    texts[17] += " alpha beta gamma delta"
    doc, term, tf, size = lexical.terms_of(texts)
    names, row, dfs = np.unique(term, return_inverse=True, return_counts=True)
    treap = lexical.Treap.build(np.arange(900), np.zeros(900, bool), doc, names, row, dfs, 1_000_000 * tf // (tf + 1))
    # A leaf for each posting, and no node without one below it.
    assert int((treap.masks == 0).sum()) == len(doc) and len(treap.masks) < 2.5 * len(doc)
    asked = treap.rows_of(np.unique(lexical.terms_of(["alpha beta gamma delta ka"])[1]))
    found, seen = lexical.Found(1), []
    halves = treap._halves
    treap._halves = lambda node, *a: (seen.append(len(node)), halves(node, *a))[1]
    treap.search(asked, np.full(len(asked), 1000), found)
    assert found.id.tolist() == [17]
    assert sum(seen) < 400


def test_nothing_to_index_or_to_ask(spark):
    docs, items = frames(spark, [(1, "a b c")], [(1, "a")])
    assert rows(lexical.search(docs.limit(0), items)) == []
    assert rows(lexical.search(docs, items.limit(0))) == []
    assert rows(lexical.search(docs, items)) == brute([(1, "a b c")], [(1, "a")])
    named = spark.createDataFrame([("x", "b"), ("y", "c")], "item_id string, text string")
    assert [r["item_id"] for r in lexical.search(docs, named).orderBy("item_id").collect()] == ["x", "y"]

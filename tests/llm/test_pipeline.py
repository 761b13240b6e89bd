import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from corpusflow.llm import queries
from corpusflow.llm.decontaminate import edits_within
from corpusflow.llm.language_id import letter_words
from tests.llm.helpers import invented, shingle_set
from tests.llm.test_jaccard import brute as brute_components
from tests.llm.test_language import PARTS
from tests.llm.test_line_dedup import brute as brute_lines
from tools.compare import compare, connect

SF = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(queries.ORACLES) <= names


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries(spark, name):
    ok, text = compare(spark, connect(SF), name, queries.QUERIES[name], queries.ORACLES.get(name), SF)
    assert ok, text


def _documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long")


def _rows():
    rng = random.Random(6)
    shared = invented(rng, 60, PARTS["aa"])
    rows = [(i, "\n".join(invented(rng, rng.randint(4, 30), PARTS[lang]) for _ in range(rng.randint(1, 6))), lang, "s") for i, lang in enumerate(["aa", "bb", "ru"] * 25)]
    rows += [(100 + i, f"{shared}\n{invented(rng, 40, PARTS['aa'])}", "aa", "s") for i in range(8)]
    near = invented(rng, 120, PARTS["bb"]).split()
    for i in range(8):
        near[7 * i] = invented(rng, 1)
        rows.append((200 + i, " ".join(near), "bb", "s"))
    return [*rows, (300, None, "aa", "s"), (301, "", None, None), (302, "12 34", "aa", "s"), (303, "日本語", None, "s"), (304, rows[4][1], None, None)]


def test_stages_against_plain_counterparts(spark, tmp_path):
    rng = random.Random(7)
    rows = _rows()
    items = [(1, invented(rng, 30, PARTS["aa"])), (2, invented(rng, 12, PARTS["bb"]))]
    rows += [(400, f"{invented(rng, 30, PARTS['aa'])} {items[0][1]} {invented(rng, 9, PARTS['aa'])}", "aa", "s"), (401, items[1][1], "bb", "s")]
    _documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, str(tmp_path))
        if name != "bpe":
            assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept[name] = {r["doc_id"]: r for r in docs.collect()}

    assert set(kept["language_id"]) == {r[0] for r in rows} - {300, 301, 302, 303}
    before = {i: r["text"] for i, r in kept["language_id"].items()}
    lines = brute_lines(sorted(before.items()))
    want = {i: t for i, (t, n) in lines.items() if not n or t.strip()}
    assert {i: r["text"] for i, r in kept["line_dedup"].items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in kept["line_dedup"].values())
    groups = brute_components(sorted(want.items()), 5, 80, 100)
    assert set(kept["jaccard_join"]) == {i for i, (_, c) in groups.items() if c == i}
    assert len([i for i in kept["jaccard_join"] if 200 <= i < 300]) == 1
    leaks = lambda t: any(edits_within(letter_words([x]).key, letter_words([t]).key) <= len(x.split()) // 5 for _, x in items)
    clean = {i for i, r in kept["jaccard_join"].items() if not leaks(r["text"])}
    assert set(kept["decontamination"]) == clean and not {400, 401} & clean
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, r in kept["bpe"].items():
        assert r["ids"] == library.encode(kept["decontamination"][i]["text"], add_special_tokens=False).ids and r["round_trip"]
    run = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert run == {i: r["ids"] for i, r in kept["bpe"].items()}


def test_stages_take_nulls_repeated_rows_and_no_rows(spark):
    text = "a b c d e f g h i j k l m n o p"
    rows = [(1, text, "aa", "s"), (1, text, "aa", "s"), (None, text, "aa", None), (2, None, None, None), (None, None, None, None), (3, "", "bb", "s"), (4, text + " q", "aa", "s")]
    odd = _documents(spark, rows).withColumn("n_chars", F.lit(None).cast("long"))
    for _, step in corpus_pipeline.STAGES:
        for docs in (odd, odd.limit(0)):
            assert step(spark, docs, SF).count() <= docs.count()
    found = corpus_pipeline.drop_near_duplicates(spark, odd, SF)
    assert sorted(r["doc_id"] or 0 for r in found.where("text is not null and text != ''").collect()) == [0, 1]


def test_near_duplicates_under_a_shared_id(spark):
    rng = random.Random(9)
    x, y = invented(rng, 80), invented(rng, 80)
    rows = [(1, x, "aa", "s"), (2, x + " more", "aa", "s"), (2, y, "aa", "s"), (2, y, "aa", "t"), (None, x, "aa", "s"), (None, x, "aa", "s"), (3, None, None, None), (3, None, None, None)]
    got = corpus_pipeline.drop_near_duplicates(spark, _documents(spark, rows), SF).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted([(1, x), (2, y), (None, x), (None, x), (3, None)], key=str)


def test_shingles_of_the_stage():
    assert len(shingle_set("a b c d e f", corpus_pipeline.SHINGLE)) == 2

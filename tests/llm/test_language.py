import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from corpusflow.llm import language_id as lid
from tests.llm.helpers import invented

PARTS = {"aa": "the ing ation ould wh sh".split(), "bb": "eau oux ère que ment oi".split(), "ru": "ать ого ный ств про ени".split()}


def _labelled(n=60, seed=1):
    rng = random.Random(seed)
    return [(f"{lang}{i}", invented(rng, rng.randint(5, 60), parts), lang) for i in range(n) for lang, parts in PARTS.items()]


def _path(scores, penalty):
    best, back = list(scores[0]), []
    for s in scores[1:]:
        top = max(range(len(best)), key=best.__getitem__)
        back.append([l if best[l] >= best[top] - penalty else top for l in range(len(best))])
        best = [best[b] - (penalty if b != l else 0) + s[l] for l, b in enumerate(back[-1])]
    return max(best)


def _value(scores, path, penalty):
    return sum(scores[t][l] for t, l in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))


def test_best_path_is_optimal():
    rng = np.random.default_rng(2)
    counts = [0, 1, 63, 64, 65, 200, 0, 3, 128, 129]
    first = np.concatenate([[0], np.cumsum(counts)])
    scores = -rng.random((first[-1], 4)).astype(np.float32) * 3
    for penalty in (0.0, 0.7, 4.0):
        got = lid.best_path(scores, first, penalty)
        for a, b in zip(first[:-1], first[1:]):
            if b > a:
                part = scores[a:b].astype(float)
                assert abs(_value(part, got[a:b], penalty) - _path(part, penalty)) < 1e-3


def test_texts_and_spans(spark):
    df = spark.createDataFrame(_labelled(), "id string, text string, lang string")
    model = lid.fit_model(df, "text", "lang")
    assert model.languages == sorted(PARTS)
    held = [(i, t, lang) for i, t, lang in _labelled(30, seed=9)]
    rng = random.Random(3)
    first, second = invented(rng, 40, PARTS["aa"]), invented(rng, 40, PARTS["bb"])
    odd = [("null", None, "x"), ("empty", "", "x"), ("digits", "123 !? 4", "x"), ("mixed", f"{first}. {second}", "x"), ("far", "日本語の文章", "x")]
    rows = spark.createDataFrame(held + odd, "id string, text string, language string").repartition(3)
    got = {r["id"]: r["language"] for r in lid.identify_languages(rows, model).collect()}
    assert np.mean([got[i]["lang"] == lang for i, _, lang in held]) > 0.98
    assert all(got[k]["lang"] == "und" and got[k]["score"] == 0.0 and got[k]["spans"] == [] for k in ("null", "empty", "digits"))
    spans = got["mixed"]["spans"]
    assert [s["lang"] for s in spans] == ["aa", "bb"] and abs(spans[1]["begin"] - len(first)) < 15
    assert spans[0]["begin"] == 0 and spans[-1]["end"] == len(first) + 2 + len(second)
    assert got["far"]["lang"] in PARTS and got["far"]["score"] == 0.0


def test_script_narrows_the_candidates(spark):
    model = lid.fit_model(spark.createDataFrame(_labelled(), "id string, text string, lang string"), "text", "lang")
    cyrillic, latin = (model.candidates[lid.SCRIPT_NAMES.index(n)].tolist() for n in ("cyrillic", "latin"))
    assert cyrillic == [False, False, True] and latin == [True, True, False]


def test_a_language_of_few_texts_and_many_copies_is_taken_whole(spark):
    few = [("c", t, "ru") for _, t, lang in _labelled(3, seed=4) if lang == "ru"]
    rows = [r for r in _labelled() if r[2] != "ru"] + few * 2000
    model = lid.fit_model(spark.createDataFrame(rows, "id string, text string, lang string"), "text", "lang", rows=10)
    alone = lid.fit_model(spark.createDataFrame(few, "id string, text string, lang string"), "text", "lang", rows=10)
    assert model.languages == sorted(PARTS)
    assert np.array_equal(model.table[:, 2], alone.table[:, 0])
    df = spark.createDataFrame([("1", invented(random.Random(7), 30, PARTS["ru"]))], "id string, text string")
    found = lid.identify_languages(df, model).first()["language"]
    assert found["lang"] == "ru" and found["score"] == 1.0


def test_no_labels_no_rows_and_the_fold(spark):
    schema = "id string, text string, lang string"
    none = lid.fit_model(spark.createDataFrame([("1", "words", None), ("2", None, "aa")], schema), "text", "lang")
    df = spark.createDataFrame([("1", "words", None)], schema)
    assert lid.identify_languages(df, none).first()["language"]["lang"] == "und"
    assert lid.identify_languages(df.limit(0), none).count() == 0
    rows = spark.range(50).withColumn("f", lid.fold(F.col("id"), 3)).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in rows)


def test_marks_alone_are_no_words(spark):
    rows = [(1, "one two three", "aa"), (2, "\u2764\ufe0f", None), (3, "\u0301", None), (4, "12 \u0301 !", None), (5, "e\u0301te\u0301", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["language"] for r in lid.identify_languages(df, lid.fit_model(df, "text", "lang")).collect()}
    assert [(got[i]["lang"], got[i]["score"], got[i]["spans"]) for i in (2, 3, 4)] == [("und", 0.0, [])] * 3
    assert got[5]["lang"] == "aa" and [(x["begin"], x["end"]) for x in got[5]["spans"]] == [(0, 5)]

import random
from collections import Counter

from pyspark.sql import functions as F

from corpusflow.llm import quality_cascade as quality
from tests.llm.helpers import WORD, invented


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def _texts():
    rng = random.Random(4)
    texts = [None, "", " \n\t", "one", "a b c a b c", "x " * 500, "a b a b a b", "#*$%&|<> é漢😀", "l\nl\nl\n\n\n", "a\x0bb\x0cc\rd", "wörter " * 80]
    for _ in range(80):
        words = invented(rng, rng.randint(1, 120)).split()
        texts.append("".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in words + words[: rng.randint(0, 10)]))
    return texts


def test_counts(spark):
    texts = _texts()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)
    t = F.col("text")
    rows = df.select("i", quality.n_words(t), quality.word_chars(t), quality.n_symbols(t), quality.n_dup_lines(t), quality.n_repeat_words(t)).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == {i: plain(x) for i, x in enumerate(texts)}


def test_order_decides_the_work_not_the_verdict(spark):
    df = spark.createDataFrame(list(enumerate(_texts())), "i int, text string")
    rules = quality.standard_rules(F.col("text"))
    kept = [sorted(r["i"] for r in quality.apply_cascade(df, order).where("rejected_by is null").collect()) for order in (rules, rules[::-1])]
    assert kept[0] == kept[1]
    plan = quality.apply_cascade(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_rules_are_ordered_by_rejection_per_cost(spark):
    df = spark.range(400).select("id", F.lit("word " * 300).alias("text"))
    rules = [
        quality.Rule("never", F.col("id") < 0),
        quality.Rule("often", F.col("id") % 2 == 0),
        quality.Rule("dear", (quality.n_repeat_words(F.col("text")) > 0) & (F.col("id") % 2 == 0)),
    ]
    found = quality.measure_rules(df, rules, ["id", "text"], sample_rows=10_000)
    assert [m.rule.name for m in found] == ["often", "dear", "never"]
    assert found[0].selectivity == found[1].selectivity == 0.5 and found[1].cost > found[0].cost


def test_clashing_columns_null_verdicts_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, "old"), (2, "fine " * 60, "old")], "id int, text string, rejected_by string")
    assert [r["id"] for r in quality.filter_quality(df, sample_rows=10).collect()] == []
    text = invented(random.Random(1), 80)
    df = spark.createDataFrame([(1, None, "old"), (2, text, "old")], "id int, text string, rejected_by string")
    assert quality.filter_quality(df).collect()[0]["rejected_by"] == "old"
    null = quality.apply_cascade(df, [quality.Rule("null", F.col("text") == "x")], "verdict").where("verdict is null").count()
    assert null == 2
    assert quality.filter_quality(df.limit(0)).count() == 0


def test_the_query_works_each_count_out_once(spark, tmp_path):
    from corpusflow.llm import queries

    spark.createDataFrame([(i, t) for i, t in enumerate(_texts())], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    dear = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("sort_array(")
    alone = spark.read.parquet(f"{tmp_path}/documents.parquet").select(quality.n_repeat_words(F.col("text")).alias("n"))
    assert dear(queries.op8_quality_cascade(spark, str(tmp_path))) == dear(alone) > 0

import random

import corpus_pipeline
from corpusflow.llm import line_dedup
from corpusflow.llm.line_dedup import dedup_lines
from tests.llm.helpers import invented, levenshtein


def brute(rows, least=20):
    """Expected text and number of dropped lines of each document."""
    first, order = {}, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for pos, line in enumerate(text.split("\n") if text is not None else []):
            if len(line.strip(" ")) >= least and line not in first:
                first[line] = (doc, pos)
                order.append(line)
    near = {b for k, b in enumerate(order) for a in order[:k] if abs(len(a) - len(b)) <= 1 and levenshtein(a, b) == 1}
    out = {}
    for doc, text in rows:
        if text is None:
            out[doc] = (None, 0)
            continue
        lines = text.split("\n")
        kept = [x for pos, x in enumerate(lines) if x not in first or (first[x] == (doc, pos) and x not in near)]
        out[doc] = ("\n".join(kept), len(lines) - len(kept))
    return out


def collection(seed):
    rng = random.Random(seed)
    pool = [invented(rng, rng.randint(1, 9)) for _ in range(60)] + ["aaaaaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaaa", "é" * 25, "é" * 24 + "è", "😀" * 21, "😀" * 22]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 8)):
            line = rng.choice(pool)
            if rng.random() < 0.5 and line:
                p = rng.randrange(len(line))
                line = rng.choice([line[:p] + line[p + 1 :], line[:p] + rng.choice("xyz ") + line[p:], line[:p] + "q" + line[p + 1 :]])
            lines.append(line)
        rows.append((i, "\n".join(lines)))
    return [*rows, (500, None), (501, ""), (502, "\n\n"), (503, pool[5] + "\n" + pool[5])]


def test_lines_dropped_are_those_of_all_pairs(spark):
    for seed in (1, 2, 3):
        rows = collection(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = {r["doc_id"]: (r["text"], r["dropped_lines"]) for r in dedup_lines(df).collect()}
        assert got == brute(rows)


def test_columns_with_clashing_names_repeated_rows_and_null_ids(spark):
    line = "a line that is long enough to count"
    names = "doc_id long, text string, doc string, body long, line string, at int, dropped_lines string, `a.b` int"
    rows = [(1, line, "d", 1, "l", 2, "x", 3), (1, line, "d", 1, "l", 2, "x", 3), (2, line + "!", None, None, None, None, None, None), (None, line + "?\nown", "n", 0, "", 0, "", 0)]
    got = dedup_lines(spark.createDataFrame(rows, names))
    assert got.columns == ["doc_id", "text", "doc", "body", "line", "at", "a.b", "dropped_lines"]
    found = sorted((r["doc_id"] or 0, r["text"], r["dropped_lines"], r["doc"]) for r in got.collect())
    # The row without an id is the earliest; the others lie one edit from it or from each other.
    assert found == [(0, line + "?\nown", 0, "n"), (1, "", 1, "d"), (1, "", 1, "d"), (2, "", 1, None)]


def test_short_repeats_with_a_word_go_at_every_length(spark):
    rows = [(1, "Read more\n---\n今日は雨です。\n7"), (2, "Read more\n---\n今日は雨です。\nRead morr"), (3, "7\n\n\nRead more")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["dropped_lines"]) for r in dedup_lines(df, short_repeats=True).collect()}
    # Lines without a word stay, and one edit is not enough for short ones.
    assert got == {1: (rows[0][1], 0), 2: ("---\nRead morr", 2), 3: ("\n", 2)}
    docs = df.selectExpr("doc_id", "text", "'aa' AS lang", "'s' AS source", "length(text) AS n_chars")
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()}
    assert left == {1: rows[0][1], 2: "---\nRead morr"}


def test_empty_table_and_long_lines(spark):
    schema = "doc_id long, text string"
    assert dedup_lines(spark.createDataFrame([], schema)).count() == 0
    long = invented(random.Random(2), 900)
    df = spark.createDataFrame([(1, long), (2, long[:3000] + long[3001:]), (3, long[:50] + "##" + long[50:])], schema)
    assert {r["doc_id"]: r["dropped_lines"] for r in dedup_lines(df).collect()} == {1: 0, 2: 1, 3: 0}


def test_narrowing_loses_no_line(spark, monkeypatch):
    """The same rows however far windows are cut."""
    schema = "doc_id long, text string"
    for span, parts in ((1, 2), (1, 16), (5, 3)):
        monkeypatch.setattr(line_dedup, "SPAN", span)
        monkeypatch.setattr(line_dedup, "PARTS", parts)
        rows = collection(4)
        got = {r["doc_id"]: (r["text"], r["dropped_lines"]) for r in dedup_lines(spark.createDataFrame(rows, schema)).collect()}
        assert got == brute(rows)


def one_edit(a, b):
    """Does one character put in, left out or changed make ``b`` of ``a``?"""
    if len(a) > len(b):
        a, b = b, a
    p = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (len(a) + 1 == len(b) and a[p:] == b[p + 1 :] or len(a) == len(b) and a[p + 1 :] == b[p + 1 :])


def test_edits_at_every_place_of_long_lines(spark):
    """Lengths around those at which windows are cut once or twice more, edits at both ends and at the windows' ends."""
    rng = random.Random(11)
    lines = []
    for n in (127, 128, 129, 130, 300, 1023, 1024, 1025, 1026, 2300):
        line = "".join(rng.choices("abcd é😀", k=n - 1)) + "."
        places = {0, 1, n // 2 - 1, n // 2, n // 2 + 1, n - 1, *(k * -(-n // 16) + d for k in range(1, 16, 5) for d in (-1, 0, 1)), *rng.sample(range(n), 4)}
        for p in (p for p in places if 0 <= p < n):
            lines += [line[:p] + "Z" + line[p + 1 :], line[:p] + "Z" + line[p:], line[:p] + line[p + 1 :]]
        lines += [line + "Z", line[:5] + "QQ" + line[5:], line[: n // 3] + "Q" + line[n // 3 : n // 2] + "Q" + line[n // 2 :], line]
    rng.shuffle(lines)
    rows = list(enumerate(lines))
    got = {r["doc_id"]: r["dropped_lines"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    near = lambda i, x: any(a == x or abs(len(a) - len(x)) <= 1 and one_edit(a, x) for a in lines[:i])
    assert got == {i: int(near(i, x)) for i, x in rows}


def test_lines_of_a_megabyte(spark):
    line = "".join(random.Random(7).choices("abcdefgh é😀", k=1_000_000))
    p = 700_001
    rows = [(1, line), (2, line[:p] + line[p + 1 :]), (3, line[:p] + "Z" + line[p:]), (4, line[:p] + "Y" + line[p + 1 :]), (5, line[::-1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["dropped_lines"] for r in dedup_lines(df).collect()} == {1: 0, 2: 1, 3: 1, 4: 1, 5: 0}


def test_no_python_on_the_path(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert "Python" not in dedup_lines(df)._jdf.queryExecution().executedPlan().toString()

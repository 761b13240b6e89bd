"""Scalar functions on hand-written edge cases."""

from pyspark.sql import functions as F

from corpusflow import constants as K
from corpusflow.functions import arrays, columns, text
from corpusflow.operators import quality
from corpusflow.operators.rows import format_people_text


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_normalize_id(spark):
    raw = [" a ", "\t b ", "nan", "NaN", "", None, " x "]
    assert apply(spark, raw, columns.normalize_id) == ["a", "b", None, None, None, None, "x"]


def test_strip_removes_what_python_strips(spark):
    raw = [c + "x" + c for c in K.WHITESPACE] + ["​x​"]
    assert apply(spark, raw, columns.strip) == [r.strip() for r in raw]
    assert all(c.isspace() for c in K.WHITESPACE)
    assert sum(chr(i).isspace() for i in range(0x110000)) == len(K.WHITESPACE)


def test_to_number(spark):
    raw = ["1.5", " 1.5 ", "1e3", "abc", "1d", "nan", "", None, "+.5", "0x10", "5."]
    want = [1.5, 1.5, 1000.0, None, None, None, None, None, 0.5, None, 5.0]
    assert apply(spark, raw, columns.to_number) == want
    whole = ["7", " 7 ", "x", "7.0", "7.5", "inf", "99999999999"]
    assert apply(spark, whole, lambda c: columns.to_number(c, "int")) == [7, 7, None, 7, None, None, None]
    assert apply(spark, ["inf"], columns.to_number) == [float("inf")]


def test_format_people_text(spark):
    raw = [
        "[{'name': 'A'}, {'profile': {'name': 'B'}}, 'C', None]",
        "[None]",
        "A & B ",
        None,
        '[{"name": "D"}, {"name": "E \\u00e9"}]',
        "[broken",
        "[]",
        "  ",
        "[{'name': '', 'profile': {'name': 'F'}}]",
        "[{'name': \"O'Neil\"}]",
    ]
    want = ["A, B, C", "", "A & B", "", "D, E é", "[broken", "", "", "F", "O'Neil"]
    assert apply(spark, raw, format_people_text) == want


def test_format_people_native(spark):
    values = [["A", " B ", "", None], [None], [], None]
    assert apply(spark, values, columns.format_people, "array<string>") == ["A, B", "", "", ""]


def test_valid_url(spark):
    raw = [" http://a ", "https://b", "ftp://c", None, ""]
    assert apply(spark, raw, columns.valid_url) == ["http://a", "https://b", "", "", ""]


def test_quadrant(spark):
    df = spark.createDataFrame(
        [(0.5, 0.5), (0.49, 0.5), (0.5, 0.49), (0.0, 0.0), (None, 0.9), (float("nan"), 0.1)], "v double, e double"
    )
    got = [r[0] for r in df.select(columns.quadrant("v", "e")).collect()]
    assert got == [3, 1, 2, 0, 1, 0]


def test_titles(spark):
    raw = ["Liên Khúc 1", "Best Of X", "a [LK] b", "a lk", "lk x", "Remix A", "x mix y", "x mix", " lk", "lk ", None]
    want = [True, True, True, True, True, False, True, False, False, False, False]
    assert apply(spark, raw, text.title_matches) == want
    assert len(K.COMPILATION_KEYWORDS) == 63


def test_titles_equal_plain_containment(spark):
    raw = [f"zz{k.upper()}zz" for k in K.COMPILATION_KEYWORDS] + ["nothing", "mixt", "bestof"]
    want = [any(k in r.lower().strip() for k in K.COMPILATION_KEYWORDS) for r in raw]
    assert apply(spark, raw, text.title_matches) == want


def test_marker_lines(spark):
    three = "(A)\nx\n[B]\n【C】"
    raw = [three, "(A)\n[B]", "x (C)\n(D) y", " (A) \n [B]\n\n(C)", "(A) (B)", None]
    assert apply(spark, raw, text.marker_lines) == [3, 2, 0, 3, 1, 0]
    assert apply(spark, raw[:2], text.many_markers) == [True, False]


def test_too_long(spark):
    raw = ["x" * 6000, "x" * 6001, " " + "x" * 6000 + "\n", "é" * 6001, None]
    assert apply(spark, raw, text.too_long) == [False, True, False, True, False]


def test_compilation_reason_skips_missing_texts(spark):
    df = spark.createDataFrame(
        [("best of", None), ("a", "x" * 7000), ("a", "(A)\n(B)\n(C)" + "x" * 0), ("a", K.NO_TEXT), (None, "words")],
        "t string, x string",
    )
    got = [r[0] for r in df.select(text.compilation_reason("t", "x")).collect()]
    assert got == ["title", "length", "markers", None, None]


def test_tokenize(spark):
    raw = ['Anh, yêu_em!  "x"', "èa", "", "...", " ".join(["w"] * 201)]
    got = apply(spark, raw, text.tokenize)
    assert got[:4] == [["anh", "yêu_em", "x"], ["e", "a"], [], []] and len(got[4]) == 201
    assert len(apply(spark, raw[4:], lambda c: text.tokenize(c, 200))[0]) == 200


def test_tones(spark):
    raw = ["lòng", "mất", "hỏi", "đã", "một", "tôi", "đường", "nguyễn", "abc", "MẤT"]
    want = [1, 2, 3, 4, 5, 0, 1, 4, 0, 2]
    assert apply(spark, raw, text.tone) == want
    assert apply(spark, raw, lambda c: text.tone(c, True)) == want[:7] + [0, 0, 2]


def test_trigrams_cover_whole_text(spark):
    raw = ["abcd", "ab", "a😀bc", "x" * 50_000]
    got = apply(spark, raw, text.trigrams)
    assert got[:3] == [["abc", "bcd"], [], ["a😀b", "😀bc"]] and len(got[3]) == 49_998


def test_clean_lines_and_items(spark):
    assert apply(spark, [[" x ", "", "y"], [" "], None], text.clean_lines, "array<string>") == ["x\ny", K.NO_TEXT, K.NO_TEXT]
    kind = "struct<error: string, lyrics: struct<lines: array<struct<words: string>>>>"
    items = [
        (None, ([(" a ",), ("",), ("b",)],)),
        ("gone", ([("a",)],)),
        (None, None),
    ]
    assert apply(spark, items, text.item_text, kind) == ["a\nb", K.NO_TEXT, K.NO_TEXT]


def test_array_functions(spark):
    kind = "array<double>"
    assert apply(spark, [[1.0, 2.0]], lambda c: arrays.pad_or_truncate(c, 4, F.lit(0.0)), kind) == [[1, 2, 0, 0]]
    assert apply(spark, [[0.0, 10.0]], lambda c: arrays.resample_linear(c, 5), kind) == [[0, 2.5, 5, 7.5, 10]]
    assert apply(spark, [[0.0, 1.0, 4.0]], lambda c: arrays.resample_linear(c, 2), kind) == [[0, 4]]
    assert apply(spark, [[3.0]], lambda c: arrays.resample_linear(c, 3), kind) == [[3, 3, 3]]
    assert apply(spark, [[]], lambda c: arrays.resample_linear(c, 3), kind) == [None]
    assert apply(spark, [[5.0, 5.0]], arrays.minmax_scale, kind) == [[0, 0]]
    assert apply(spark, [[1.0, 0.1, 0.0]], arrays.power_to_db, kind) == [[0.0, -10.0, -80.0]]


def test_missing_tokens(spark):
    df = spark.createDataFrame([(t, "x") for t in K.MISSING_TOKENS] + [("Nano", "y")], "a string, b string")
    out = quality.normalize_missing_tokens(df, ["a"])
    assert out.filter("a is null").count() == len(K.MISSING_TOKENS)
    assert out.filter("b is null").count() == 0


def test_seeded_hash_is_stable(spark):
    got = apply(spark, ["1", "2"], lambda c: columns.seeded_uniform(c, 42))
    import hashlib

    want = [int(hashlib.md5(f"42:{k}".encode()).hexdigest()[:12], 16) / 2**48 for k in ("1", "2")]
    assert got == want

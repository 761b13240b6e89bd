import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from corpusflow.llm import prefix_bpe
from corpusflow.llm.prefix_bpe import EncodedText, PrefixTable, RankCodec
from tests.llm.test_tokens import _texts

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MORE = ["ñ", "ß", "Привет", "мир", "日本", "語", "नमस्ते", "️", " ", " ", "١٢", "𝟙", "ﬁ", "🇩🇪", "᳀", "ⅷ", "'LL", "’s", "​", "\r\n", "\x0b"]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return RankCodec(PATH)


def _all_texts():
    rng = random.Random(12)
    mixed = ["".join(rng.choice([*MORE, " ", "a", "the", "\n", "7"]) for _ in range(rng.randint(1, 16))) for _ in range(1500)]
    return [*_texts(), *mixed, "x" * 5000, "ab" * 3000, "\n" * 700, "ñé" * 900]


def test_ids_and_bytes_are_those_of_the_library(codec, library):
    texts = _all_texts()
    ids, counts = codec.encode(texts)
    again, _ = codec.encode(texts)
    assert np.array_equal(ids, again)  # from the cache
    ends = np.concatenate([[0], np.cumsum(counts)])
    decoded = codec.decode(ids.astype(np.int64), counts)
    for i, text in enumerate(texts):
        want = library.encode_ordinary(text)
        assert ids[ends[i] : ends[i + 1]].tolist() == want, text
        assert decoded[i] == library.decode_bytes(want) == text.encode()


def test_every_code_point_is_of_the_kind_that_the_library_takes_it_for(codec, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 40_000):
        text = "".join(f"{chr(c)}a{chr(c)}1{chr(c)}!{chr(c)}{chr(c)} {chr(c)}" for c in points[k : k + 40_000 : 37])
        assert codec.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_a_full_cache_changes_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "CACHE_WORDS", 4)
    monkeypatch.setattr(prefix_bpe, "CACHE_PAIRS", 4)
    monkeypatch.setattr(prefix_bpe, "CACHE_CHARS", 5)
    for text in ("one two three four five", "five six longer words one", "two"):
        assert codec.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_prefix_table_holds_the_last_token_of_every_prefix(codec):
    data = "internationalisation überraschend".replace(" ", "").encode()
    table = PrefixTable(codec, data)
    for n in range(1, len(data) + 1):
        assert table.last[n] == codec.merged(data[:n])[-1]
    grown = PrefixTable(codec)
    for k in range(len(data)):
        grown.append(data[k : k + 1])
    assert grown.last == table.last and grown.tokens() == codec.merged(data)


def test_edits_of_a_table_equal_a_new_one_and_stay_near(codec):
    rng = random.Random(4)
    letters = "abcdeéñ"
    for _ in range(60):
        data = "".join(rng.choices(letters, k=600)).encode()
        table = PrefixTable(codec, data)
        a = rng.randint(0, len(data))
        b = min(len(data), a + rng.randint(0, 9))
        new = "".join(rng.choices(letters, k=rng.randint(0, 9))).encode()
        table.replace(a, b, new)
        assert table.last == PrefixTable(codec, data[:a] + new + data[b:]).last
    far = PrefixTable(codec, b"abcde" * 4000)
    assert far.replace(10, 12, b"zz") < 1000 and far.last == PrefixTable(codec, far.data).last


def test_edits_of_texts_equal_a_new_encoding(codec, library):
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "'", "s", "ll", "the", " cat", "12", "!", "é", "'t", "日本"]
    make = lambda n: "".join(rng.choices(parts, k=n))
    for _ in range(400):
        coded = EncodedText(codec, make(rng.randint(0, 40)))
        for _ in range(3):
            a = rng.randint(0, len(coded.text))
            b = min(len(coded.text), a + rng.randint(0, 5))
            coded.replace(a, b, make(rng.randint(0, 4)))
            assert coded.ids == library.encode_ordinary(coded.text), coded.text
        coded.append(make(3))
        assert coded.ids == library.encode_ordinary(coded.text)
    long = EncodedText(codec, "some words here " * 3000)
    assert long.replace(20_000, 20_003, "xyz") < 200 and long.append(" end") < 10
    assert long.ids == library.encode_ordinary(long.text)


def test_columns(spark, library):
    texts = [*_all_texts()[:200], None, "", "same", "same", "z" * 300_000]
    df = spark.createDataFrame([(i, t, "keep") for i, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(3)
    rows = prefix_bpe.decode_ids(prefix_bpe.encode_texts(df, PATH), PATH).collect()
    both = {r["doc_id"]: r["coded"] for r in prefix_bpe.round_trip(df, PATH).collect()}
    assert len(rows) == len(texts) == len(both)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == library.encode_ordinary(text) == both[r["doc_id"]]["ids"]
        assert bytes(r["decoded"]) == text.encode() == bytes(both[r["doc_id"]]["decoded"])
    assert prefix_bpe.encode_texts(df.limit(0), PATH).count() == prefix_bpe.round_trip(df.limit(0), PATH).count() == 0
    odd = spark.createDataFrame([(None,), ([],), ([1, 2],)], "ids array<int>")
    assert [r["decoded"] if r["decoded"] is None else bytes(r["decoded"]) for r in prefix_bpe.decode_ids(odd, PATH).collect()] == [None, b"", library.decode_bytes([1, 2])]

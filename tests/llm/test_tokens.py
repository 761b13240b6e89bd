import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, pre_tokenizers

from corpusflow.llm import bpe, token_counts
from corpusflow.llm.pretokens import ByteLevel, Known
from corpusflow.llm.slices import slices

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["'", "s", "t", "re", "ve", "ll", "d", " ", "  ", "\n", "\t", "1", "²", "é", "!", "...", "漢", "😀", "́", "\x1c", "\x85", "The", "AAAA", "<|endoftext|>", "<|", "ing", "\x00"]


def _texts():
    rng = random.Random(3)
    mixed = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    return [*mixed, "", "a" * 3000, " " * 50, "<|endoftext|>", "ab <|endoftext|><|endoftext|> c", "I'll don't we've 's"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH)


def test_pretokens_are_those_of_the_library(codec):
    texts = [t.replace("<|endoftext|>", "") for t in _texts()]
    pre = codec.level.split(texts)
    rule = pre_tokenizers.ByteLevel(add_prefix_space=False)
    for i, text in enumerate(texts):
        got = [pre.text(j) for j in range(pre.first[i], pre.first[i + 1])]
        assert got == [text[a:b] for _, (a, b) in rule.pre_tokenize_str(text)]


def test_ids_and_texts_are_those_of_the_library(codec, library):
    texts = _texts()
    ids, counts = codec.encode(texts)
    ends = np.concatenate([[0], np.cumsum(counts)])
    for i, (text, found) in enumerate(zip(texts, library.encode_batch(texts, add_special_tokens=False))):
        own = ids[ends[i] : ends[i + 1]]
        assert own.tolist() == found.ids
        assert codec.decode_bytes(own.astype(np.int64)).tobytes().decode("utf-8", "replace") == library.decode(found.ids, skip_special_tokens=False) == text


def test_trie_agrees_with_merging_and_survives_a_full_cache(codec):
    words = [w.encode() for w in {"hello", " hell", " hello", "helloworld", "zzzzz", " ", "\n\n", "ébène", "x" * 400}]
    assert codec.encode_words(words) == [codec.merged(w) for w in words]
    small = bpe.Codec.__new__(bpe.Codec)
    small.__dict__.update(codec.__dict__)
    small.words, small._flat, small._ends = Known(3), np.zeros(0, np.int32), np.zeros(1, np.int64)
    start_anew, small.start_anew = small.start_anew, lambda: (start_anew(), setattr(small.words, "bound", 3))
    for _ in range(3):
        for text in ("one two three four", "five six one"):
            assert small.encode([text])[0].tolist() == codec.encode([text])[0].tolist()


def test_a_pretoken_of_more_than_2_to_the_20_ids(codec, library):
    text = "ab " + "qzxj" * 400_000
    assert codec.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(library.encode(text, add_special_tokens=False).ids) > 1 << 20
    assert codec.encode(["ab qz"])[0].tolist() == library.encode("ab qz", add_special_tokens=False).ids


def test_decoder_holds_the_bytes_only(codec, library):
    decoder = bpe.Decoder(PATH)
    ids = np.arange(library.get_vocab_size())
    assert decoder.decode(ids, np.ones(len(ids), np.int64)) == codec.decode(ids, np.ones(len(ids), np.int64))
    assert set(vars(decoder)) == {"_size", "_begin", "_all"}


def test_encode_and_decode_columns(spark, library):
    texts = [*_texts()[:300], None, "same", "same"]
    df = spark.createDataFrame([(i, t, "keep") for i, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(3)
    rows = bpe.decode_ids(bpe.encode_texts(df, PATH), PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == library.encode(text, add_special_tokens=False).ids and r["decoded"] == text
    both = bpe.round_trip(df, PATH).collect()
    assert {r["doc_id"]: tuple(r["coded"]) for r in both} == {r["doc_id"]: (r["ids"], r["decoded"]) for r in rows}
    assert bpe.encode_texts(df.limit(0), PATH).count() == 0
    bad = spark.createDataFrame([([255, 188],), (None,), ([],)], "ids array<int>")
    decoded = [r["decoded"] for r in bpe.decode_ids(bad, PATH).collect()]
    assert decoded[1:] == [None, ""] and decoded[0] == library.decode([255, 188], skip_special_tokens=False)


@pytest.mark.parametrize("rows", [1, 16_384])
def test_counts_are_those_of_the_library(spark, library, rows):
    texts = [*_texts()[:500], None, "same", "same", "word " * 30_000]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int").repartition(3)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, PATH, rows=rows).collect()}
    assert got == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert token_counts.count_tokens(df.limit(0), PATH).count() == 0


def test_frequent_table_is_bounded_and_holds_the_frequent(spark):
    df = spark.createDataFrame([("of the of the of",), ("of rare",), (None,)], "text string").coalesce(1)
    keys, counts = token_counts.frequent_pretokens(df, "text", PATH, rows=1)
    assert keys.tolist() == ByteLevel(PATH).split([" of"]).key.tolist() and counts.tolist() == [1]


def test_no_pretoken_is_shuffled(spark):
    df = spark.createDataFrame([("a b",)], "text string")
    plan = token_counts.count_tokens(df, PATH)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_slices_keep_order_and_bounds():
    parts = list(slices(["aa", None, "b" * 9, "c", ""], chars=4))
    assert parts == [["aa", ""], ["b" * 9], ["c", ""]]
    assert hashlib.sha256(b"").hexdigest()  # the digest of an empty list of ids is that of no bytes


def test_other_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError):
        ByteLevel(public_tokenizers.path("word_bpe_49k.json"))

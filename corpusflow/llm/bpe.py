"""Byte-pair encoding and decoding with a trie over the distinct words of a batch.

The encoding of a byte string is settled by the last token of the encoding of each of its prefixes:
the last token of a prefix is the one token that ends there, is its own encoding, and may follow the
last token of what is left before it. So the distinct words of a batch are walked as a trie, depth
first, with one last token per node: words that share a prefix share its work. Sorted words give the
depth-first order, and the path to the current node is all that is held of the trie.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.pretokens import ByteLevel, Known
from corpusflow.llm.slices import bound_batches, slices

# Distinct words whose encodings a worker keeps before it starts anew, and the ids kept with them.
CACHE_WORDS, CACHE_IDS = 1 << 19, 1 << 22
# Pairs of tokens whose compatibility a worker remembers before it starts anew.
CACHE_PAIRS = 1 << 18
# Token ids decoded at once.
SLICE_IDS = 1 << 18

_WORKER: dict[tuple[type, str], Codec | Decoder] = {}


def byte_alphabet() -> dict[str, int]:
    """The letters by which byte-level files write bytes: printable bytes stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(0x100) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Decoder:
    """The bytes of every token id of one byte-level BPE file, and nothing else."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_alphabet()
        spelled = {i: bytes(letters[c] for c in word) for word, i in spec["model"]["vocab"].items()}
        spelled |= {token["id"]: token["content"].encode() for token in spec.get("added_tokens", [])}
        tokens = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self._size = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self._begin = np.cumsum(self._size) - self._size
        self._all = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of token ids, one after the other."""
        return self._all[spans(self._begin[ids], self._size[ids])]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each list of ids (lists lie one after the other), ``SLICE_IDS`` at a time."""
        edges = np.concatenate([[0], np.cumsum(counts)])
        texts: list[str] = []
        row = 0
        while row < len(counts):
            stop = max(row + 1, int(np.searchsorted(edges, edges[row] + SLICE_IDS, side="right")) - 1)
            part = ids[edges[row] : edges[stop]]
            data = self.decode_bytes(part).tobytes()
            ends = np.concatenate([[0], np.cumsum(self._size[part])])[edges[row : stop + 1] - edges[row]].tolist()
            texts += [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
            row = stop
        return texts


class Codec(Decoder):
    """Encoder and decoder of one byte-level BPE file."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback") if model.get(k)]
        if model.get("type", "BPE") != "BPE" or odd:
            raise ValueError(f"{path}: not a plain byte-level BPE model {odd}")
        self.level = ByteLevel(path)
        letters = byte_alphabet()
        spelled = {word: bytes(letters[c] for c in word) for word in model["vocab"]}
        self.ids = {spelled[word]: i for word, i in model["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocab = model["vocab"]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        top = max([*self.ids.values(), *self.level.special.values()]) + 1
        self.bytes_of = [b""] * top
        for spelling, i in self.ids.items():
            self.bytes_of[i] = spelling
        for content, i in self.level.special.items():
            self.bytes_of[i] = content.encode()
        self.longest = max(map(len, self.ids))
        self.own = {i for spelling, i in self.ids.items() if self.merged(spelling) == [i]}
        self._pairs: dict[int, bool] = {}
        self.start_anew()

    def start_anew(self) -> None:
        self.words = Known(CACHE_WORDS)
        # Word number n of the cache has the ids from _ends[n] to _ends[n + 1].
        self._flat, self._ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def merged(self, spelling: bytes) -> list[int]:
        """Token ids by merging adjacent tokens, lowest rank first: what defines the encoding."""
        out = [self.ids[spelling[k : k + 1]] for k in range(len(spelling))]
        while len(out) > 1:
            ranks = [self.merges.get(pair, (1 << 62, -1)) for pair in zip(out, out[1:])]
            rank, new = min(ranks)
            if new < 0:
                break
            k, done = 0, []
            while k < len(out):
                if k + 1 < len(out) and ranks[k][0] == rank:
                    done.append(new)
                    k += 2
                else:
                    done.append(out[k])
                    k += 1
            out = done
        return out

    def _may_follow(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word; equal beginnings are worked out once."""
        out: list[list[int]] = [[]] * len(words)
        ids, own, pairs, longest = self.ids, self.own, self._pairs, self.longest
        last = [-1]  # last[d]: the last token of the first d bytes on the path
        path = b""
        for i in sorted(range(len(words)), key=words.__getitem__):
            word = words[i]
            shared, most = 0, min(len(word), len(path))
            while shared < most and word[shared] == path[shared]:
                shared += 1
            del last[shared + 1 :]
            for depth in range(shared + 1, len(word) + 1):
                for begin in range(depth - 1, max(0, depth - longest) - 1, -1):
                    token = ids.get(word[begin:depth])
                    if token is None:
                        continue
                    if begin:
                        fits = pairs.get(last[begin] << 32 | token)
                        fits = self._may_follow(last[begin], token) if fits is None else fits
                    else:
                        fits = token in own
                    if fits:
                        last.append(token)
                        break
            path, tokens, depth = word, [], len(word)
            while depth:
                tokens.append(last[depth])
                depth -= len(self.bytes_of[last[depth]])
            out[i] = tokens[::-1]
        return out

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(token ids of all the texts, number of ids of each text), as NumPy arrays."""
        pre = self.level.split(texts)
        keys, at, back = np.unique(pre.key, return_index=True, return_inverse=True)
        if len(self.words.keys) > self.words.bound or len(self._flat) > CACHE_IDS:
            self.start_anew()
        _, known = self.words.find(keys)
        miss = np.flatnonzero(~known)
        if len(miss):
            spelled = [pre.text(i) for i in at[miss]]
            special = self.level.special
            plain = [i for i, word in enumerate(spelled) if word not in special]
            found = [[special.get(word, -1)] for word in spelled]
            for i, tokens in zip(plain, self.encode_words([spelled[i].encode("utf-8", "surrogatepass") for i in plain])):
                found[i] = tokens
            sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            self.words.add(keys[miss], len(self._ends) - 1 + np.arange(len(found)))
            self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(sizes)])
            self._flat = np.concatenate([self._flat, np.fromiter((x for f in found for x in f), dtype=np.int32, count=int(sizes.sum()))])
        place, _ = self.words.find(keys)
        sizes = (self._ends[place + 1] - self._ends[place])[back] if len(place) else np.zeros(0, np.int64)
        ids = self._flat[spans(self._ends[place][back], sizes)]
        return ids, pre.totals(sizes)


def spans(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions begin, begin + 1, ... of every span, one span after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(total)


def _worker(kind: type, path: str) -> Codec | Decoder:
    if (kind, path) not in _WORKER:
        _WORKER[kind, path] = kind(path)
    return _WORKER[kind, path]


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids))


def _encoded(codec: Codec, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = [codec.encode(part) for part in slices(batch.to_pylist())]
    ids = np.concatenate([np.zeros(0, np.int32), *(ids for ids, _ in parts)])
    return ids, np.concatenate([np.zeros(0, np.int64), *(n for _, n in parts)])


def encode_column(text: Column, path: str) -> Column:
    """Token ids (array of int) of a text column; NULL and empty texts have none.

    Equal to the tokenizer library without added special tokens, truncation and padding; a special
    string inside a text becomes its special token, as there.
    """

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _worker(Codec, path)
        for batch in batches:
            yield _lists(*_encoded(codec, batch))

    return encode(text)


def decode_column(ids: Column, path: str) -> Column:
    """The text of token ids, special tokens included; bytes that are no UTF-8 become U+FFFD.

    NULL gives NULL, an empty list the empty text. The worker holds the bytes of the tokens only.
    """

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = _worker(Decoder, path)
        for batch in batches:
            counts = np.diff(np.asarray(batch.offsets, dtype=np.int64))
            found = decoder.decode(np.asarray(batch.flatten(), dtype=np.int64), counts)
            yield pa.array([x if ok else None for x, ok in zip(found, batch.is_valid().to_pylist())], pa.string())

    return decode(ids)


def round_trip_column(text: Column, path: str) -> Column:
    """(``ids``, ``decoded``): the ids of a text, and the text that these ids decode to, by one worker."""

    @F.arrow_udf("ids array<int>, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _worker(Codec, path)
        for batch in batches:
            ids, counts = _encoded(codec, batch)
            yield pa.StructArray.from_arrays([_lists(ids, counts), pa.array(codec.decode(ids, counts), pa.string())], names=["ids", "decoded"])

    return both(text)


def encode_texts(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the token ids of each whole text; a column already named ``out`` is replaced.

    One row in, one row out, no shuffle: repeated rows are encoded each, an empty table stays empty.
    """
    bound_batches(df.sparkSession)
    return df.withColumn(out, encode_column(F.col(f"`{text}`"), path))


def decode_ids(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of each row's token ids; a column already named ``out`` is replaced."""
    bound_batches(df.sparkSession)
    return df.withColumn(out, decode_column(F.col(f"`{ids}`"), path))


def round_trip(df: DataFrame, path: str, text: str = "text", out: str = "coded") -> DataFrame:
    """``df`` with ids and decoded text of each whole text in the struct ``out``; one worker a task does both."""
    bound_batches(df.sparkSession)
    return df.withColumn(out, round_trip_column(F.col(f"`{text}`"), path))

"""Byte-level BPE by rank files: for each byte prefix its one valid last token.

Of all tokens that end at a place exactly one can be the last token of the encoding of the bytes so
far: the one that may stand after the last token of what is left before it. ``PrefixTable`` keeps that
token for every prefix. Bytes that are appended only add to the table; an edit is worked out from its
place on, until the table falls back into step with what stood there before. ``EncodedText`` does the
same for a whole text and its pre-tokens. The encoding is read from the end of the table backwards.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.pretokens import LETTER, NUMBER, OTHER, SPACE, Known, Splitter
from corpusflow.llm.slices import bound_batches, slices

# Distinct pre-tokens whose encodings a worker keeps before it starts anew, and ids kept with them.
CACHE_WORDS, CACHE_IDS = 1 << 19, 1 << 22
# Pairs of tokens whose compatibility a worker remembers before it starts anew.
CACHE_PAIRS = 1 << 18
# Longer pre-tokens are encoded but not kept.
CACHE_CHARS = 256

_WORKER: dict[str, RankCodec] = {}


class RankPattern(Splitter):
    """The pattern of rank files; which kind a code point is of is asked of the library's own matcher."""

    def __init__(self):
        super().__init__({})
        import tiktoken

        alone = {bytes([b]): b for b in range(256)}
        kinds = ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s"))
        self._matchers = [(k, tiktoken.Encoding(f"kind{k}", pat_str=p, mergeable_ranks=alone, special_tokens={})) for k, p in kinds]

    def _ask(self, points: list[int]) -> None:
        text = "".join(map(chr, points))
        self._kind[points] = OTHER
        for kind, matcher in self._matchers:
            # What does not match the pattern is left out of the tokens.
            found = bytes(matcher.encode_ordinary(text)).decode("utf-8")
            self._kind[[ord(c) for c in found]] = kind


class RankCodec:
    """Encoder and decoder of one rank file (a line for each token: its bytes in base64, its rank)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if len(set(self.ids.values())) != len(self.ids) or any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError(f"{path}: ranks repeat, or single bytes are missing")
        self.pattern = RankPattern()
        self.bytes_of = [b""] * (max(self.ids.values()) + 1)
        for spelling, i in self.ids.items():
            self.bytes_of[i] = spelling
        self.longest = max(map(len, self.ids))
        sizes = np.fromiter(map(len, self.bytes_of), dtype=np.int64, count=len(self.bytes_of))
        self._begin, self._size = np.cumsum(sizes) - sizes, sizes
        self._all = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        # Finds all tokens that end at a place, bytes standing for the first 256 code points.
        self.matcher = ahocorasick.Automaton()
        for spelling, i in self.ids.items():
            self.matcher.add_word(spelling.decode("latin-1"), (i, len(spelling)))
        self.matcher.make_automaton()
        self.fits: dict[int, bool] = {}
        self.start_anew()

    def start_anew(self) -> None:
        self.known = Known(CACHE_WORDS)
        self._ids, self._ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def merged(self, spelling: bytes) -> list[int]:
        """Token ids by merging adjacent tokens, lowest rank first, leftmost first: what defines the encoding."""
        parts, ranks = [spelling[k : k + 1] for k in range(len(spelling))], self.ids
        while len(parts) > 1:
            joined = [ranks.get(a + b, -1) for a, b in zip(parts, parts[1:])]
            best = min((r for r in joined if r >= 0), default=-1)
            if best < 0:
                break
            k = joined.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [ranks[p] for p in parts]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether token ``b`` can stand after ``a`` (-1: at the beginning) in an encoding."""
        key = (a + 1) << 32 | b
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= CACHE_PAIRS:
                self.fits.clear()
            both = (self.bytes_of[a] if a >= 0 else b"") + self.bytes_of[b]
            # Two tokens that make up a token would have been merged.
            found = self.fits[key] = (a < 0 or both not in self.ids) and self.merged(both) == ([a, b] if a >= 0 else [b])
        return found

    def encode_piece(self, piece: bytes, table: PrefixTable) -> list[int]:
        """Ids of one pre-token; what ``table`` shares with it at the front is used again."""
        whole = self.ids.get(piece)
        if whole is not None:  # a pre-token that is a token is not merged at all
            return [whole]
        shared = 0
        if piece[:1] == table.data[:1]:
            low, high = 0, min(len(piece), len(table.data))
            while low < high:  # the longest common beginning, by halves
                half = (low + high + 1) // 2
                low, high = (half, high) if piece[:half] == table.data[:half] else (low, half - 1)
            shared = low
        table.cut(shared)
        table.append(piece[shared:])
        return table.tokens()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all the texts, number of ids of each text)."""
        pre = self.pattern.split(texts)
        keys, at, back = np.unique(pre.key, return_index=True, return_inverse=True)
        place, hit = self.known.find(keys)
        sizes = np.where(hit, self._ends[np.minimum(place + 1, len(self._ends) - 1)] - self._ends[place], 0)
        begins = self._ends[place]
        miss = np.flatnonzero(~hit)
        spelled = [pre.text(i).encode("utf-8", "surrogatepass") for i in at[miss]]
        fresh: list[list[int]] = [[]] * len(miss)
        table = PrefixTable(self)
        for i in sorted(range(len(miss)), key=spelled.__getitem__):  # neighbours share their beginnings
            fresh[i] = self.encode_piece(spelled[i], table)
        new = np.fromiter(map(len, fresh), dtype=np.int64, count=len(fresh))
        flat = np.fromiter((x for f in fresh for x in f), dtype=np.int32, count=int(new.sum()))
        pool = np.concatenate([self._ids, flat])
        sizes[miss], begins[miss] = new, len(self._ids) + np.cumsum(new) - new
        sizes, begins = sizes[back], begins[back]
        ids = pool[_spans(begins, sizes)]
        self._keep(keys[miss], fresh, np.array([len(s) <= CACHE_CHARS for s in spelled], dtype=bool))
        return ids, pre.totals(sizes)

    def _keep(self, keys: np.ndarray, found: list[list[int]], short: np.ndarray) -> None:
        if not short.any():
            return
        if len(self.known.keys) + len(keys) > CACHE_WORDS or len(self._ids) > CACHE_IDS:
            self.start_anew()
        found = [f for f, s in zip(found, short) if s]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter((x for f in found for x in f), dtype=np.int32, count=int(sizes.sum()))
        self.known.add(keys[short], len(self._ends) - 1 + np.arange(len(found)))
        self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(sizes)])
        self._ids = np.concatenate([self._ids, flat])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each list of ids; lists lie one after the other."""
        data = self._all[_spans(self._begin[ids], self._size[ids])].tobytes()
        ends = np.concatenate([[0], np.cumsum(self._size[ids])])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [data[a:b] for a, b in zip(ends, ends[1:])]


def _spans(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions begin, begin + 1, ... of every span, one span after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class PrefixTable:
    """``last[n]``: the last token of the encoding of the first ``n`` bytes (``last[0]``: -1)."""

    def __init__(self, codec: RankCodec, data: bytes = b""):
        self.codec, self.data, self.last = codec, b"", [-1]
        self.append(data)

    def cut(self, size: int) -> None:
        """Keep the first ``size`` bytes: their part of the table is the table of that prefix."""
        self.data = self.data[:size]
        del self.last[size + 1 :]

    def _tokens_from(self, data: bytes, size: int) -> Iterator[int]:
        """The last tokens of the prefixes longer than ``size``, each once the one before it is in the table."""
        codec, last = self.codec, self.last
        fits, may_follow = codec.fits, codec.may_follow
        done = size
        for at, (token, length) in codec.matcher.iter(data.decode("latin-1"), max(0, size + 1 - codec.longest)):
            if at < done:
                continue
            before = last[at + 1 - length]
            fit = fits.get((before + 1) << 32 | token)
            if may_follow(before, token) if fit is None else fit:
                done = at + 1
                yield token

    def append(self, more: bytes) -> None:
        """Add bytes at the end; nothing that is in the table changes."""
        data = self.data = self.data + more
        for token in self._tokens_from(data, len(self.last) - 1):
            self.last.append(token)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of the bytes from ``start`` to ``stop``; returns how many prefixes were worked out.

        An entry follows from the ``longest`` bytes before it and as many entries. So once that many
        entries behind the edit are what they were, all later ones are too.
        """
        old, shift, longest = self.last, len(new) - (stop - start), self.codec.longest
        data = self.data[:start] + new + self.data[stop:]
        self.last, self.data = old[: start + 1], data
        same = 0
        for end, token in enumerate(self._tokens_from(data, start), start + 1):
            self.last.append(token)
            behind = end - (start + len(new))  # unchanged bytes between the edit and this place
            same = same + 1 if behind > 0 and old[end - shift] == token else 0
            if same >= longest:
                self.last += old[end - shift + 1 :]
                return end - start
        return len(data) - start

    def tokens(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end])
            end -= len(self.codec.bytes_of[out[-1]])
        return out[::-1]


class EncodedText:
    """A text with its ids, which appended text and edits change only near their place."""

    def __init__(self, codec: RankCodec, text: str = ""):
        self.codec, self.text = codec, ""
        self._starts: list[int] = []  # where each pre-token begins
        self._ids: list[list[int]] = []
        self.replace(0, 0, text)

    @property
    def ids(self) -> list[int]:
        return [i for piece in self._ids for i in piece]

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> int:
        """Put ``new`` in place of the characters from ``start`` to ``stop``; returns how many pre-tokens were encoded anew.

        A pre-token depends on what follows it by two characters at most and on nothing before it. So those that
        end earlier stay, and from where an old one begins behind the edit all later ones stay.
        """
        starts, text = self._starts, self.text[:start] + new + self.text[stop:]
        shift, edge = len(new) - (stop - start), start + len(new)
        ends = [*starts[1:], len(self.text)]
        keep = bisect_left(ends, start - 1)
        begin = starts[keep] if keep < len(starts) else 0
        reach = 64
        while True:
            limit = min(len(text), edge + reach)
            pre = self.codec.pattern.split([text[begin:limit]])
            cut = [(int(a) + begin, int(b) + begin) for a, b in zip(pre.start, pre.end)]
            sure = cut if limit == len(text) else [c for c in cut if c[1] < limit - 2]
            for n, (a, _) in enumerate(sure):
                # At the first common beginning behind the edit the old pre-tokens go on.
                at = bisect_left(starts, a - shift)
                if a > edge and at < len(starts) and starts[at] == a - shift:
                    return self._swap(text, keep, at, sure[:n], shift)
            if limit == len(text):
                return self._swap(text, keep, len(starts), sure, shift)
            reach *= 4

    def _swap(self, text: str, keep: int, rest: int, fresh: list[tuple[int, int]], shift: int) -> int:
        table = PrefixTable(self.codec)
        ids = [self.codec.encode_piece(text[a:b].encode("utf-8", "surrogatepass"), table) for a, b in fresh]
        self._ids = self._ids[:keep] + ids + self._ids[rest:]
        self._starts = self._starts[:keep] + [a for a, _ in fresh] + [s + shift for s in self._starts[rest:]]
        self.text = text
        return len(fresh)


def _codec(path: str) -> RankCodec:
    if path not in _WORKER:
        _WORKER[path] = RankCodec(path)
    return _WORKER[path]


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids))


def _encoded(codec: RankCodec, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = [codec.encode(part) for part in slices(batch.to_pylist())]
    ids = np.concatenate([np.zeros(0, np.int32), *(p[0] for p in parts)])
    return ids, np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)])


def encode_column(text: Column, path: str) -> Column:
    """Token ids (array of int) of a text column, each match of the pattern by itself; NULL and empty texts have none."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path)
        for batch in batches:
            yield _lists(*_encoded(codec, batch))

    return encode(text)


def decode_column(ids: Column, path: str) -> Column:
    """The bytes (binary) of token ids; NULL gives NULL, an empty list no bytes. Unknown ids are an error."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path)
        for batch in batches:
            counts = np.diff(np.asarray(batch.offsets, dtype=np.int64))
            found = codec.decode(np.asarray(batch.flatten(), dtype=np.int64), counts)
            yield pa.array([x if ok else None for x, ok in zip(found, batch.is_valid().to_pylist())], pa.binary())

    return decode(ids)


def round_trip_column(text: Column, path: str) -> Column:
    """(``ids``, ``decoded``): the ids of a text, and the bytes that these ids decode to, by one worker."""

    @F.arrow_udf("ids array<int>, decoded binary")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path)
        for batch in batches:
            ids, counts = _encoded(codec, batch)
            yield pa.StructArray.from_arrays([_lists(ids, counts), pa.array(codec.decode(ids, counts), pa.binary())], names=["ids", "decoded"])

    return both(text)


def encode_texts(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the token ids of each whole text; a column already named ``out`` is replaced.

    One row in, one row out, no shuffle: repeated rows are encoded each, an empty table stays empty. Texts are
    worked on in slices, a very long one as a slice of its own.
    """
    bound_batches(df.sparkSession)
    return df.withColumn(out, encode_column(F.col(f"`{text}`"), path))


def decode_ids(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of each row's token ids; a column already named ``out`` is replaced."""
    bound_batches(df.sparkSession)
    return df.withColumn(out, decode_column(F.col(f"`{ids}`"), path))


def round_trip(df: DataFrame, path: str, text: str = "text", out: str = "coded") -> DataFrame:
    """``df`` with ids and decoded bytes of each whole text in the struct ``out``; one worker a task does both."""
    bound_batches(df.sparkSession)
    return df.withColumn(out, round_trip_column(F.col(f"`{text}`"), path))

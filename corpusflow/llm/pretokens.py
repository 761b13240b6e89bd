"""Byte-level pre-tokens of many texts at once, and a bounded table of what is known about them.

The rule is that of byte-level BPE files: contractions, then runs of letters, numbers or other
signs with at most one leading blank, then white space. Which of the four kinds a code point is of
is asked of the tokenizer's own library, once for each code point that occurs.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np

SPACE, LETTER, NUMBER, OTHER, UNKNOWN = 0, 1, 2, 3, 255
BLANK, QUOTE = 0x20, 0x27
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# Powers that a worker keeps; a longer slice works out its own.
KEPT_POWERS = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Pretokens:
    """Pre-tokens of a list of texts: where each begins and ends, its hash, and each text's first one."""

    points: np.ndarray
    start: np.ndarray
    end: np.ndarray
    key: np.ndarray
    first: np.ndarray

    def text(self, i: int) -> str:
        return self.points[self.start[i] : self.end[i]].tobytes().decode("utf-32-le", "surrogatepass")

    def totals(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per pre-token over each text."""
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[self.first[1:]] - sums[self.first[:-1]]


class Splitter:
    """Cuts texts at special strings and by the kinds of their code points."""

    def __init__(self, special: dict[str, int]):
        self.special = special
        self._kind = np.full(0x110000, UNKNOWN, dtype=np.uint8)
        self._point = mix(np.arange(1, 0x110001, dtype=np.uint64))
        self._powers = powers(KEPT_POWERS, _BASE)
        self._inverses = powers(KEPT_POWERS, _INVERSE)

    def _ask(self, points: list[int]) -> None:
        """Find the kinds of code points that have not occurred before."""
        raise NotImplementedError

    def _kinds(self, points: np.ndarray) -> np.ndarray:
        kinds = self._kind[points]
        if (kinds == UNKNOWN).any():
            self._ask(np.unique(points[kinds == UNKNOWN]).tolist())
            kinds = self._kind[points]
        return kinds

    def _segments(self, texts: list[str]) -> tuple[list[str], list[int], list[bool]]:
        """The texts cut at special tokens; which text each part is of; which parts are special tokens."""
        parts, owner, special = texts, list(range(len(texts))), [False] * len(texts)
        for content in sorted(self.special, key=len, reverse=True):
            if not any(content in x and not s for x, s in zip(parts, special)):
                continue
            cut, who, marks = [], [], []
            for part, i, done in zip(parts, owner, special):
                pieces = [part] if done else part.split(content)
                for k, piece in enumerate(pieces):
                    if k:
                        cut.append(content), who.append(i), marks.append(True)
                    cut.append(piece), who.append(i), marks.append(done)
            parts, owner, special = cut, who, marks
        return parts, owner, special

    def split(self, texts: list[str]) -> Pretokens:
        parts, owner, special = self._segments(texts)
        lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        n = len(points)
        edges = np.concatenate([[0], np.cumsum(lengths)])
        opens = np.zeros(n + 1, dtype=bool)
        opens[edges] = True
        kinds = self._kinds(points)
        begins = opens[:n].copy()
        if n:
            white = kinds == SPACE
            change = kinds[1:] != kinds[:-1]
            inside = ~opens[1:n]
            # A run begins where the kind changes, unless a blank before it belongs to it.
            begins[1:] |= change & (white[1:] | (points[:-1] != BLANK))
            # The last white space before a run stands alone, or leads the run as its blank.
            begins[:-1] |= white[:-1] & ~white[1:] & inside
            self._contractions(points, kinds, opens, begins)
            if any(special):
                for s, e, mark in zip(edges[:-1], edges[1:], special):
                    if mark:
                        begins[s:e] = False
                        begins[s] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], n)[: len(start)]
        first = np.searchsorted(start, edges)
        part_first = np.searchsorted(np.asarray(owner), np.arange(len(texts) + 1))
        return Pretokens(points, start, end, self._hash(points, start, end), first[part_first])

    @staticmethod
    def _contractions(points: np.ndarray, kinds: np.ndarray, opens: np.ndarray, begins: np.ndarray) -> None:
        """Split 's 't 'm 'd 're 've 'll from what follows, where a pre-token begins at the quote."""
        n = len(points)
        at = np.flatnonzero((points == QUOTE) & begins)
        at = at[(at + 1 < n)]
        at = at[~opens[at + 1]]
        if not len(at):
            return
        one = np.isin(points[at + 1], [ord(c) for c in "stmd"])
        far = at + 2 < n
        second = np.where(far, points[np.minimum(at + 2, n - 1)], 0)
        pair = points[at + 1].astype(np.int64) << 21 | second
        two = far & ~opens[np.minimum(at + 2, n)] & np.isin(pair, [ord(p[0]) << 21 | ord(p[1]) for p in ("re", "ve", "ll")])
        for hit, size in ((one, 2), (two, 3)):
            begins[at[hit] + 1] = False
            after = at[hit] + size
            after = after[after < n]
            begins[after[kinds[after] == LETTER]] = True

    def _hash(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(points)
        known = n + 1 <= len(self._powers)
        up, down = (self._powers, self._inverses) if known else (powers(n, _BASE), powers(n, _INVERSE))
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.multiply(self._point[points], up[:n], out=sums[1:])
        np.cumsum(sums[1:], out=sums[1:])
        key = (sums[end] - sums[start]) * down[start]
        return mix(key + (end - start).astype(np.uint64))


class ByteLevel(Splitter):
    """The pre-tokenizer of a byte-level tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        if not plain or spec.get("normalizer"):
            raise ValueError(f"{path}: only byte-level tokenizers without a prefix space or normalizer")
        special = {}
        for token in spec.get("added_tokens", []):
            if token["lstrip"] or token["rstrip"] or token["single_word"]:
                raise ValueError(f"{path}: added token {token['content']!r} takes more than its own text")
            special[token["content"]] = token["id"]
        super().__init__(special)
        self._library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def _ask(self, points: list[int]) -> None:
        for c in points:
            alone = lambda x: len(self._library.pre_tokenize_str(x + chr(c))) == 1
            self._kind[c] = LETTER if alone("a") else NUMBER if alone("1") else OTHER if alone("!") else SPACE


class Known:
    """What is known about pre-tokens, as sorted arrays; emptied when it outgrows its bound."""

    def __init__(self, bound: int):
        self.bound = bound
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.values = np.zeros(0, dtype=np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the keys, and which of them are known."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.values[at], self.keys[at] == keys

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Remember new keys, given in ascending order."""
        at = np.searchsorted(self.keys, keys)
        self.keys, self.values = np.insert(self.keys, at, keys), np.insert(self.values, at, values)

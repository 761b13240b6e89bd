"""Words of many texts at once, as hashes, and the word shingles of each text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from corpusflow.llm.pretokens import mix, powers

_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = 0xD6E8FEB86659FD93
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of texts, A-Z in lower case: bytes, bounds, hashes, each text's first word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    key: np.ndarray
    first: np.ndarray


def split_words(texts: list[str]) -> Words:
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b"\n".join(encoded) + b"\n", dtype=np.uint8)]
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)) + 1)])
    white = _SPACE[data]
    before = np.concatenate([[True], white[:-1]])
    start = np.flatnonzero(~white & before)
    end = np.flatnonzero(white & ~before)
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(n, _BASE)[:n], out=sums[1:])
    key = mix((sums[end] - sums[start]) * powers(n, _INVERSE)[start] + (end - start).astype(np.uint64))
    return Words(data, start, end, key, np.searchsorted(start, edges))


def shingles(words: Words, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles.

    A text with fewer words has its whole sequence as its one shingle, a text without words none.
    """
    steps = [np.uint64(pow(_STEP, k, 1 << 64)) for k in range(width)]
    total = len(words.key)
    rolled = np.zeros(max(total - width + 1, 0), dtype=np.uint64)
    for k, step in enumerate(steps):
        rolled += words.key[k : k + len(rolled)] * step
    rolled = mix(rolled)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            whole = np.zeros(1, dtype=np.uint64)
            for k in range(b - a):
                whole += words.key[a + k : a + k + 1] * steps[k]
            yield mix(whole + np.uint64(b - a))
        else:
            yield np.zeros(0, dtype=np.uint64)

"""Small tables and plain counterparts for the tests of this folder."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def invented(rng: random.Random, words: int, syllables="ka lo mi ne ru sta ven tor pli que".split()) -> str:
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(words))


def shingle_set(text: str | None, width: int) -> frozenset:
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(max(len(words) - width + 1, 1)))


def levenshtein(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]

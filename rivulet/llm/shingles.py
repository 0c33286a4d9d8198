"""Hashes of five-word shingles, for a batch of texts at once.

Words are runs of characters other than white space and ASCII punctuation, in
lower case.  A text of one to four words has a single shingle, all its words.
"""

from __future__ import annotations

import string
from functools import cache

import numpy as np

WORDS = 5
#: The words of a text in DuckDB's SQL.
SQL_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x20\x7F!-/:-@\[-`{-~]+')"
GOLD = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """(which bytes are in words, a random number for each byte)."""
    word = np.ones(256, dtype=bool)
    word[[*range(33), 127, *map(ord, string.punctuation)]] = False
    return word, mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(GOLD))


class Powers:
    BASE = 0xC2B2AE3D27D4EB4F

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 1 << 18)
            for name, b in (("up", self.BASE), ("down", pow(self.BASE, -1, 1 << 64))):
                p = np.full(n, b, dtype=np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p))


POWERS = Powers()


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words of each text)."""
    word, number = tables()
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    begin = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=begin[1:])
    inside = word[data]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    start, end = edge[::2], edge[1::2]  # the last byte is white space, so every word ends
    POWERS.grow(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(number[data] * POWERS.up[: len(data)], out=total[1:])
    h = mix((total[end] - total[start]) * POWERS.down[start] + (end - start).astype(np.uint64) * np.uint64(GOLD))
    upto = np.searchsorted(start, begin)
    return h, np.diff(upto)


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hashes in order, shingles of each text, word hashes, words of each text)."""
    h, count = word_hashes(texts)
    ends = np.cumsum(count)
    n = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    first = np.repeat(ends - count, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    out = np.zeros(len(first), dtype=np.uint64)
    last = np.repeat(ends, n)
    for j in range(words):
        at = first + j
        ok = at < last
        part = h[np.minimum(at, max(len(h) - 1, 0))] * np.uint64(pow(GOLD, 2 * j + 1, 1 << 64)) if len(h) else out
        out += part if ok.all() else np.where(ok, part, np.uint64(0))
    return mix(out), n, h, count


def units(hashes: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's multiset of shingles as a set: (elements, owner), sorted by owner and shingle.

    The k-th occurrence of a shingle is an element of its own, so the Jaccard
    similarity of two such sets is the weighted one of the counts.
    """
    owner = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((hashes, owner))
    h = hashes[order]
    if not len(h):
        return h, owner
    new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]
    at = np.arange(len(h))
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    again = nth > 0
    h = h.copy()
    h[again] = mix(h[again] + nth[again].astype(np.uint64) * np.uint64(GOLD))
    return h, owner


def fingerprints(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each text's sequence of words."""
    ends = np.cumsum(count)
    begin = ends - count
    place = (np.arange(len(h)) - np.repeat(begin, count)).astype(np.uint64)
    out = np.zeros((len(count), 2), dtype=np.uint64)
    for k in range(2):
        x = mix(h + mix(place * np.uint64(GOLD) + np.uint64(k + 1)))
        total = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(x, out=total[1:])
        out[:, k] = mix(total[ends] - total[begin] + count.astype(np.uint64))
    return out

"""Tokenizing whole texts by their distinct words.

Tokenizers cut a text into words that they then handle one by one.  Here a
batch of texts is cut into words with array operations, equal words are found
by Arrow's dictionary encoding, and the tokenizer is asked only about words that this
worker has not met yet.  Texts with characters outside the fixed classes below
are given to the tokenizer whole, so results equal the library's for any text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa

from .common import HELD

LIMIT = 0x2100  # code points with a class
END, LETTER, NUMBER, SPACE, OTHER, ODD = 0, 1, 2, 3, 4, 9
#: Words, and bytes of them and of their values, that are kept when a batch begins.
MOST_WORDS, MOST_BYTES = 500_000, 64 << 20


def character_classes() -> np.ndarray:
    """A class for each code point whose class no Unicode version disputes; ODD for the rest."""
    out = np.full(LIMIT + 1, ODD, dtype=np.uint8)
    for c in (*range(9, 14), *range(32, 127), *range(160, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x203B), 0x20AC):
        kind = unicodedata.category(chr(c))[0]
        out[c] = SPACE if c in (9, 10, 11, 12, 13, 32, 160) else {"L": LETTER, "N": NUMBER}.get(kind, OTHER)
    out[0x00AD] = out[0x0130] = ODD  # a format character; a letter whose lower case has two
    out[0] = END
    return out


class Memo:
    """Values (one-dimensional arrays of one type) of the words met so far."""

    def __init__(self, make: Callable[[str], Sequence[int]], kind: str) -> None:
        self.make, self.kind = make, kind
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.held = 0
        self.offset = np.zeros(1025, dtype=np.int64)
        self.data = np.zeros(4096, dtype=self.kind)
        #: In how many batches each word was met.
        self.met = np.zeros(1024, dtype=np.int32)

    def thin(self) -> None:
        """Keep the words met in most batches, half as many as there may be; rare ones are most of those that come up."""
        n = len(self.index)
        size, met = np.diff(self.offset[: n + 1]), self.met[:n]
        kept = np.zeros(n, dtype=bool)
        kept[np.argsort(-met, kind="stable")[: MOST_WORDS // 2]] = True
        kept &= met > 1
        chars = np.fromiter(map(len, self.index), dtype=np.int64, count=n)
        self.index = dict(zip(compress(self.index, kept.tolist()), range(n), strict=False))
        self.data = self.data[: int(self.offset[n])][np.repeat(kept, size)]
        self.offset = np.r_[0, np.cumsum(size[kept])]
        self.met = met[kept] // 2
        self.held = 4 * int(chars[kept].sum()) + self.data.nbytes

    def add(self, words: list[str]) -> None:
        i, n, values, sizes = len(self.index), len(words), [], []
        for ids in map(self.make, words):  # held one by one: Python looks through all lists whenever many more are held
            values += ids
            sizes.append(len(ids))
        size, value = np.array(sizes, dtype=np.int64), np.array(values, dtype=self.kind)
        if i + n >= len(self.offset):
            self.offset = np.resize(self.offset, 2 * (i + n) + 1)
        if i + n > len(self.met):
            self.met = np.resize(self.met, 2 * (i + n))
        self.met[i : i + n] = 0
        a = int(self.offset[i])
        if a + len(value) > len(self.data):
            self.data = np.resize(self.data, 2 * (a + len(value)))
        self.index.update(zip(words, range(i, i + n), strict=True))
        self.held += 4 * sum(map(len, words)) + value.nbytes
        self.offset[i + 1 : i + n + 1], self.data[a : a + len(value)] = a + np.cumsum(size), value

    def values(self, chars: np.ndarray, start: np.ndarray, end: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The words' values one after the other, and each word's number of values; words are ranges of the code points ``chars`` (of one byte or four each), in order, and ``inside`` tells which code points are in one."""
        if len(start) == 0:
            return np.zeros(0, dtype=self.kind), np.zeros(0, dtype=np.int64)
        if self.held > MOST_BYTES:
            self.clear()
        elif len(self.index) > MOST_WORDS:
            self.thin()
        if inside is None:
            edge = np.zeros(len(chars) + 1, dtype=np.int8)
            edge[start] += 1
            edge[end] -= 1
            inside = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
        offset = np.zeros(len(start) + 1, dtype=np.int64)
        np.cumsum(end - start, out=offset[1:])
        wide = chars.itemsize
        words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(wide * offset), pa.py_buffer(chars[inside])]).dictionary_encode()
        distinct, back = words.dictionary, words.indices.to_numpy()
        at = np.frombuffer(distinct.buffers()[1], dtype=np.int64, count=len(distinct) + 1) // wide
        ends = at.tolist()
        flat = str(distinct.buffers()[2], "latin-1") if wide == 1 else str(distinct.buffers()[2], "utf-32-le", "surrogatepass")
        keys = [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        found = np.fromiter(map(self.index.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))
        new = np.flatnonzero(found < 0)
        if len(new):
            found[new] = len(self.index) + np.arange(len(new))
            self.add([keys[i] for i in new.tolist()])
        self.met[found] += 1
        places = found[back]
        first = self.offset[places]
        count = self.offset[places + 1] - first
        ends = np.cumsum(count)
        place = np.repeat(first - (ends - count), count)
        place += np.arange(len(place))
        return self.data[place], count


def one_byte(text: str) -> bytes | None:
    """The code points of a text that has none beyond 255."""
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return None


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points, each text followed by a 0, and where each text begins (and the end).

    A code point is one byte where that will do for all texts, else four.
    """
    text = "\0".join(texts) + "\0"
    short = one_byte(text)
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) if short is None else np.frombuffer(short, dtype=np.uint8)
    begin = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
    return chars, begin


def contractions(chars: np.ndarray, kind: np.ndarray, after_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where a contraction such as 've begins, and its length."""
    at = np.flatnonzero(chars[:-1] == 39)
    if len(at) == 0:
        return at, at
    before = np.where(at > 0, kind[at - 1], END)
    free = before != OTHER
    if not after_space:  # a space before takes the apostrophe with it
        free &= (at == 0) | (chars[at - 1] != 32)
    at = at[free]
    one = chars[at + 1]
    two = chars[np.minimum(at + 2, len(chars) - 1)]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    size = np.where(short, 2, np.where(long, 3, 0))
    return at[size > 0], size[size > 0]


def spaced_words(chars: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of byte-level BPE: a space belongs to the word after it; nothing is dropped."""
    start = np.r_[True, kind[1:] != kind[:-1]]
    start |= kind == END
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != END))
    start[last] = True
    start[last[chars[last] == 32] + 1] = False
    at, size = contractions(chars, kind, after_space=False)
    start[at + 1] = False
    start[at[size == 3] + 2] = False
    start[at + size] = True
    first = np.flatnonzero(start)
    end = np.r_[first[1:], len(chars)]
    words = kind[first] != END
    return first[words], end[words]


def lower_words(chars: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the lower-case BPE: runs of letters, single numbers, runs of others; white space goes."""
    start = np.r_[True, kind[1:] != kind[:-1]] | (kind == NUMBER) | (kind == END)
    at, size = contractions(chars, kind, after_space=True)
    start[at + 1] = False
    start[at[size == 3] + 2] = False
    start[at + size] = True
    first = np.flatnonzero(start)
    end = np.r_[first[1:], len(chars)]
    words = (kind[first] != END) & (kind[first] != SPACE)
    return first[words], end[words]


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


@cache
def id_space(path: str) -> int:
    """One more than the greatest id of a tokenizer."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab().values(), default=0) + 1


def id_type(space: int) -> str:
    """The type of ids below ``space``, little-endian."""
    return "<u2" if space <= 1 << 16 else "<u4"


class Encoder:
    """ids of whole texts as the tokenizers library gives them (no special tokens added)."""

    #: The cut, and whether it is of lower case (then white space is in no word).
    CUTS = {"byte": (spaced_words, False), "word": (lower_words, True)}

    def __init__(self, path: str, cut: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cut, self.lower = self.CUTS[cut]
        self.classes, self.letters = character_classes(), byte_letters()
        self.table = self.classes[:256].tobytes()
        self.ascii = {i: c for i, c in enumerate(self.letters[:128])}
        #: As ``id_space``, without a second tokenizer in the worker's memory.
        self.space = max(self.tokenizer.get_vocab().values(), default=0) + 1
        self.memo = Memo(self.word, id_type(self.space))

    def word(self, word: str) -> list[int]:
        if word.isascii():  # of the printable characters only the blank is written by another letter
            shown = word.replace(" ", self.letters[32]) if word.isprintable() else word.translate(self.ascii)
        else:
            shown = "".join([self.letters[b] for b in word.encode()])
        return [t.id for t in self.model.tokenize(shown)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        kind = self.memo.kind
        lowered = [t.lower() for t in texts] if self.lower else texts
        chars, begin = code_points(lowered)
        classes = np.frombuffer(chars.tobytes().translate(self.table), dtype=np.uint8) if chars.itemsize == 1 else self.classes[np.minimum(chars, LIMIT)]
        bad = classes == ODD
        bad |= chars == 0
        bad[begin[1:] - 1] = False
        whole = np.unique(np.searchsorted(begin, np.flatnonzero(bad), side="right") - 1).tolist()
        whole = {*whole, *(i for i, t in enumerate(texts) if "<|" in t), *(i for i, t in enumerate(lowered) if len(t) != len(texts[i]))}
        if self.lower and one_byte("".join(texts)) is None:  # characters whose lower case alone is inside the classes
            whole |= {i for i, t in enumerate(texts) if not t.isascii() and any(ord(c) > 0x24F and not 0x2010 <= ord(c) < 0x203B and c != "€" for c in set(t))}
        if whole:
            classes = classes.copy()
            for i in whole:
                classes[begin[i] : begin[i + 1]] = END
        start, end = self.cut(chars, classes)
        inside = classes != END
        if self.lower:
            inside &= classes != SPACE
        ids, count = self.memo.values(chars, start, end, inside)
        upto = np.r_[0, np.cumsum(count)][np.searchsorted(start, begin)]
        out = [ids[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
        for i in whole:
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, dtype=kind)
        return out


ENCODERS: dict[tuple[str, str], Encoder] = {}
HELD.append(ENCODERS)


def encoder(path: str, cut: str) -> Encoder:
    """This worker's encoder, made once."""
    if (path, cut) not in ENCODERS:
        ENCODERS[path, cut] = Encoder(path, cut)
    return ENCODERS[path, cut]

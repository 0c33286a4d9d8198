"""Exact token counts at every prefix of a text, by dynamic programming.

A byte-pair encoding of a prefix is the encoding of a shorter prefix plus one
token, the only one that can follow the shorter prefix's last token: two tokens
can stand side by side if merging their joined characters gives the two again.
So the last token, and with it the count, of every prefix follows from those of
shorter ones.  No piece of the vocabulary has characters on both sides of
certain pairs (a space and what precedes it, most others of different kinds), so
words end there and each distinct word is solved once.

``prefix_counts`` stores one signed byte for each code point: by how much the
count changes with it.  ``answer_budgets`` answers questions from that store:
the count of a prefix, the longest prefix within a budget.  No text is encoded
again.

Cases: a null text is an empty one with no tokens; repeated rows give repeated
results; texts and words may have any length; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HELD, slices, table, text_or_empty
from .words import Memo

SPACE = "▁"
MOST_PAIRS = 300_000


class PrefixCounter:
    """Prefix counts for a sentencepiece BPE model with byte fallback and no normalization."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        # Ligatures, wide letters, accents apart, runs of blanks, other white space: kept as they are, or the counts would be of another text.
        odd = "ﬁ Ａ  x\u0301 \t\n İ "
        if m.normalize(odd) != SPACE + odd.replace(" ", SPACE):
            raise ValueError("the model changes texts before it cuts them; prefix counts need one that does not")
        self.rank = {m.id_to_piece(i): -m.get_score(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))}
        self.longest = max(map(len, self.rank))
        self.fits: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self.memo = Memo(self.deltas, "int8")
        inside = np.array(sorted({ord(a) << 32 | ord(b) for p in self.rank for a, b in zip(p, p[1:])}), dtype=np.int64)
        self.joined = inside
        self.small = np.zeros((0x400, 0x400), dtype=bool)
        near = inside[((inside >> 32) < 0x400) & ((inside & 0xFFFFFFFF) < 0x400)]
        self.small[near >> 32, near & 0xFFFFFFFF] = True

    def merge(self, text: str) -> list[str]:
        """The plain encoding: join the neighbours of best rank, the leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fit(self, a: str, b: str) -> bool:
        found = self.fits.get((a, b))
        if found is None:
            if len(self.fits) > MOST_PAIRS:
                self.fits.clear()
            found = self.fits[a, b] = self.merge(a + b) == [a, b]
        return found

    def alone(self, a: str) -> bool:
        found = self.whole.get(a)
        if found is None:
            found = self.whole[a] = self.merge(a) == [a]
        return found

    def cost(self, c: str) -> int:
        return 1 if len(c) > 1 or c in self.rank else len(c.encode("utf-8", "surrogatepass"))

    def deltas(self, word: str) -> Sequence[int]:
        """By how much each code point of the word changes the count."""
        last, count, out = [""], [0], []
        rank, fits, longest = self.rank, self.fits, self.longest
        for i in range(1, len(word) + 1):
            for n in range(min(i, longest), 0, -1):
                token = word[i - n : i]
                if n > 1 and token not in rank:
                    continue
                before = last[i - n]
                if before is None:
                    continue
                ok = self.alone(token) if not before else fits.get((before, token))
                if ok is None:
                    ok = self.fit(before, token)
                if ok:
                    break
            else:
                raise ValueError(f"no token ends the prefix {word[:i]!r}")
            last.append(token)
            count.append(count[i - n] + (1 if n > 1 else self.cost(token)))
            out.append(count[i] - count[i - 1])
        return out

    def cut(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words: a word ends wherever no piece has the two characters side by side."""
        a, b = chars[:-1].astype(np.int64), chars[1:].astype(np.int64)
        near = (a < 0x400) & (b < 0x400)
        join = np.zeros(len(a), dtype=bool)
        join[near] = self.small[a[near], b[near]]
        far = np.flatnonzero(~near)
        if len(far):
            key = a[far] << 32 | b[far]
            k = np.minimum(np.searchsorted(self.joined, key), len(self.joined) - 1)
            join[far] = self.joined[k] == key
        start = np.flatnonzero(np.r_[True, ~join])
        return start, np.r_[start[1:], len(chars)]

    def count(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, the changes of the count: first its leading space's, then each code point's."""
        shown = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        joined = "".join(shown)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(s) for s in shown])
        if not len(chars):
            return [np.zeros(0, dtype=np.int8) for _ in texts]
        start, end = self.cut(chars)
        edges = np.union1d(start, ends[ends < len(chars)])  # a text's last word may seem to go on in the next
        values, _ = self.memo.values(chars, edges, np.r_[edges[1:], len(chars)])
        return np.split(values, ends[:-1])


COUNTERS: dict[str, PrefixCounter] = {}
HELD.append(COUNTERS)


def counter(path: str) -> PrefixCounter:
    if path not in COUNTERS:
        COUNTERS[path] = PrefixCounter(path)
    return COUNTERS[path]


def prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes and the prefix store ``deltas``: its first byte is the leading space's, then one a code point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in slices(batches, "text", 1 << 20):
            found = c.count(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x.tobytes() for x in found], pa.binary())], ["doc_id", "n_bytes", "deltas"])

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, deltas binary")


def counts(deltas: bytes) -> np.ndarray:
    """Tokens of the prefix of i code points, for i from 0; the empty prefix has none."""
    out = np.cumsum(np.frombuffer(deltas, dtype=np.int8), dtype=np.int64)
    if len(out):
        out[0] = 0
    return out if len(out) else np.zeros(1, dtype=np.int64)


def longest_prefix(deltas: bytes, budget: int) -> int:
    """Code points of the longest prefix with at most ``budget`` tokens."""
    return int(np.flatnonzero(counts(deltas) <= budget)[-1])


def answer_budgets(store: DataFrame, budget: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens and fit_chars, the longest prefix within the budget, from the store alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, fit = [], []
            for raw in b.column(2):
                c = counts(raw.as_py())
                total.append(int(c[-1]))
                fit.append(len(c) - 1 if len(c) <= budget else int(np.flatnonzero(c <= budget)[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(total, pa.int64()), pa.array(fit, pa.int64())], ["doc_id", "n_bytes", "n_tokens", "fit_chars"])

    return store.select("doc_id", "n_bytes", "deltas").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, fit_chars long")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    limit = 4096
    found = answer_budgets(prefix_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")), limit)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars")

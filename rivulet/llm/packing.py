"""Order-preserving packing of documents into windows of a fixed number of tokens.

Documents stay in ascending doc_id order.  Windows are cut where a document or
a sentence ends (inside a sentence only when it is longer than the window),
and dynamic programming chooses the cuts that cost least: the padding of each
window plus a penalty for each document cut in two.  With positions p and cost
f, ``f[j] = pen[j] + size - p[j] + min(f[i] + p[i])`` over boundaries i at most
``size`` before j; the minimum comes from a monotone queue, so a boundary costs
a constant time.

A bucket of consecutive documents is packed in one task, in blocks: the last
window of a block is opened again in the next one, so only a bucket's last
window is padded for want of documents, and a bucket's size does not bound memory.
Rows that share an id (or have none) are dealt over as many buckets as they fill.

Cases: a null text is an empty one and has the end id alone; a null doc_id is
first; repeated rows are packed each; documents of any length are cut; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Buckets, bucket_bounds, partitions_of, slices, table, text_or_empty
from .words import encoder, id_space, id_type

SIZE = 1024
SENTENCE_PENALTY = 2
INSIDE_PENALTY = 48
STEP = 128
BLOCK = 1 << 19


def tokenized(docs: DataFrame, path: str, cut: str, end_id: int, rows_per_bucket: int, most_bytes: int = 1 << 20) -> DataFrame:
    """bucket, doc_id, n_tokens, crc and ids (little-endian, of the vocabulary's ``id_type``) of each document and its end id.

    Texts are encoded ``most_bytes`` at a time: more of them share their words, and take some 40 times as much memory.
    """
    bounds = docs.sparkSession.sparkContext.broadcast(bucket_bounds(docs, "doc_id", rows_per_bucket))
    kind = id_type(max(id_space(path), end_id + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, dealt = encoder(path, cut), Buckets(bounds.value)
        for b in slices(batches, "text", most_bytes):
            texts = b.column(1).to_pylist()
            ids = [np.append(x, np.array(end_id, dtype=kind)).astype(kind, copy=False) for x in enc.encode(texts)]
            bucket = pa.array(dealt.of(b.column(0), texts), pa.int32())
            cols = [pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays([bucket, b.column(0), *cols], ["bucket", "doc_id", "n_tokens", "crc", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "bucket int, doc_id long, n_tokens long, crc long, ids binary")


def in_order(rows: DataFrame) -> DataFrame:
    """Each bucket in one partition, its documents in order."""
    return rows.repartition(partitions_of(rows.sparkSession), "bucket").sortWithinPartitions("bucket", "doc_id", "n_tokens", "crc")


def cuts(position: np.ndarray, penalty: np.ndarray, size: int = SIZE) -> list[int]:
    """Indexes of the boundaries that end a window; position[0] is 0, and no gap exceeds ``size``."""
    p, pen = position.tolist(), penalty.tolist()
    f, came = [0] * len(p), [0] * len(p)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # (f + p, p, index), f + p ascending
    for j in range(1, len(p)):
        least = p[j] - size
        while queue[0][1] < least:
            queue.popleft()
        best, _, i = queue[0]
        f[j], came[j] = best + size - p[j] + pen[j], i
        g = f[j] + p[j]
        while queue and queue[-1][0] >= g:
            queue.pop()
        queue.append((g, p[j], j))
    out, j = [], len(p) - 1
    while j:
        out.append(j)
        j = came[j]
    return out[::-1]


def boundaries(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, and what a cut there costs."""
    inner = np.flatnonzero(sentence_end[ids]) + 1
    position = np.unique(np.concatenate([[0], inner, doc_ends]))
    gap = np.diff(position)
    far = np.flatnonzero(gap > size)
    more = np.concatenate([np.zeros(0, np.int64), *(np.arange(position[i] + STEP, position[i + 1], STEP) for i in far.tolist())])
    every = np.unique(np.concatenate([position, more]))
    penalty = np.full(len(every), SENTENCE_PENALTY, dtype=np.int64)
    penalty[np.searchsorted(every, more)] = INSIDE_PENALTY
    penalty[np.searchsorted(every, doc_ends)] = 0
    return every, penalty


class Packer:
    """Packs one bucket's documents, given in order, into windows numbered from 0."""

    def __init__(self, sentence_end: np.ndarray, size: int = SIZE) -> None:
        self.sentence_end, self.size = sentence_end, size
        self.sequence, self.offset = 0, 0
        self.docs: list[tuple[int | None, int, int, np.ndarray]] = []  # doc_id, tokens, ids packed before, ids left
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[tuple]:
        self.docs.append((doc_id, len(ids), 0, ids))
        self.held += len(ids)
        return self.pack(last=False) if self.held >= BLOCK else []

    def pack(self, last: bool) -> list[tuple]:
        """(doc_id, start, length, crc, doc_tokens, sequence, offset) of all windows (but the last, unless ``last``)."""
        if not self.docs:
            return []
        ids = np.concatenate([d[3] for d in self.docs])
        ends = np.cumsum([len(d[3]) for d in self.docs])
        position, penalty = boundaries(ids, ends, self.sentence_end, self.size)
        found = position[cuts(position, penalty, self.size)]
        whole = found if last else found[:-1]
        if len(whole) == 0:
            return []
        upto = int(whole[-1])
        edges = np.union1d(np.concatenate([[0], whole]), ends[ends < upto])
        window = np.searchsorted(whole, edges[:-1], side="right")
        first = np.concatenate([[0], whole])[window]
        doc = np.searchsorted(ends, edges[:-1], side="right")
        data, out = ids.astype("<u4").tobytes(), []
        begin = ends - [len(d[3]) for d in self.docs]
        for a, b, w, f, d in zip(edges[:-1].tolist(), edges[1:].tolist(), window.tolist(), first.tolist(), doc.tolist(), strict=True):
            doc_id, tokens, done, _ = self.docs[d]
            out.append((doc_id, done + a - int(begin[d]), b - a, zlib.crc32(data[4 * a : 4 * b]), tokens, self.sequence + w, a - f))
        self.sequence += len(whole)
        keep = int(np.searchsorted(ends, upto, side="right"))
        left = [(i, n, done + max(0, upto - int(begin[k])), x[max(0, upto - int(begin[k])) :]) for k, (i, n, done, x) in enumerate(self.docs[keep:], keep)]
        self.docs, self.held = left, sum(len(d[3]) for d in left)
        return out


SENTENCE_ENDS: dict[tuple[str, str, int], np.ndarray] = {}


def sentence_ends(path: str, cut: str, end_id: int) -> np.ndarray:
    """For each id up to the end id at least, whether its string ends a sentence or a line."""
    if (path, cut, end_id) not in SENTENCE_ENDS:
        tokenizer = encoder(path, cut).tokenizer
        shown = [tokenizer.id_to_token(i) or "" for i in range(max(encoder(path, cut).space, end_id + 1))]
        line = encoder(path, cut).letters[10]
        SENTENCE_ENDS[path, cut, end_id] = np.array([s.endswith((".", "!", "?", "…", line)) for s in shown], dtype=bool)
    return SENTENCE_ENDS[path, cut, end_id]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, path: str, cut: str = "byte", end_id: int = 0, size: int = SIZE, rows_per_bucket: int = 1024) -> DataFrame:
    """One row per piece of a document; a sequence's number has its bucket in the upper 32 bits."""
    names = [x.split()[0] for x in PIECES.split(", ")]
    kind = id_type(max(id_space(path), end_id + 1))

    def batch(bucket: int, rows: list[tuple]) -> pa.RecordBatch:
        cols = [list(x) for x in zip(*rows, strict=True)]
        cols[5] = [(bucket << 32) + x for x in cols[5]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = sentence_ends(path, cut, end_id)
        at, packer = None, None
        for b in batches:
            for k, doc_id, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(4), strict=True):
                if k != at:
                    if packer and (rows := packer.pack(last=True)):
                        yield batch(at, rows)
                    at, packer = k, Packer(ends, size)
                if rows := packer.add(doc_id, np.frombuffer(raw.as_buffer(), dtype=kind)):
                    yield batch(at, rows)
        if packer and (rows := packer.pack(last=True)):
            yield batch(at, rows)

    return in_order(tokenized(docs, path, cut, end_id, rows_per_bucket)).mapInArrow(run, PIECES)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))

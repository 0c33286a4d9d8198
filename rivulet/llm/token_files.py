"""Token files compressed by Re-Pair grammars, one grammar a shard.

A shard holds consecutive documents of a bucket.  Its ids are compressed by
replacing frequent pairs with nonterminals, round after round, until no pair is
there ``LEAST_COUNT`` times any more: fewer do not pay for their rule.  A round
takes pairs in descending order of frequency as long as no symbol is the right side
of one and the left side of another: occurrences of such pairs never overlap,
so replacing them together equals replacing them one after the other.  A pair
of equal symbols is taken from the left of each run.  No pair spans two
documents.

The file of a shard stores the rules, the expansion length of each nonterminal,
the compressed symbols and where each document begins in them.  With the
lengths, any range of a document's ids is found and decoded without expanding
what precedes it.  Symbols and lengths have as many bits as the greatest needs, so
vocabularies and grammars of any size fit; nonterminals are numbered from the first
number that is no id.

Files are kept as binary values of a Parquet table in the shared folder,
so they are written by Spark's commit protocol and any executor can read them; each
value is a file by itself, which ``TokenFile`` opens without the others.

Cases: a null text is an empty one and has the end id alone; a null doc_id is
first; repeated rows are written each; a document longer than a shard is a
shard of its own; an empty table gives no files; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, table
from .packing import in_order, tokenized
from .words import id_space, id_type

MAGIC = b"RVRP"
VERSION = 2
SHARD_IDS = 1 << 20
LEAST_COUNT = 4


#: Symbols move up in a round that replaces one in so many.
FEW = 16
#: Pairs are told apart by at most so many bits of a hash before they are compared.
MARK_BITS = 20


def marks(pairs: np.ndarray, bits: int = MARK_BITS) -> np.ndarray:
    out = pairs * np.uint64(0x9E3779B97F4A7C15)
    out >>= np.uint64(64 - bits)
    return out.view(np.int64)


def repair(ids: np.ndarray, doc_last: np.ndarray, first_rule: int, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules as pairs, compressed symbols, indexes of documents' last symbols).

    ``doc_last`` has the index of each document's last id; ids are below ``first_rule``.
    A pair that is frequent after a round was so before it, or has one of the round's
    nonterminals; only places of such pairs are counted again.  Once a
    round replaces few, symbols stay at their places and know the next and the one
    before, so a round takes time for the places that it counts, not for all.
    """
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), dtype=bool)
    last[doc_last] = True
    live = ~last
    after = before = gone = None  # a document's last symbol is followed by another's first
    rules, n_rules = [np.zeros(0, dtype=np.uint64)], 0
    while True:
        place = np.flatnonzero(live)
        key = seq[place].astype(np.uint64)
        key <<= np.uint64(32)
        key |= seq[place + 1 if after is None else after[place]]
        ordered = np.sort(key)
        edge = np.r_[np.zeros(min(1, len(ordered)), dtype=np.int64), np.flatnonzero(ordered[1:] != ordered[:-1]) + 1]
        count = np.diff(np.r_[edge, len(ordered)])
        often = np.flatnonzero(count >= least)
        if not len(often):
            break
        # Most frequent first, equal counts in order of the pair.
        pairs = ordered[edge[often[np.argsort(-count[often], kind="stable")]]]
        left, right, chosen = bytearray(first_rule + n_rules), bytearray(first_rule + n_rules), []
        for i, (a, b) in enumerate(zip((pairs >> np.uint64(32)).tolist(), (pairs & np.uint64(0xFFFFFFFF)).tolist(), strict=True)):
            # Nothing else may touch the runs of a pair of equal symbols.
            if right[a] or left[b] or (a == b and (left[a] or right[a])):
                continue
            left[a] = right[b] = 1
            chosen.append(i)
        found = np.sort(pairs[chosen])
        # By mark: 0 for no pair, -1 for pairs that are not chosen, else one more than the number of a chosen one.
        bits = min(MARK_BITS, len(pairs).bit_length() + 3)
        slot = np.zeros(1 << bits, dtype=np.int32)
        slot[marks(pairs, bits)] = -1
        own, number = marks(found, bits), np.arange(1, len(found) + 1, dtype=np.int32)
        slot[own] = number
        seen = slot[marks(key, bits)]
        maybe = np.flatnonzero(seen > 0)
        held, rule = key[maybe], seen[maybe] - 1
        hit = found[rule] == held
        # Chosen pairs that share a mark with another are looked for.
        hidden = found[slot[own] != number]
        if len(hidden):
            miss = np.flatnonzero(~hit)
            k = np.minimum(np.searchsorted(hidden, held[miss]), len(hidden) - 1)
            there = hidden[k] == held[miss]
            rule[miss[there]] = np.searchsorted(found, hidden[k[there]])
            hit[miss[there]] = True
        hit = np.flatnonzero(hit)
        at, rule = place[maybe[hit]], rule[hit]
        # Only runs of one symbol overlap themselves: take every other place of a run.
        right = at + 1 if after is None else after[at]
        new = np.r_[True, at[1:] != right[:-1]]
        if not new.all():
            start = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
            take = (np.arange(len(at)) - start) % 2 == 0
            take = np.flatnonzero(take)
            at, rule, right = at[take], rule[take], right[take]
        live[place] = seen != 0
        live[at] = True
        seq[at] = first_rule + n_rules + rule
        last[at] = last[right]
        if after is None and FEW * len(at) >= len(seq):
            live[at[at > 0] - 1] = True
            keep = np.ones(len(seq), dtype=bool)
            keep[right] = False
            keep = np.flatnonzero(keep)  # by places, for masks without a pattern are slow
            seq, last, live = seq[keep], last[keep], live[keep]
        else:
            if after is None:
                after, before, gone = np.arange(1, len(seq) + 1), np.arange(-1, len(seq)), np.zeros(len(seq), dtype=bool)
            live[right], gone[right] = False, True
            after[at] = beyond = after[right]
            before[beyond] = at
            ahead = before[at]
            live[ahead[ahead >= 0]] = True
        live &= ~last
        rules.append(found)
        n_rules += len(found)
    if gone is not None:
        seq, last = seq[~gone], last[~gone]
    flat = np.concatenate(rules)
    return np.stack([flat >> np.uint64(32), flat & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32), seq, np.flatnonzero(last)


def depths(rules: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray]:
    """(how many rules deep, how many ids long) each nonterminal is."""
    # The last place stands for ids.
    inner = np.maximum(rules.astype(np.int64) - first_rule, -1)
    deep, long = np.zeros(len(rules) + 1, dtype=np.int64), np.ones(len(rules) + 1, dtype=np.int64)
    needs, a = np.maximum.accumulate(inner.max(axis=1, initial=-1)), 0
    while a < len(rules):
        # The rules up to b need none that comes after the first a.
        b = int(np.searchsorted(needs, a))
        if b <= a:
            raise ValueError(f"rule {a} needs a later one")
        left, right = inner[a:b, 0], inner[a:b, 1]
        deep[a:b], long[a:b] = 1 + np.maximum(deep[left], deep[right]), long[left] + long[right]
        a = b
    return deep[:-1], long[:-1]


class Grammar:
    """Expansions of all nonterminals, those less deep first."""

    def __init__(self, rules: np.ndarray, first_rule: int) -> None:
        self.first_rule = first_rule
        deep, self.lengths = depths(rules, first_rule)
        self.offset = np.zeros(len(rules), dtype=np.int64)
        self.data = np.zeros(int(self.lengths.sum()), dtype=np.uint32)
        at = 0
        for d in range(1, int(deep.max(initial=0)) + 1):
            here = np.flatnonzero(deep == d)
            size = self.lengths[here]
            self.offset[here] = at + np.cumsum(size) - size
            flat = self.expand(rules[here].reshape(-1))
            self.data[at : at + len(flat)] = flat
            at += len(flat)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        if not len(self.data):
            return symbols.astype(np.uint32)
        rule = symbols.astype(np.int64) - self.first_rule
        single = np.flatnonzero(rule < 0)
        rule[single] = 0  # read like a rule, and then put right
        length = self.lengths[rule]
        length[single] = 1
        ends = np.cumsum(length)
        begin = ends - length
        source = np.repeat(self.offset[rule] - begin, length)
        source += np.arange(len(source))
        out = self.data[source]
        out[begin[single]] = symbols[single]
        return out


def bits_for(most: int) -> int:
    return max(1, int(most).bit_length())


def packed_bytes(n: int, bits: int) -> int:
    return 8 * (-(-n * bits // 64) + 1)


def pack_bits(x: np.ndarray, bits: int) -> bytes:
    """Numbers of ``bits`` (at most 32) bits one after the other, in 64-bit words and one word more."""
    out = np.zeros(packed_bytes(len(x), bits) // 8, dtype="<u8")
    if len(x):
        place = np.arange(len(x), dtype=np.int64) * bits
        word, shift, x = place >> 6, (place & 63).astype(np.uint64), x.astype(np.uint64)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        out[word[first]] = np.add.reduceat(x << shift, first)
        over = np.flatnonzero(shift + np.uint64(bits) > 64)
        out[word[over] + 1] += x[over] >> (np.uint64(64) - shift[over])
    return out.tobytes()


def unpack_bits(words: np.ndarray, first: int, last: int, bits: int) -> np.ndarray:
    """Numbers ``first`` to ``last`` (excluded) of those packed in 64-bit words."""
    place = np.arange(first, last, dtype=np.int64) * bits
    word, shift = place >> 6, (place & 63).astype(np.uint64)
    low = words[word] >> shift
    # A shift by 64 is not defined, so by one and then by 63 at most.
    high = words[word + 1] << np.uint64(1) << (np.uint64(63) - shift)
    return ((low | high) & np.uint64((1 << bits) - 1)).astype(np.uint32)


HEAD = "<4sHBBIIQQI"


def write_file(doc_ids: list[int | None], ids: list[np.ndarray], first_rule: int, least: int = LEAST_COUNT) -> bytes:
    """Magic, version, bits of symbols and of lengths, sizes, checksum of the rest; rules; lengths; symbols; per document its id, whether it is null, first symbol, tokens."""
    size = np.array([len(x) for x in ids], dtype=np.int64)
    joined = np.concatenate(ids) if ids else np.zeros(0, dtype=np.uint32)
    if len(joined) and int(joined.max()) >= first_rule:
        raise ValueError(f"id {int(joined.max())} is not below {first_rule}")
    rules, symbols, last = repair(joined, np.cumsum(size) - 1, first_rule, least)
    lengths = depths(rules, first_rule)[1]
    wide, long = bits_for(first_rule + len(rules) - 1), bits_for(lengths.max(initial=1))
    begin = np.r_[0, last[:-1] + 1] if len(last) else np.zeros(0, np.int64)
    null = np.array([d is None for d in doc_ids], dtype=np.uint8)
    known = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    body = b"".join([pack_bits(rules.reshape(-1), wide), pack_bits(lengths, long), pack_bits(symbols, wide), known.tobytes(), null.tobytes(), begin.astype("<u8").tobytes(), size.astype("<u8").tobytes()])
    return struct.pack(HEAD, MAGIC, VERSION, wide, long, first_rule, len(rules), len(symbols), len(ids), zlib.crc32(body)) + body


class TokenFile:
    """A file's documents, read at random."""

    HEAD = struct.calcsize(HEAD)

    def __init__(self, blob: bytes) -> None:
        if len(blob) < self.HEAD:
            raise ValueError("not a token file")
        magic, version, self.bits, long, self.first_rule, n_rules, self.n_symbols, n_docs, crc = struct.unpack_from(HEAD, blob)
        if magic != MAGIC or version != VERSION or zlib.crc32(memoryview(blob)[self.HEAD :]) != crc:
            raise ValueError("not a token file, or a damaged one")
        at = self.HEAD

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        packed = lambda n, bits: take("<u8", packed_bytes(n, bits) // 8)
        self.rules = unpack_bits(packed(2 * n_rules, self.bits), 0, 2 * n_rules, self.bits).reshape(-1, 2)
        self.lengths = unpack_bits(packed(n_rules, long), 0, n_rules, long).astype(np.int64)
        self.packed = packed(self.n_symbols, self.bits)
        known, null = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if z else d for d, z in zip(known.tolist(), null.tolist(), strict=True)]
        self.begin = np.r_[take("<u8", n_docs).astype(np.int64), self.n_symbols]
        self.sizes = take("<u8", n_docs).astype(np.int64)
        self._grammar: Grammar | None = None

    @property
    def grammar(self) -> Grammar:
        if self._grammar is None:
            self._grammar = Grammar(self.rules, self.first_rule)
        return self._grammar

    def symbols(self, i: int) -> np.ndarray:
        """The symbols of document i."""
        return unpack_bits(self.packed, int(self.begin[i]), int(self.begin[i + 1]), self.bits)

    def document(self, i: int) -> np.ndarray:
        return self.grammar.expand(self.symbols(i))

    def documents(self) -> Iterator[np.ndarray]:
        """All documents' ids; the whole file is expanded at once."""
        flat, ends = self.grammar.expand(unpack_bits(self.packed, 0, self.n_symbols, self.bits)), np.cumsum(self.sizes)
        for a, b in zip((ends - self.sizes).tolist(), ends.tolist(), strict=True):
            yield flat[a:b]

    def window(self, i: int, start: int, stop: int) -> np.ndarray:
        """ids start to stop of document i; lengths tell which symbols those need, and only they are expanded."""
        symbols = self.symbols(i)
        start, stop = max(0, start), min(stop, int(self.sizes[i]))
        if start >= stop:
            return np.zeros(0, dtype=np.uint32)
        rule = symbols.astype(np.int64) - self.first_rule
        size = np.where(rule >= 0, self.lengths[np.maximum(rule, 0)] if len(self.lengths) else 1, 1)
        ends = np.cumsum(size)
        a, b = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(ends, stop, side="left")) + 1
        skip = start - int(ends[a] - size[a])
        return self.grammar.expand(symbols[a:b])[skip : skip + stop - start]


def write_token_files(docs: DataFrame, path: str, cut: str = "word", end_id: int = 2, shard_ids: int = SHARD_IDS, rows_per_bucket: int = 2048) -> DataFrame:
    """bucket, shard, n_docs, n_ids and the file of each shard; buckets and shards ascend with doc_id."""
    names = ["bucket", "shard", "n_docs", "n_ids", "file"]
    first_rule = max(id_space(path), end_id + 1)
    kind = id_type(first_rule)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard, doc_ids, held, n = None, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(held)], pa.int64()), pa.array([n], pa.int64()), pa.array([write_file(doc_ids, held, first_rule)], pa.binary())], names)

        for b in batches:
            for k, doc_id, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(4), strict=True):
                ids = np.frombuffer(raw.as_buffer(), dtype=kind)
                if held and (k != at or n + len(ids) > shard_ids):
                    yield flush()
                    shard, doc_ids, held, n = (shard + 1 if k == at else 0), [], [], 0
                at = k
                doc_ids.append(doc_id)
                held.append(ids)
                n += len(ids)
        if held:
            yield flush()

    return in_order(tokenized(docs, path, cut, end_id, rows_per_bucket, 4 << 20)).mapInArrow(run, "bucket int, shard int, n_docs long, n_ids long, file binary")


def with_starts(files: DataFrame) -> DataFrame:
    """Each file's ``start``: the ids of all files before it.

    Buckets are summed first; the running sum over buckets has a row for each,
    the one inside a bucket a row for each of its shards.
    """
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0).cast("long"))
    totals = files.groupBy("bucket").agg(F.sum("n_ids").alias("total")).select("bucket", zero("total", before).alias("lead"))
    places = files.select("bucket", "shard", zero("n_ids", inside).alias("within")).join(totals, "bucket").select("bucket", "shard", (F.col("lead") + F.col("within")).alias("start"))
    return files.join(places, ["bucket", "shard"])


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files (with ``start``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                f = TokenFile(raw.as_buffer().to_pybytes())
                crc = [zlib.crc32(x.astype("<u4", copy=False)) for x in f.documents()]
                starts = start + np.cumsum(f.sizes) - f.sizes
                yield pa.RecordBatch.from_arrays([pa.array(f.doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(f.sizes, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("start", "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = materialize(write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")), "token-files")
    return read_token_files(with_starts(files))

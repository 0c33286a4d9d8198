"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by their number of shingles; a partition has the
sizes up to ``u``, and sizes grow by the square root of two from one partition
to the next.  For each partition a document is seen as windows of 1.5 u
shingles, u / 2 apart, so a copy of an item lies wholly in some window and makes
up a known share of it however long the document is.  Items and windows are
sketched by one-permutation MinHash: shingles fall into 64 bins and the least
of each bin is kept.  An item and a document are candidates if they share the
least of a bin; candidates are verified by exact containment: the share of the
item's distinct shingles that the document has.

Many items may share a passage (an instruction, a first sentence), and then each
document with it would be a candidate of each of them.  So an item is sketched by
its rare shingles only.  A document with the share t of an item's n shingles has one
at least of any n - ceil(t n) + 1 of them; these are taken by frequency among the
items, the rarest first, and with them all others as rare as the last.  So no match
is lost by the choice, and a passage of many items makes none of them a candidate
unless most of an item consists of such passages.

All item shingles are also put into a Bloom filter of bounded size that all tasks
get.  A shingle outside it is in no item, so a document is left with what it shares
with the benchmark, and only that is joined.  The benchmark itself is joined, not
broadcast: it may grow.

An item of one to four words has no five-word shingle; it is found where its words
occur one after the other.

Cases: null texts and texts without a word match nothing; repeated rows are found
once; equal ids with other texts are kept apart; null ids of documents and of items
are ids like others; an empty table on either side gives an empty result; other
columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, slices, table
from .near_duplicates import text_hash
from .shingles import SQL_WORDS, WORDS, mix, shingles

THRESHOLD = 0.8
BINS = 64
PROBES = 3
#: Bits of the filter for each probe, as a power of two: the least and the most (a megabyte, packed).
LEAST_BITS, MOST_BITS = 20, 23


def size_class(n: int) -> int:
    """The least u of 1, 2, 3, 4, 6, 8, 12, ... that is at least n."""
    u = 1
    while u < n:
        u = u + u // 2 if u & (u - 1) == 0 and u > 1 else (1 << u.bit_length()) if u > 1 else 2
    return u


def values(hashes: np.ndarray) -> np.ndarray:
    """Another hash of shingles: its upper six bits are the bin, and order in a bin is by the rest."""
    return mix(hashes + np.uint64(0x5851F42D4C957F2D))


def probe(v: np.ndarray, j: int, size: int) -> np.ndarray:
    return (v >> np.uint64(20 * j)).astype(np.int64) & ((1 << size) - 1)


def hits(v: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Indexes of values that may be an item's."""
    at, size = np.arange(len(v)), bits.shape[1].bit_length() - 1
    for j in range(PROBES):
        at = at[bits[j, probe(v[at], j, size)]]
    return at


def run_values(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(values of all runs of so many words, runs of each text)."""
    h, n, _, count = shingles([t or "" for t in texts], words)
    fewer = count < words
    if (fewer & (n > 0)).any():
        h = h[~np.repeat(fewer, n)]
        n = np.where(fewer, 0, n)
    return values(h), n


def item_sets(items: DataFrame) -> DataFrame:
    """item_id, ih (a hash of the text), u (the partition; minus the number of words, if that is less than five) and its distinct values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            h, n, _, count = shingles([t or "" for t in b.column(2).to_pylist()])
            sets = [np.unique(x) for x in np.split(values(h), np.cumsum(n)[:-1])]
            u = [0 if c == 0 else -c if c < WORDS else size_class(len(s)) for s, c in zip(sets, count.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(u, pa.int64()), pa.array([s.view(np.int64).tolist() for s in sets], pa.list_(pa.int64()))], ["item_id", "ih", "u", "own"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), text_hash().alias("ih"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "item_id long, ih long, u long, own array<long>").where("u <> 0").dropDuplicates(["item_id", "ih"])


def sketch_items(sets: DataFrame, threshold: float) -> DataFrame:
    """ik, u and key: the least values of the bins of each item's rare shingles."""
    each = sets.select("ik", "u", F.size("own").alias("n"), F.explode("own").alias("v"))
    often = each.join(each.groupBy("v").agg(F.count("*").alias("items")), "v")
    needed = (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int")
    bound = often.groupBy("ik", "n").agg(F.sort_array(F.collect_list("items")).alias("f")).select("ik", F.get("f", needed - 1).alias("most"))
    rare = often.join(bound, "ik").where("items <= most")
    return rare.groupBy("ik", "u", F.shiftrightunsigned("v", 58).alias("bin")).agg(F.min("v").alias("key")).select("ik", "u", "key")


def bloom(v: DataFrame) -> np.ndarray:
    """The filter of all values of items; its size is bounded, and so is what comes to the driver."""
    n = v.count()
    size = min(MOST_BITS, max(LEAST_BITS, (8 * n).bit_length()))
    words = 1 << (size - 6)
    bit = [F.shiftrightunsigned("v", 20 * j).bitwiseAND((1 << size) - 1) + (j << size) for j in range(PROBES)]
    spread = v.select(F.explode(F.array(*bit)).alias("bit"))
    rows = spread.select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("one")).groupBy("word").agg(F.bit_or("one").alias("bits")).collect()
    out = np.zeros(PROBES * words, dtype=np.int64)
    for r in rows:
        out[r["word"]] = r["bits"]
    return np.unpackbits(out.view(np.uint8), bitorder="little").reshape(PROBES, -1).astype(bool)


def window_minima(v: np.ndarray, at: np.ndarray, u: int) -> np.ndarray:
    """Those indexes ``at`` whose value is the least of its bin in some window of partition ``u``."""
    step = max(1, u // 2)
    length, n, keep = u + step, len(v), []
    # Windows start at multiples of ``step``; the last ones may reach beyond the end.
    for back in range(-(-length // step)):
        first = (at // step - back) * step
        ok = (first >= 0) & (first + length > at)
        keep.append(np.zeros(len(at), dtype=bool))
        some = np.flatnonzero(ok)
        for k in range(0, len(some), max(1, (1 << 20) // length)):
            part = some[k : k + max(1, (1 << 20) // length)]
            place = first[part, None] + np.arange(length)
            inside = place < n
            other, own = v[np.minimum(place, n - 1)], v[at[part]][:, None]
            keep[-1][part] = ~(inside & (other < own) & (other >> np.uint64(58) == own >> np.uint64(58))).any(axis=1)
    return at[np.any(keep, axis=0)]


def sketch_documents(docs: DataFrame, bits: np.ndarray, partitions: list[int]) -> DataFrame:
    """doc_id, th, us and keys (bin minima of the documents' windows, for each partition) and own: the values that may be items'.

    Documents without such a value have no row.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    sizes, widths = [u for u in partitions if u > 0], [-u for u in partitions if u < 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            texts = b.column(2).to_pylist()
            found: dict[int, tuple[list, list, list]] = {}
            for words in ([WORDS] if sizes else []) + widths:
                v, n = run_values(texts, words)
                at, ends = hits(v, sent.value), np.cumsum(n)
                doc = np.searchsorted(ends, at, side="right")
                edges = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else doc
                for first, last in zip(edges.tolist(), [*edges[1:].tolist(), len(doc)], strict=True) if len(doc) else ():
                    d = int(doc[first])
                    a, here = int(ends[d] - n[d]), at[first:last]
                    whole = v[a : int(ends[d])]
                    us, keys, own = found.setdefault(d, ([], [], []))
                    own.append(np.unique(v[here]))
                    for u in sizes if words == WORDS else [-words]:
                        k = np.unique(whole[window_minima(whole, here - a, u)]) if u > 0 else own[-1]
                        us.append(np.full(len(k), u))
                        keys.append(k.view(np.int64))
            if found:
                take = pa.array(list(found))
                lists = [[np.concatenate(x[k]).astype(np.int64, copy=False) if k < 2 else np.concatenate(x[k]).view(np.int64) for x in found.values()] for k in range(3)]
                cols = [pa.array([y.tolist() for y in x], pa.list_(pa.int64())) for x in lists]
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), *cols], ["doc_id", "th", "us", "keys", "own"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("th"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, th long, us array<long>, keys array<long>, own array<long>")


def candidates(sketches: DataFrame, keys: DataFrame) -> DataFrame:
    """dk and ik of the documents and items that share the least of a bin."""
    spread = sketches.select("dk", F.explode(F.arrays_zip("us", "keys")).alias("k")).select("dk", F.col("k.us").alias("u"), F.col("k.keys").alias("key"))
    return spread.join(keys, ["u", "key"]).select("dk", "ik").distinct()


def contamination(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, th, item_id, n_shared, n_item and containment of every match."""
    number = F.monotonically_increasing_id()
    sets = materialize(item_sets(items).withColumn("ik", number), "items")
    partitions = sorted(r[0] for r in sets.select("u").distinct().collect())  # as many as the sizes' logarithm
    keys = materialize(sketch_items(sets, threshold), "item-keys")
    bits = bloom(sets.select(F.explode("own").alias("v")).distinct())
    sketches = materialize(sketch_documents(docs, bits, partitions).dropDuplicates(["doc_id", "th"]).withColumn("dk", number), "sketches")
    pairs = materialize(candidates(sketches, keys), "candidates")
    # Of each candidate's item the values, and of these the ones that the document has.
    wanted = pairs.join(sets.select("ik", F.explode("own").alias("v")), "ik")
    shared = wanted.join(sketches.select("dk", F.explode("own").alias("v")), ["dk", "v"]).groupBy("dk", "ik").agg(F.count("*").alias("n_shared"))
    size = F.size("own").cast("long")
    found = shared.join(sets.select("ik", "item_id", size.alias("n_item")), "ik").withColumn("containment", F.col("n_shared") / F.col("n_item"))
    return found.where(F.col("containment") >= threshold).join(sketches.select("dk", "doc_id", "th"), "dk").select("doc_id", "th", "item_id", "n_shared", "n_item", "containment")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shared", "n_item", "containment")


#: Every item against every document that shares a run of words with it.
OP6_SQL = f"""
WITH item AS (
  SELECT row_number() OVER () AS ik, item_id, w, least(len(w), {WORDS}) AS k FROM (SELECT item_id, {SQL_WORDS} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)) WHERE len(w) > 0
), doc AS (
  SELECT row_number() OVER () AS dk, doc_id, {SQL_WORDS} AS w FROM (SELECT DISTINCT doc_id, text FROM documents)
), item_run AS (
  SELECT DISTINCT ik, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS run FROM item
), doc_run AS (
  SELECT DISTINCT dk, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS run FROM doc, (SELECT DISTINCT k FROM item)
), shared AS (
  SELECT dk, ik, count(*) AS n_shared FROM doc_run JOIN item_run USING (k, run) GROUP BY dk, ik
), size AS (
  SELECT ik, count(*) AS n_item FROM item_run GROUP BY ik
)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM shared JOIN size USING (ik) JOIN item USING (ik) JOIN doc USING (dk) WHERE n_shared / n_item >= {THRESHOLD}
"""

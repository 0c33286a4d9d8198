"""Near-duplicate documents: DartMinHash signatures, banded joining, exact check.

A document is the weighted set of its five-word shingles, the weight being the
count.  Each shingle owns a region as wide as its weight and without end in
rank; hashing throws darts into it at rate one, region after region of doubling
rank, and each dart falls on one of 64 coordinates.  The earliest dart of a
coordinate is its value: two documents agree there with the probability of
their weighted Jaccard similarity.  A document takes only as many ranks as it
needs for about ``64 ln 64 + 128`` darts (more if a coordinate stays empty), so
long documents cost one pass over their shingles.

Texts with equal words are one node.  Nodes that agree in all four coordinates
of one of 16 bands share a bucket; buckets with the same nodes are one.  A
bucket of bounded size is compared in one task, every node with every other, by
the weighted Jaccard similarity of their whole texts, and yields links that span
what is similar in it, not its pairs.  In a larger bucket every node is first
compared with one of them; only nodes that are not similar to it are then
compared with the others, in blocks of bounded size.  So a large bucket of
copies of one text costs as much as it has nodes, nothing is capped, and no
task holds a whole one.  A bucket may also be large because a band collides on a
passage that many unlike documents share.  Its nodes agree in little else, so they
are compared in groups that agree in one of 21 triples of coordinates as well, if
that makes fewer pairs; of two texts of similarity 0.8 that meet in that bucket
alone, one pair in 200,000 agrees in none.  Classes are the connected components of
the links.

Cases: a null text, or one without a word, is in a class of its own, but for
equal texts that are not empty; repeated rows share a class; a null doc_id is
less than any other; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructType

from ..operators.components import components
from .common import forget, materialize, partitions_of, slices, table
from .shingles import GOLD, SQL_WORDS, WORDS, fingerprints, mix, shingles, units

COORDINATES = 64
ROWS = 4
THRESHOLD = 0.8
DARTS = int(COORDINATES * math.log(COORDINATES) + 2 * COORDINATES)
#: Buckets up to so many nodes and elements are compared in one task; larger ones in blocks of about this size.
BLOCK_NODES = 768
BLOCK_ELEMENTS = 2_000_000
#: Buckets up to so many blocks are compared all with all, by pairs of blocks: to look at them first takes longer.
DIRECT_BLOCKS = 2
FIRST = -4  # the first region has the ranks from 0 to 2**-4, each later one doubles the end


def poisson_steps(area: float) -> list[float]:
    """Distribution function of a Poisson count, up to where a double is 1."""
    out, term = [], math.exp(-area)
    total, k = term, 0
    while total < 1 - 1e-15:
        out.append(total)
        k += 1
        term *= area / k
        total += term
    return out


def uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def throw(elements: np.ndarray, owner: np.ndarray, level: int, best: np.ndarray) -> None:
    """Put the darts of one region of ranks into ``best`` (documents x coordinates, of ranks)."""
    low = 0.0 if level == 0 else 2.0 ** (FIRST + level - 1)
    width = 2.0**FIRST if level == 0 else low
    cells = max(1, int(width))
    if cells > 1:  # unit cells keep the count of darts in each small
        cell = np.tile(np.arange(cells), len(elements))
        elements, owner = np.repeat(elements, cells), np.repeat(owner, cells)
        seed, base = mix(elements + (np.uint64((level << 32) * GOLD & (1 << 64) - 1) + cell.astype(np.uint64) * np.uint64(GOLD))), low + cell.astype(np.float64)
    else:
        seed, base = mix(elements + np.uint64((level << 32) * GOLD & (1 << 64) - 1)), None
    size = width / cells
    u = uniform(seed)
    for j, p in enumerate(poisson_steps(size)):
        hit = np.flatnonzero(u >= p)
        if not len(hit):
            break
        dart = mix(seed[hit] + np.uint64((j + 1) * GOLD & (1 << 64) - 1))
        rank = (low if base is None else base[hit]) + size * uniform(dart)
        slot = owner[hit] * COORDINATES + (mix(dart) >> np.uint64(58)).astype(np.int64)
        np.minimum.at(best.reshape(-1), slot, rank)


def signatures(elements: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Ranks of the earliest darts: n x coordinates; infinite for a document without elements."""
    best = np.full((n, COORDINATES), np.inf)
    size = np.bincount(owner, minlength=n)
    need = np.zeros(n, dtype=np.int64)
    some = size > 0
    need[some] = np.maximum(0, np.ceil(np.log2(DARTS / size[some])) - FIRST).astype(np.int64)
    need[~some] = -1
    level = 0
    while (need >= level).any():
        take = (need >= level)[owner]
        throw(elements[take], owner[take], level, best)
        level += 1
        short = some & (need == level - 1) & np.isinf(best).any(axis=1)
        need[short] = level
    return best


def bands(best: np.ndarray) -> np.ndarray:
    """One hash for each band of coordinates."""
    bits = best.view(np.uint64).reshape(len(best), -1, ROWS)
    out = np.zeros(bits.shape[:2], dtype=np.uint64)
    for j in range(ROWS):
        out = mix(out * np.uint64(GOLD) + bits[:, :, j])
    return out


def thirds(best: np.ndarray) -> np.ndarray:
    """One hash for each of 21 triples of coordinates, none of which has two of a band."""
    bits = best.view(np.uint64)
    out = np.zeros((len(best), COORDINATES // 3), dtype=np.uint64)
    for j in range(3):
        out = mix(out * np.uint64(GOLD) + bits[:, j * out.shape[1] : (j + 1) * out.shape[1]])
    return out


def text_hash(column: str = "text") -> Column:
    return F.xxhash64(F.col(column).cast("string"))


def sign(docs: DataFrame) -> DataFrame:
    """doc_id, th (a hash of the text), node (16 bytes, equal for equal words; null alone), size (shingles) and bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in slices(batches, "text", 1 << 20):
            texts = [t or "" for t in b.column(2).to_pylist()]
            h, n, words, count = shingles(texts)
            best = signatures(*units(h, n), len(texts))
            keys = bands(best).view(np.int64)
            prints = fingerprints(words, count)
            node = [p.tobytes() if c else (hashlib.md5(t.encode("utf-8", "replace")).digest() if t else None) for p, c, t in zip(prints, count.tolist(), texts, strict=True)]
            has = (count > 0).astype(np.int64) * keys.shape[1]
            offsets = np.r_[0, np.cumsum(has)].astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[count > 0].reshape(-1), pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(node, pa.binary()), pa.array(n, pa.int64()), listed], ["doc_id", "th", "node", "size", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("th"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, th long, node binary, size long, bands array<long>")


def elements_of(texts: DataFrame) -> DataFrame:
    """node and its elements (8 bytes each, ascending) of rows with node and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            h, n, _, _ = shingles(b.column(1).to_pylist())
            e, owner = units(h, n)
            parts = np.split(e, np.searchsorted(owner, np.arange(1, b.num_rows)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.unique(x).tobytes() for x in parts], pa.binary())], ["node", "elements"])

    return texts.select("node", "text").mapInArrow(run, "node binary, elements binary")


def similar(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (left, right) of sets at least ``threshold`` alike."""
    size_l, size_r = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    if len(left) * len(right) <= 64:
        both = np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left])
    else:
        _, ids, count = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
        often = np.cumsum(count > 1) - 1  # an element of one set alone adds nothing
        keep, column = (count > 1)[ids], often[ids]
        row = np.repeat(np.arange(len(left) + len(right)), np.r_[size_l, size_r])[keep]
        column = column[keep]
        both = np.zeros((len(left), len(right)), dtype=np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        width = max(64, min(8192, (1 << 22) // (len(left) + len(right))))
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [first, first + width])
            m = np.zeros((len(left) + len(right), width), dtype=np.float32)
            m[row[a:b], column[a:b] - first] = 1
            both += m[: len(left)] @ m[len(left) :].T
    union = size_l[:, None] + size_r[None] - both
    return np.nonzero(both >= threshold * np.maximum(union, 1))


def spanning(pairs: tuple[np.ndarray, np.ndarray], n: int) -> list[tuple[int, int]]:
    """Links (least of its part, other) that connect what the pairs connect."""
    up = np.arange(n)
    a, b = pairs
    while True:  # the least label of neighbours, then of labels
        least = np.minimum(up[a], up[b])
        new = up.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, up[a], least)
        np.minimum.at(new, up[b], least)
        new = new[new]
        if (new == up).all():
            break
        up = new
    return [(int(r), int(i)) for i, r in enumerate(up) if r != i]


def compared(blocks: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) inside each block: rows of band, key, i, j, side (1: left, 2: right, 3: both), node and elements."""

    def links_of(nodes: list[bytes], sides: list[int], raw: list[bytes]) -> list[tuple[bytes, bytes]]:
        # The least node of what is similar is linked with the rest, so it is their label at once.
        order = sorted(range(len(nodes)), key=nodes.__getitem__)
        nodes, sides, raw = ([x[k] for k in order] for x in (nodes, sides, raw))
        sets = [np.frombuffer(x, dtype=np.uint64) for x in raw]
        left, right = [k for k, s in enumerate(sides) if s & 1], [k for k, s in enumerate(sides) if s & 2]
        if not left or not right:
            return []
        x, y = similar([sets[k] for k in left], [sets[k] for k in right], threshold)
        found = spanning((np.array(left)[x], np.array(right)[y]), len(nodes))
        return [(nodes[r], nodes[i]) for r, i in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        at, held = None, ([], [], [])
        out: list[tuple[bytes, bytes]] = []
        for b in batches:
            keys = list(zip(*(b.column(k).to_pylist() for k in range(4)), strict=True))
            sides, nodes, raw = (b.column(k).to_pylist() for k in (4, 5, 6))
            for k, side, node, x in zip(keys, sides, nodes, raw, strict=True):
                if k != at:
                    out += links_of(*held) if at else []
                    at, held = k, ([], [], [])
                held[0].append(node)
                held[1].append(side)
                held[2].append(x)
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], ["a", "b"])
                out = []
        out += links_of(*held) if at else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], ["a", "b"])

    place = ["band", "key", "i", "j"]
    dealt = blocks.select(*place, "side", "node", "elements").repartition(partitions_of(blocks.sparkSession), *place).sortWithinPartitions(*place)
    return dealt.mapInArrow(run, "a binary, b binary")


def alike(pairs: DataFrame, elements: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` (a, b, and others) with ``alike``."""
    kept = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(slices(batches, "ea", 8 << 20), "eb", 8 << 20):
            found = []
            for x, y in zip(b.column(len(kept)).to_pylist(), b.column(len(kept) + 1).to_pylist(), strict=True):
                s, t = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                found.append(both >= threshold * max(1, len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], pa.array(found, pa.bool_())], [*kept, "alike"])

    both = pairs.join(elements.select(F.col("node").alias("a"), F.col("elements").alias("ea")), "a").join(elements.select(F.col("node").alias("b"), F.col("elements").alias("eb")), "b")
    return both.select(*kept, "ea", "eb").mapInArrow(run, StructType([*pairs.schema.fields]).add("alike", BooleanType()))


def thirds_of(elements: DataFrame) -> DataFrame:
    """node and the hashes of its triples of coordinates, of rows with node and elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "elements"):
            sets = [np.frombuffer(x, dtype=np.uint64) for x in b.column(1).to_pylist()]
            best = signatures(np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets]), len(sets))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(thirds(best).view(np.int64).tolist(), pa.list_(pa.int64()))], ["node", "thirds"])

    return elements.select("node", "elements").mapInArrow(run, "node binary, thirds array<long>")


def parted(marked: DataFrame, elements: DataFrame) -> DataFrame:
    """Groups of large buckets' nodes in which those marked ``rest`` are to be compared with all: band, key, n, total, r, node, rest.

    A group is a bucket, or its nodes that agree in a triple of coordinates more,
    whichever of the two makes fewer pairs.
    """
    finer = thirds_of(elements.join(marked.select("node").distinct(), "node", "left_semi"))
    spread = marked.join(finer, "node").select("band", "key", "node", "size", "rest", F.posexplode("thirds").alias("t", "third"))
    spread = materialize(spread.withColumn("sub", F.xxhash64("key", "t", "third")).drop("t", "third"), "parted")
    same = [F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")]
    subs = spread.groupBy("band", "key", "sub").agg(F.count("*").alias("n"), F.sum("size").alias("total"), F.sum("rest").cast("long").alias("r"), *same).where("n > 1 AND r > 0")
    subs = subs.groupBy("band", "key", "n", "total", "r", "x", "y").agg(F.min("sub").alias("sub"))
    pairs = subs.groupBy("band", "key").agg(F.sum(F.col("n").cast("double") * F.col("r")).alias("pairs"))
    whole = marked.select("band", "key", "n", "r").distinct().join(pairs, ["band", "key"], "left")
    cheap = whole.where(F.coalesce("pairs", F.lit(0.0)) < F.col("n").cast("double") * F.col("r")).select("band", "key")
    by_sub = spread.select("band", "key", "sub", "node", "rest").join(subs.select("band", "key", "sub", "n", "total", "r"), ["band", "key", "sub"]).join(cheap, ["band", "key"], "left_semi")
    columns = ["band", "key", "n", "total", "r", "node", "rest"]
    return marked.join(cheap, ["band", "key"], "left_anti").select(*columns).unionByName(by_sub.drop("key").withColumnRenamed("sub", "key").select(*columns))


def direct(members: DataFrame) -> DataFrame:
    """Blocks (band, key, i, j, side, node) in which each bucket's nodes are compared, all with all: its ``parts`` by pairs."""
    c, k = F.col("c"), F.col("k")
    spread = members.withColumn("c", F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts")).cast("int")).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    side = F.when(k > c, 1).when(k < c, 2).otherwise(3)
    return spread.select("band", "key", F.least(c, k).alias("i"), F.greatest(c, k).alias("j"), side.alias("side"), "node")


def links(docs: DataFrame, signed: DataFrame, threshold: float = THRESHOLD, block_nodes: int = BLOCK_NODES, block_elements: int = BLOCK_ELEMENTS) -> DataFrame:
    """Links (a, b) that connect the nodes which share a bucket and are at least ``threshold`` alike, directly or through others."""
    nodes = signed.where(F.size("bands") > 0).groupBy("node").agg(F.min(F.struct("doc_id", "th")).alias("at"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    spread = nodes.select("node", "size", F.posexplode("bands").alias("band", "key"))
    same = [F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")]
    buckets = spread.groupBy("band", "key").agg(F.count("*").alias("n"), F.sum("size").alias("total"), *same).where("n > 1")
    buckets = buckets.groupBy("n", "total", "x", "y").agg(F.min(F.struct("band", "key")).alias("b")).select("b.band", "b.key", "n", "total")
    members = materialize(spread.join(buckets, ["band", "key"]).select("band", "key", "n", "total", "node", "size"), "buckets")
    places = nodes.select("node", "at.doc_id", "at.th").join(members.select("node"), "node", "left_semi")
    # A node has one place, so rows that share theirs are repeated; they meet in the join's shuffle.
    known = [F.coalesce("doc_id", F.lit(0).cast("long")).alias("known"), F.isnull("doc_id").alias("null"), "th"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("th"), F.col("text").cast("string").alias("text")).select(*known, "text")
    at = ["known", "null", "th"]
    texts = rows.join(places.select(*known, "node"), at).dropDuplicates(at).select("node", "text")
    elements = materialize(elements_of(texts), "elements")
    parts = F.greatest(F.ceil(F.col("n") / block_nodes), F.ceil(F.col("total") / block_elements)).cast("int")
    members = members.withColumn("parts", parts)
    found = compared(direct(members.where(F.col("parts") <= DIRECT_BLOCKS)).join(elements, "node"), threshold)
    large = members.where(F.col("parts") > DIRECT_BLOCKS)
    if large.take(1):
        head = large.groupBy("band", "key").agg(F.min(F.struct(F.xxhash64("node", "band").alias("h"), "node", "size")).alias("head"))
        head = head.select("band", "key", F.col("head.node").alias("a"), F.col("head.size").alias("head_size"))
        against = large.join(head, ["band", "key"]).where("node <> a").select("band", "key", "n", "total", "size", "head_size", "a", F.col("node").alias("b"))
        checked = materialize(alike(against, elements, threshold), "checked")
        # Nodes unlike the first are compared with others: left blocks by their own number, right blocks by the group's.
        few = checked.where("not alike").groupBy("band", "key", "n", "total", F.col("a").alias("node"), F.col("head_size").alias("size")).agg(F.count("*").alias("r"))
        others = checked.select("band", "key", "n", "total", F.col("b").alias("node"), "size", F.expr("int(not alike)").alias("rest"))
        columns = ["band", "key", "n", "total", "r", "node", "size", "rest"]
        marked = others.join(few.select("band", "key", "r"), ["band", "key"]).select(*columns).unionByName(few.withColumn("rest", F.lit(0)).select(*columns))
        groups = parted(materialize(marked, "large-buckets"), elements)
        sized = groups.withColumn("parts", parts).withColumn("lefts", F.greatest(F.ceil(F.col("r") * F.col("parts") / F.col("n")), F.lit(1)).cast("int"))
        chunk = lambda k, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(k)).cast("int")
        span = lambda k: F.sequence(F.lit(0), F.col(k) - 1)
        place = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
        left = F.transform(F.slice(span("parts"), F.lit(1), F.col("rest") * F.col("parts")), lambda j: place(chunk("lefts", 1), j, 1))
        right = F.transform(span("lefts"), lambda i: place(i, chunk("parts", 2), 2))
        blocks = sized.select("band", "key", "node", F.explode(F.concat(left, right)).alias("at")).select("band", "key", "at.i", "at.j", "at.side", "node")
        found = found.unionByName(compared(blocks.join(elements, "node"), threshold)).unionByName(checked.where("alike").select("a", "b"))
    return found.where("a <> b")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, block_nodes: int = BLOCK_NODES, block_elements: int = BLOCK_ELEMENTS) -> DataFrame:
    """doc_id, th, class_id (the least doc_id of the class) and class_th, which tell each class's first row."""
    signed = materialize(sign(docs), "signed")
    roots = components(links(docs, signed, threshold, block_nodes, block_elements))
    known = signed.where(F.col("node").isNotNull()).select("doc_id", "th", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = materialize(known.select("doc_id", "th", "root"), "known")
    # As tables, both sides are shuffled for the join alone, so Spark can split a class with many rows.
    first = materialize(known.groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("first")), "first")
    out = known.join(first, "root").select("doc_id", "th", F.col("first.doc_id").alias("class_id"), F.col("first.th").alias("class_th"))
    alone = signed.where(F.col("node").isNull()).select("doc_id", "th", F.col("doc_id").alias("class_id"), F.col("th").alias("class_th"))
    return out.unionByName(alone)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


#: All pairs of texts that share a shingle, and the components of those that are alike.
OP4_SQL = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, w, CASE WHEN len(w) > 0 THEN 'w' || array_to_string(w, ' ') WHEN text <> '' THEN 't' || text ELSE 'd' || doc_id END AS node FROM (SELECT doc_id, text, {SQL_WORDS} AS w FROM documents)
), node AS (
  SELECT node, row_number() OVER (ORDER BY node) AS id, any_value(w) AS w FROM doc GROUP BY node
), run AS (
  SELECT id, unnest(list_transform(range(1, greatest(len(w) - {WORDS} + 2, 2)), lambda i: array_to_string(w[i : i + {WORDS} - 1], ' '))) AS run FROM node WHERE len(w) > 0
), unit AS (
  SELECT id, run, row_number() OVER (PARTITION BY id, run) AS nth FROM run
), size AS (
  SELECT id, count(*) AS n FROM unit GROUP BY id
), pair AS (
  SELECT a.id AS x, b.id AS y, count(*) AS both_have FROM unit a JOIN unit b USING (run, nth) WHERE a.id < b.id GROUP BY a.id, b.id
), link AS (
  SELECT x, y FROM pair JOIN size s ON s.id = x JOIN size t ON t.id = y WHERE both_have >= {THRESHOLD} * (s.n + t.n - both_have)
), edge AS (
  SELECT x, y FROM link UNION SELECT y, x FROM link
), reached AS (
  SELECT id, id AS root FROM node UNION SELECT y, root FROM reached JOIN edge ON x = id
), class AS (
  SELECT id, min(root) AS root FROM reached GROUP BY id
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY root) AS class_id FROM doc JOIN node USING (node) JOIN class USING (id)
"""

import math
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from rivulet.llm import queries, sharding
from rivulet.llm.sharding import Node


def test_op10(spark, data, odd, empty):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = queries.QUERIES["op10_shard_tree"](spark, data).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs.items()}
    assert {r.law for r in rows} == {"key"}
    assert all(r.grown_shard in (r.shard, 8) for r in rows) and any(r.grown_shard == 8 for r in rows)
    check_slots(rows)
    tree = sharding.uniform_tree(2, 2, 2)
    few = sharding.assign_shards(odd, tree, sharding.grown_tree(tree, 8), least_blocks=3).collect()
    check_slots(few)
    assert len(few) == odd.count() and len({r.shard for r in few if r.doc_id == 4}) == 1
    assert sharding.assign_shards(empty, tree, tree).count() == 0


def mixed(seed, data):
    """The engine's 64-bit hash, by another implementation."""
    return xxhash.xxh64_intdigest(data, seed=seed)


def reached(key, node, path=""):
    """The shard of a key in plain Python: the least draw wins at every level."""
    if not node.children:
        return node.shard
    live = [c for c in node.children if c.weight > 0]
    draws = []
    for c in live:
        here = f"{path}/{c.name}"
        if len(live) == 1:
            draws.append(0.0)
            continue
        u = ((mixed(mixed(42, key.encode()), here.encode()) >> 11) + 0.5) / (1 << 53)
        draws.append(-math.log(u) / c.weight)
    won = live[draws.index(min(draws))]
    return reached(key, won, f"{path}/{won.name}")


def test_shards_equal_plain_python(spark, data, odd):
    tree = sharding.uniform_tree(2, 2, 2)
    grown = sharding.grown_tree(tree, 8)
    found = [*queries.QUERIES["op10_shard_tree"](spark, data).collect(), *sharding.assign_shards(odd, tree, grown).collect()]
    for r in found:
        key = "null" if r.doc_id is None else str(r.doc_id)
        assert (r.shard, r.grown_shard) == (reached(key, tree), reached(key, grown))
        assert r.grown_shard in (r.shard, 8)


@pytest.mark.parametrize("part", [7, 1 << 16])
def test_rows_of_one_id_are_numbered_in_blocks(spark, monkeypatch, part):
    monkeypatch.setattr(sharding, "PART", part)
    tree = sharding.uniform_tree(2, 2, 2)
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") % 2 == 0, "equal").otherwise(F.col("id").cast("string")).alias("text"))
    rows = sharding.assign_shards(docs.unionByName(docs.limit(0)), tree, tree, rows_per_block=100).collect()
    assert len(rows) == 4000 and len({r.shard for r in rows}) == 1
    check_slots(rows)
    assert Counter(r.text_crc32 for r in rows)[zlib.crc32(b"equal")] == 2000


def check_slots(rows):
    for shard in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert 0 <= shard < 8 and own == list(range(len(own)))


def test_weights_and_movement(spark):
    """Shares follow the weights, and a changed weight moves rows only into the subtrees that it makes heavier."""
    leaf = lambda i, w: Node(f"s{i}", shard=i, own_weight=w)
    tree = lambda w: Node("root", (Node("r0", (Node("k0", (leaf(0, w), leaf(1, 2.0))), Node("k1", (leaf(2, 1.0),)))), Node("r1", (leaf(3, 4.0),))))
    ids = spark.range(20_000)
    a = [r[0] for r in ids.select(sharding.descend(ids.id.cast("string"), tree(1.0))).collect()]
    b = [r[0] for r in ids.select(sharding.descend(ids.id.cast("string"), tree(3.0))).collect()]
    share = Counter(a)
    for shard, weight in ((0, 1), (1, 2), (2, 1), (3, 4)):
        assert abs(share[shard] / len(a) - weight / 8) < 0.015
    moved = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    # At the node where old and new path part, rows go to the child that weighs more now.
    assert set(moved) == {(1, 0), (2, 0), (2, 1), (3, 0), (3, 1), (3, 2)}
    gone = [r[0] for r in ids.select(sharding.descend(ids.id.cast("string"), tree(0.0))).collect()]
    assert 0 not in gone
    with pytest.raises(ValueError, match="weight"):
        sharding.descend(ids.id.cast("string"), Node("root", (leaf(0, 0.0),)))

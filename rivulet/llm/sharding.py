"""Hierarchical weighted hash tree: rows descend region, rack and shard levels.

At every inner node each child gets a draw ``-ln(u) / weight`` where ``u`` is a
hash of the row's key and the child's path; the smallest draw wins.  A draw
depends on nothing but the key, the child and its weight, so a change of one
weight moves rows only between that child and its siblings, and below other
subtrees nothing moves at all.  A new shard hung below the root as a subtree of
its own therefore takes rows only into itself.

Cases: a null key is a key like any other (all such rows share a shard, as its law
is that the id alone decides); a null text has size 1 and the CRC of no bytes;
repeated rows share a shard and get slots of their own; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, partitions_of, table, text_or_empty


@dataclass(frozen=True)
class Node:
    """``shard`` is set on leaves only; an inner node weighs what its children weigh."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def uniform_tree(regions: int, racks: int, shards: int) -> Node:
    """A tree of equal weights with shards numbered from 0 in tree order."""
    n = iter(range(regions * racks * shards))
    return Node("root", tuple(Node(f"region{r}", tuple(Node(f"rack{k}", tuple(Node(f"s{i}", shard=i) for _, i in zip(range(shards), n))) for k in range(racks))) for r in range(regions)))


def grown_tree(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """``tree`` with one more shard, in a region of its own."""
    return Node(tree.name, (*tree.children, Node(f"region{len(tree.children)}", (Node("rack0", (Node(f"s{shard}", shard=shard, own_weight=weight),)),))))


def draw(key: Column, path: str, weight: float) -> Column:
    """An exponential draw of rate ``weight`` from a hash of key and path."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(float(weight))


def descend(key: Column, node: Node, path: str = "") -> Column:
    """The shard that a key reaches; one draw for each child of the nodes passed."""
    live = [c for c in node.children if c.weight > 0]
    if not node.children:
        return F.lit(node.shard)
    if not live:
        raise ValueError(f"no child of {node.name} has a weight")
    if len(live) == 1:
        return descend(key, live[0], f"{path}/{live[0].name}")
    won = F.array_min(F.array(*[F.struct(draw(key, f"{path}/{c.name}", c.weight).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(live)]))["i"]
    out = descend(key, live[-1], f"{path}/{live[-1].name}")
    for i, c in list(enumerate(live))[-2::-1]:
        out = F.when(won == i, descend(key, c, f"{path}/{c.name}")).otherwise(out)
    return out


#: Equal rows are numbered in parts of so many, which a shuffle deals out.
PART = 1 << 16


def assign_shards(docs: DataFrame, tree: Node, grown: Node, rows_per_block: int = 65536, least_blocks: int = 64) -> DataFrame:
    """One row per document: size, CRC, shard, gapless slot, and the shard in the grown tree.

    Equal rows (in doc_id, size and CRC) are counted first, so a row that is there
    many times is one.  Rows of a shard are dealt to blocks by a hash of all three
    columns, so rows of one id (or of none) with other texts part, and numbered
    inside their block, behind the rows of the blocks before.  No task sees a whole
    shard; what is numbered is a table of these columns alone.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = text_or_empty()
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    groups = materialize(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n")), "rows-by-shard")
    blocks = max(least_blocks, -(-groups.count() // rows_per_block))
    block = F.pmod(F.xxhash64(key, "size", "text_crc32", F.lit("block")), F.lit(blocks)).cast("int")
    placed = groups.withColumns({"shard": descend(key, tree).cast("int"), "block": block})
    counts = placed.groupBy("shard", "block").agg(F.sum("n").alias("total"))
    ahead = lambda over: over.rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "block", F.coalesce(F.sum("total").over(ahead(Window.partitionBy("shard").orderBy("block"))), F.lit(0)).alias("offset"))
    before = F.coalesce(F.sum("n").over(ahead(Window.partitionBy("shard", "block").orderBy("doc_id", "size", "text_crc32"))), F.lit(0))
    first = placed.withColumn("before", before).join(offsets, ["shard", "block"]).withColumn("first", F.col("offset") + F.col("before"))
    own = ["doc_id", "size", "text_crc32", "shard"]
    many = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(PART).cast("long")))
    parts = first.where("n > 1").select(*own, "first", "n", many.alias("start")).repartition(partitions_of(docs.sparkSession), "first", "start")
    nth = F.explode(F.sequence("start", F.least(F.col("start") + PART, F.col("n")) - 1)).alias("nth")
    again = parts.select(*own, "first", nth).select(*own, (F.col("first") + F.col("nth")).alias("slot"))
    out = first.where("n = 1").select(*own, F.col("first").alias("slot")).unionByName(again)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), descend(key, grown).cast("int").alias("grown_shard"))


def op10_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = uniform_tree(2, 2, 2)
    return assign_shards(table(spark, sf_dir, "documents"), tree, grown_tree(tree, 8))

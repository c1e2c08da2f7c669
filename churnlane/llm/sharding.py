"""Sharding over a hierarchical weighted hash tree.

A row descends from the root: at each level every child draws an exponential
value of its weight from a hash of the row and the child's name, and the least
draw wins, so a child gets rows in proportion to its weight.  A child whose
weight is unchanged keeps its draw; when a weight grows, rows move only into
that child's subtree, when it shrinks, only out of it.

A new shard joins as a region of its own, so all rows that move go to it.
DataFrame functions only; rows are never gathered by shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnlane.session import cut_lineage


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; ``weight`` of an inner node is its children's sum."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int = -1
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(shards: int, racks: int = 4, per_rack: int = 5) -> Node:
    """Regions of ``racks`` racks of ``per_rack`` shards; shards left over are regions of their own."""
    size, regions = racks * per_rack, []
    for r in range(shards // size):
        regions.append(Node(f"region{r}", tuple(
            Node(f"region{r}/rack{k}", tuple(
                Node(f"region{r}/rack{k}/shard{s}", shard=s)
                for s in range(r * size + k * per_rack, r * size + (k + 1) * per_rack)))
            for k in range(racks))))
    return grown(Node("root", tuple(regions)), range(shards // size * size, shards))


def grown(root: Node, new_shards) -> Node:
    """``root`` with each new shard as a region (rack, shard) of its own."""
    more = tuple(Node(f"region-s{s}", (Node(f"region-s{s}/rack", (Node(f"region-s{s}/rack/shard", shard=s),)),))
                 for s in new_shards)
    return Node(root.name, root.children + more)


def _flat(root: Node) -> list[Node]:
    """All nodes, each level after the one above; the root is number 0."""
    nodes = [root]
    for n in nodes:  # grows while it is read: breadth first
        nodes.extend(n.children)
    return nodes


def _draw(key: Column, name: Column, weight: Column) -> Column:
    """-ln(U) / weight, U from a 53-bit hash of the row's key and the node's name."""
    bits = F.shiftrightunsigned(F.xxhash64(key, name), 11)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / weight


def with_shard(rows: DataFrame, root: Node, key: str, out: str) -> DataFrame:
    """``rows`` with the shard that the row of ``key`` reaches, one column step per level."""
    nodes = _flat(root)
    number = {id(n): i for i, n in enumerate(nodes)}
    none = F.array().cast("array<struct<name:string,weight:double,node:int>>")
    kids = F.array(*[F.array(*[F.struct(F.lit(c.name).alias("name"), F.lit(float(c.weight)).alias("weight"),
                                        F.lit(number[id(c)]).alias("node")) for c in n.children])
                     if n.children else none for n in nodes])
    depth = 0
    level = [root]
    while any(n.children for n in level):
        depth, level = depth + 1, [c for n in level for c in n.children]
    rows = rows.withColumn("_cl_node", F.lit(0))
    for _ in range(depth):
        below = F.get(kids, F.col("_cl_node"))
        best = F.array_min(F.transform(below, lambda c: F.struct(
            _draw(F.col(key), c["name"], c["weight"]).alias("draw"), c["node"].alias("node"))))["node"]
        rows = rows.withColumn("_cl_node", F.coalesce(best, F.col("_cl_node")))
    shards = F.array(*[F.lit(n.shard) for n in nodes])
    return rows.withColumn(out, F.get(shards, F.col("_cl_node"))).drop("_cl_node")


def shard_rows(docs: DataFrame, root: Node, id_col: str = "doc_id", text_col: str = "text",
               later: Node | None = None, subs: int | None = None) -> DataFrame:
    """(id, size, text_crc32, shard, slot, grown_shard) for every row of ``docs``.

    The shard follows from the id and the tree alone (a null id counts as an
    empty one).  ``size`` is the text's UTF-8 bytes plus 16, ``text_crc32`` of
    the same bytes; a null text has none.  ``slot`` numbers a shard's rows
    from 0 without gaps: each shard is cut into sub-shards by a hash of the
    row, sub-shards are counted, and only the rows of one are numbered in one
    window.  ``grown_shard`` is the place under the tree ``later``, else null.
    Equal rows are interchangeable between their slots.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"),
        (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = with_shard(rows, root, "key", "shard")
    rows = rows.withColumn("grown_shard", F.lit(None).cast("int")) if later is None \
        else with_shard(rows, later, "key", "grown_shard")
    rows = rows.drop("key")
    rows = cut_lineage(rows)  # counted and numbered alike, and the texts are read once
    if subs is None:
        leaves = max(1, int(root.weight))
        subs = max(1, rows.count() // (leaves * 20_000) + 1)
    # rows of one id are spread too
    rows = rows.withColumn("sub", F.pmod(F.xxhash64("id", "size", "text_crc32"), F.lit(subs)).cast("int"))
    counts = rows.groupBy("shard", "sub").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "sub", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("shard", "sub").orderBy("id", "text_crc32", "size")) - 1
    return (rows.join(starts, ["shard", "sub"])
            .select(F.col("id").alias(id_col), "size", "text_crc32", "shard",
                    (F.col("start") + place).cast("long").alias("slot"), "grown_shard"))

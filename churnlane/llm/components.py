"""Connected components of a link table, as Spark jobs (large-star / small-star)."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlane.session import cut_lineage

_EDGE = "u long, v long"
#: Links that one task joins at a time, about, before the rounds begin.
LOCAL = 100_000


def _forest(batches):
    """The links of one task as stars around each local component's least node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for i in range(0, len(nodes), 50_000):
        part = nodes[i: i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()),
                                          pa.array([root(x) for x in part], pa.int64())], ["u", "v"])


def _large_star(e: DataFrame) -> DataFrame:
    """Each edge leads from u to the least neighbour of v, or to v itself; one row per edge."""
    least = e.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
    return e.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """Of the edges down from u the least stays, the other ends are led to its end; at most one row per edge."""
    least = e.withColumn("m", F.min("v").over(Window.partitionBy("u")))
    return least.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                        F.col("m").alias("v")).distinct()


def _settled(e: DataFrame) -> bool:
    """Every node has one edge down to a node that has none: each component is a star around its least node."""
    down = e.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    if down.where("n > 1").limit(1).count():
        return False
    return not e.join(down.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label): the least node reachable by ``links`` (two long columns).

    Nodes without links are not listed.  Null ends and self-links are ignored;
    no links give an empty table.  The links are thinned to forests, first in
    the tasks that hold them, then in tasks of about ``LOCAL`` edges; every
    edge has u > v from then on.  Each round is checkpointed; the rounds end when
    every component is a star (their number grows with the logarithm of the
    widest component, ``rounds`` only guards against a bug).
    """
    a, b = links.columns[:2]
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = cut_lineage(edges.mapInArrow(_forest, _EDGE).distinct())
    for step in range(rounds):
        if _settled(edges):
            break
        if step == 0:
            tasks = math.ceil(edges.count() / LOCAL)
            edges = cut_lineage(edges.coalesce(tasks).mapInArrow(_forest, _EDGE).distinct())
        else:
            edges = cut_lineage(_small_star(_large_star(edges)))
    else:
        raise RuntimeError("components did not settle")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()))

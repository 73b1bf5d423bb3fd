"""Connected components of an edge table by alternating large and small stars.

Each round replaces a node's edges with edges to the smallest neighbour; the
rounds end when the edges no longer change, after O(log n) rounds in practice.
Every round is written under the shared checkpoint folder (lineage cut) and
the round before is deleted.  A node with very many neighbours (a hub) is only
met as a join key, where AQE splits its rows, or in a minimum, which is
aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count(F.lit(1)),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
    ).first())


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a"), F.least("a", "m").alias("m"))
    return (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct())


def _small(edges: DataFrame) -> DataFrame:
    # every edge points from the larger node to the smaller one here
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node that has an edge, with its component's smallest node.

    Null ends, self loops, repeated and mirrored edges are ignored; no edges
    give an empty result.
    """
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"),
                     (F.col(a).isNull() | F.col(b).isNull()).alias("x"))
    cur = common.written(e.filter("not x and a > b").select("a", "b").distinct(), "edges")
    state = _state(cur)
    while state[0]:
        nxt = common.written(_small(_large(cur)), "edges")
        new = _state(nxt)
        common.discard(cur)
        cur = nxt
        if new == state:
            break
        state = new
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

# Rounds double what a round can reach; this many reach any graph that fits storage.
MOST_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node its component holds, for every linked node.

    Takes ``a`` and ``b``, of any one type that can be ordered. Alternates two steps that keep components as they
    are: each node's larger neighbours link to its smallest one, then its smaller
    neighbours do. The links end as stars around the roots. A node with very many links
    costs a map-side minimum and a join whose large partitions Spark splits; no task
    holds a node's links together. Every round is written down.
    """
    links = written(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    for _ in range(MOST_ROUNDS):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_smallest(both).filter("a > node").select(F.col("a"), F.col("least").alias("b"))
        large = large.filter("a <> b").distinct()
        small = _to_smallest(large.select(F.col("a"), F.col("b")), smaller=True)
        links = written(small, "links")
        state = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
    raise RuntimeError(f"links did not settle in {MOST_ROUNDS} rounds")


def _to_smallest(links: DataFrame, smaller: bool = False) -> DataFrame:
    """Each node's links turned to its smallest neighbour.

    Plain: rows ``node, a, least`` for links node to a. ``smaller``: links ``a, b`` with
    b below a; gives every b, and a itself, linked to a's smallest b.
    """
    lowest = links.groupBy("a").agg(F.min("b").alias("low"))
    if smaller:
        lowest = lowest.select(F.col("a").alias("node"), F.col("low"))
        joined = links.join(lowest, links["a"] == F.col("node"))
        moved = joined.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        own = lowest.select(F.col("node").alias("a"), F.col("low").alias("b"))
        return moved.unionByName(own).distinct()
    lowest = lowest.select(F.col("a").alias("node"), F.least("a", "low").alias("least"))
    turned = links.select(F.col("a").alias("from"), F.col("b").alias("a"))
    return turned.join(lowest, F.col("from") == F.col("node")).select("node", "a", "least")

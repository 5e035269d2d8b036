"""Connected components by alternating large-star and small-star steps on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import BROADCAST_ROWS, key_side
from tidemark.session import staged


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (long columns ``a``, ``b``).

    The root is the smallest node reachable.  Each round reduces every neighbourhood to its
    minimum before the shuffle and joins it back, so a node with very many neighbours is never
    one group; the tables of a round are written to the shared folder, which cuts the lineage.
    Rounds end when a round leaves the edges as they were.
    """
    links = staged(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        mark = links.agg(
            F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a, 1))")
        ).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        few = mark[0] <= BROADCAST_ROWS
        links = staged(_small_star(_large_star(links, few), few), "edges")
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        roots.select("node", F.col("node").alias("root"))
    )


def _large_star(links: DataFrame, few: bool) -> DataFrame:
    """Larger neighbours are linked to the smallest node of the neighbourhood."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.where("b > a").join(key_side(least, few), "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame, few: bool) -> DataFrame:
    """Smaller neighbours, and the node itself, are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(key_side(least, few), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()

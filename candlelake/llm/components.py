"""Connected components of a table of links, by alternating stars.

Each round turns every node's links towards the smallest neighbour: first those to larger nodes
(large star), then those to smaller ones (small star). Hot nodes do not gather in a task: the smallest
neighbour is a hash aggregate with map-side combining, and the links are joined with it. Rounds end
when the links no longer change, after a number that grows with the logarithm of the longest chain.
Every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import staged


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links of each node's larger (or smaller) neighbours to its smallest neighbour, itself included."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b`` (longs) that is not its component's smallest node itself."""
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    links = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "links")
    before = state(links)
    while before[0]:
        links = staged(_star(_star(links, large=True), large=False), "links")
        if (after := state(links)) == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))

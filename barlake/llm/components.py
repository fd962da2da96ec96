"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.scratch import stored


def _star(links: DataFrame, small: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to the least node among its own."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    back = links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    near = back if small else both.unionByName(back)  # a < b: only ``back`` has smaller neighbours
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = near.join(least, "u")
    if small:
        moved = joined.select(F.col("m").alias("a"), F.col("v").alias("b"))
        return moved.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).where("a != b").distinct()
    return joined.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node reachable, for every node of ``links`` (a, b).

    Links are taken both ways; repeated links, self-links and links with nulls do no harm. Each round
    is written to the shared folder; the number of rounds grows with the logarithm of the longest
    chain. A node with many neighbours is never gathered in one place.
    """
    ordered = links.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
    now = stored(ordered.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        before = mark
        now = stored(_star(_star(now, small=False), small=True), "links")

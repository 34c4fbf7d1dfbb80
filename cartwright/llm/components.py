"""Connected components of a link table by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import staged


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Reconnect neighbours to the least node around, in one of the two directions."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not larger:
        both = both.filter("v < u")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    moved = both.join(least, "u")
    if larger:
        moved = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v); component: its least node.

    Each round is written to the shared folder, so lineage stays short. The
    rounds end when every node hangs on its least node: then no node is both a
    child and a parent, and no child has two parents.
    """
    stars = links.filter("u <> v").distinct()
    while True:
        stars = staged(_star(_star(stars, True), False), "stars")
        per_child = stars.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        unsettled = per_child.filter("n > 1").select("u").union(
            stars.join(stars.select(F.col("v").alias("p")).distinct(),
                       F.col("u") == F.col("p"), "left_semi").select("u"))
        if unsettled.isEmpty():
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))

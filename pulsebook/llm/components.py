"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on the node; links stay in tables throughout. Both steps keep the
components and pull nodes towards the least node; the number of rounds grows with the logarithm of the longest
path, not with its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulsebook.llm.common import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours linked to the least of them and itself."""
    if large:
        near = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        moved = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (least node of its component) for every node of ``links`` (u, v) but the roots."""
    links = stage(links.where("u <> v").select("u", "v").distinct(), "links")
    before = None
    while True:
        links = stage(_star(_star(links, True), False), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now

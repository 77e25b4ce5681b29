"""Connected components of a graph whose links are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmaq.llm.common import stored


def connected_components(links: DataFrame, label: str) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; the component is its smallest node.

    Each round links all larger neighbours of a node to the smallest one it knows, then the
    smaller ones likewise, so a path halves and a hub costs one row a neighbour. A round ends in a table; when it changes nothing, the links are stars.
    """
    links = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(lowest, "a").select(
            F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        stars = small.where("a <> b").unionByName(
            lowest.select("a", F.col("low").alias("b"))).distinct()
        links = stored(stars, label)
        state = links.agg(F.count("*"), F.coalesce(
            F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if state == before:
            break
        before = state
    members = links.groupBy("a").agg(F.min("b").alias("component"))
    return members.select(F.col("a").alias("node"), "component").unionByName(
        members.select(F.col("component").alias("node"), "component").distinct())

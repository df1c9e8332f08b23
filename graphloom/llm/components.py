"""Connected components of links by alternating large and small stars; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.shared import written


def _hook(links: DataFrame, large: bool) -> DataFrame:
    """One star round on links (a, b) with a > b: neighbours of a node move to the least of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("low"))
    moved = both.join(least, F.col("a") == F.col("node"))
    if large:
        out = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.select(F.col("node").alias("a"), F.col("low").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its smallest node. Lone links to oneself drop out."""
    now = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        # Done when each node has one link, down to a node that has none: the links are then a forest of stars.
        stars = now.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n"))
        open_ends = stars.where("n > 1").limit(1).count() or now.join(stars, F.col("b") == F.col("node"), "left_semi").limit(1).count()
        if not open_ends:
            break
        now = written(_hook(_hook(now, large=True), large=False))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

"""Connected components of links by alternating star contractions, in a number of rounds that grows with the logarithm of the nodes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.sources.shared import written


def _large_star(e: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the least of its neighbours and itself."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the least of these."""
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    moved = down.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame, materialize: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """(node, root) of every node that links (x, y) join to a smaller one; ``root`` is the least node of its component.

    Sums on the map side bring each node's least neighbour, and the joins by node can be split where one has very many
    links. ``materialize`` cuts the lineage once a round; a round's edges are compared by their number and a hash of all.
    """
    mark = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    e = links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u <> v").distinct()
    before = None
    while True:
        e = materialize(_small_star(_large_star(e)))
        now = tuple(mark(e))
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now

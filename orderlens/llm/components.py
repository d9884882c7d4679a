"""Connected components of a link table, by alternating star contractions.

Every round replaces links by links to the smallest neighbour, first from the larger ends (large
star), then from the smaller ones (small star), until nothing changes; then each node hangs on the
smallest node of its component. Smallest neighbours are aggregates, so no node's links are ever
gathered, and the join that brings them back can be split at a hot node. Each round is written to
the shared folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.session import pin


def _smallest(links: DataFrame, node: str, other: str) -> DataFrame:
    return links.groupBy(F.col(node).alias("node")).agg(F.min(other).alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = _smallest(both, "u", "v").withColumn("least", F.least("node", "least"))
    larger = both.filter("v > u")
    return larger.join(least, larger["u"] == least["node"]).select(
        F.col("v").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` with a > b: each node's smaller neighbours, and itself, go to the smallest of them."""
    least = _smallest(links, "a", "b")
    moved = links.join(least, links["a"] == least["node"]).filter("b > least").select(
        F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionAll(least.select(F.col("node").alias("a"), F.col("least").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` for every node with a link; links are two non-null columns a, b."""
    current = pin(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links")
    sign = None
    while True:
        current = pin(_small_star(_large_star(current)).distinct(), "links")
        # Equal counts and sums of hashes over all links mean that the round changed nothing.
        now = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == sign:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        sign = now

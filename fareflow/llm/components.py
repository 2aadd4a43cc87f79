"""Connected components by alternating star contraction, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import stored


def connected(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of the links ``a``, ``b``; the root is the smallest node.

    Large and small star steps take turns until a round changes nothing. A node's
    neighbours never meet in one task: the smallest comes from a combining aggregation and
    returns to the links by a join, whose skewed keys Spark splits. No links, no rows.
    """
    links = edges.where("a <> b")
    links = stored(_distinct(F.least("a", "b"), F.greatest("a", "b"), links), "links")
    before = None
    while (now := _digest(links)) != before:
        before = now
        links = stored(_small_star(_large_star(links)), "links")
    roots = links.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return roots.union(links.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())


def _distinct(low, high, links: DataFrame) -> DataFrame:
    return links.select(low.alias("low"), high.alias("high")).distinct()


def _digest(links: DataFrame) -> tuple:
    sums = F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), sums).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest of them and itself."""
    both = links.select(F.col("low").alias("u"), F.col("high").alias("v")).union(
        links.select(F.col("high").alias("u"), F.col("low").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _distinct(F.col("m"), F.col("v"), both.where("v > u").join(least, "u"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours and itself to the smallest of them."""
    least = links.groupBy("high").agg(F.min("low").alias("m"))
    handed = links.join(least, "high").where("low > m")
    return _distinct(F.col("m"), F.col("low"), handed).union(
        least.select(F.col("m").alias("low"), "high")
    ).distinct()

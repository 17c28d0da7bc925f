"""Connected components of a graph given by its edges, as rounds of joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``, of one type that can be
    ordered); the component is its smallest node.

    Large-star and small-star rounds: each node hands its larger neighbours, then its smaller
    ones, to the smallest node it knows. The number of rounds grows with the logarithm of the
    longest path. Nothing but the number of changed edges reaches the driver. A node with very
    many neighbours is a hot key of one aggregation, which is made before the shuffle, and of
    one join, which Spark splits as the aggregate is written first.
    """
    spark = edges.sparkSession
    ordered = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    with scratch(spark) as keep:
        links = keep(ordered.distinct(), "links")
        while True:
            large = keep(_large_star(links, keep), "links")
            links = keep(_small_star(large, keep), "links")
            # Done when every node hangs on one root that hangs on none.
            roots = links.select(F.col("b").alias("a")).distinct()
            twice = links.groupBy("a").count().where("count > 1").limit(1).count()
            if not twice and not links.join(roots, "a", "left_semi").limit(1).count():
                break
        heads = roots.select(F.col("a").alias("node"), F.col("a").alias("component"))
        return staged(links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(heads), "components")


def _large_star(links: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The neighbours above a node go to the smallest node it knows."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    least = keep(least, "least")
    large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return large.where(F.col("a") != F.col("b")).distinct()


def _small_star(links: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    least = keep(links.groupBy("a").agg(F.min("b").alias("least")), "least")
    small = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    small = small.unionByName(least.select("a", F.col("least").alias("b")))
    return small.where(F.col("a") != F.col("b")).distinct()

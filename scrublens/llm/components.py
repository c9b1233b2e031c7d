"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrublens.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``edges``, a
    table with columns ``a`` and ``b``.

    Large-star and small-star rounds: each node hands its larger, then its smaller
    neighbours to the smallest node it knows, until every component is a star. A round is
    two aggregates that combine before their shuffle and two joins; it is written, and the
    driver sees a count and a checksum of it. The rounds needed grow with the logarithm of
    the size of the components.
    """
    stars = written(_ordered(edges))
    before = None
    while True:
        stars = written(_small_star(_large_star(stars)))
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    leaves = stars.groupBy("b").agg(F.min("a").alias("a")).select(F.col("b").alias("node"), F.col("a").alias("component"))
    centres = stars.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return leaves.unionByName(centres)


def _ordered(edges: DataFrame) -> DataFrame:
    smaller, larger = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return edges.filter("a != b").select(smaller, larger).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours, linked to its smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    linked = both.filter("b > a").join(least, "a").select(F.col("least").alias("a"), "b")
    return _ordered(linked)


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours, linked to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    joined = edges.join(least, "b")
    own = least.select(F.col("least").alias("a"), "b")
    others = joined.select(F.col("least").alias("a"), F.col("a").alias("b"))
    return _ordered(own.unionByName(others))

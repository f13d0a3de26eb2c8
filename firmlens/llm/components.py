"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.storage import stored


def _least(links: DataFrame) -> DataFrame:
    """The smallest neighbour of each ``a``. Written, so that a join with it deals both sides
    anew and a hub's links are split."""
    return stored(links.groupBy("a").agg(F.min("b").alias("least")), "least")


def _stars(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest one, then all smaller ones do.
    In every link ``a`` is the larger node."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = both.filter("b > a").join(_least(both), "a").select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
    large = stored(large.distinct(), "large")
    least = _least(large)
    small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b")
    return small.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component's name is its
    smallest node. Self-links, repeated and reversed links are allowed, nulls are not.

    Alternating stars: rounds grow with the logarithm of the number of nodes. A hub's
    neighbours are reduced to their minimum before the shuffle and joined to it in parts.
    """
    now = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links"
    )
    sign = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))]
    before = now.agg(*sign).first()
    while before[0]:
        now = stored(_stars(now), "links")
        after = now.agg(*sign).first()
        if after == before:
            break
        before = after
    own = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)

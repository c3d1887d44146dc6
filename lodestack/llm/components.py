"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, remove


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, component): for every node of an edge (src, dst), the smallest node that edges lead to.

    Each round points every node's larger neighbours, then its smaller ones, to the smallest of its neighbourhood;
    the number of edges never grows and few rounds suffice, of the order of the square of the logarithm of the
    longest path at most. Only sums reach the driver. Nodes must not be null; loops and repeats do no harm.
    """
    stars = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).filter("src <> dst").distinct()
    stars = cut(stars, "edges")
    before = _state(stars)
    for _ in range(most_rounds):
        if not before[0]:
            break
        both = stars.unionByName(stars.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = cut(both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m")), "least")
        large = both.filter("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct()
        large = cut(large, "large")
        least_small = cut(large.groupBy("src").agg(F.min("dst").alias("m")), "least")
        small = large.join(least_small, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).unionByName(least_small.select("src", F.col("m").alias("dst")))
        new = cut(small.filter("src <> dst").distinct(), "edges")
        after = _state(new)
        for old in (stars, least, large, least_small):
            remove(old)
        stars = new
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = stars.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return stars.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)


def _state(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())

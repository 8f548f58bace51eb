"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.sources.shared import publish


def _signature(edges: DataFrame) -> tuple:
    sums = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))
    ).first()
    return tuple(sums)


def components(links: DataFrame) -> DataFrame:
    """``v``, ``m``: every linked id but the smallest of its component, and that smallest id.

    ``links`` has two long columns ``a``, ``b``; a link with a null end or to itself is ignored.
    Large-star and small-star steps alternate until the edges are stars around the smallest
    ids, which takes a number of rounds logarithmic in the size of a component. Each round is a
    written table. A hub is joined, not grouped, so adaptive execution can split it.
    """
    whole = links.where("a is not null and b is not null")
    edges = whole.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m"))
    edges = publish(edges.where("v <> m").distinct(), "links")
    before = _signature(edges)
    while before[0]:
        both = edges.union(edges.select("m", "v")).toDF("u", "n")
        low = both.groupBy("u").agg(F.least(F.min("n"), F.col("u")).alias("low"))
        large = both.join(low, "u").where("n > u").select(F.col("n").alias("v"), F.col("low").alias("m"))
        lowest = large.groupBy("v").agg(F.min("m").alias("low"))
        small = large.join(lowest, "v").select(F.col("m").alias("v"), F.col("low").alias("m"))
        edges = publish(small.where("v <> m").union(lowest).distinct(), "stars")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges

"""Connected components of a link table, by DataFrame rounds whose lineage is cut in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm import scratch


def components(links: DataFrame) -> DataFrame:
    """``links``: columns ``a``, ``b`` (of one orderable type). Returns ``node, component`` for every node
    that has a link to another; ``component`` is the smallest node of its component.

    Alternates the large-star and small-star steps (Kiveris et al., 2014): links to larger neighbours
    move to the smallest neighbour, then links to smaller ones do, until nothing changes. A node's links
    are never brought together: minima are combined before the shuffle, and the joins' sides are written
    tables, so a hot node's rows can be split.
    """
    pairs = scratch.keep(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    state = None
    while True:
        both = pairs.union(pairs.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
        least = scratch.keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = scratch.keep(both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        below = scratch.keep(large.groupBy("hi").agg(F.min("lo").alias("m")))
        joined = large.join(below, "hi")
        small = scratch.keep(below.select("hi", F.col("m").alias("lo")).union(joined.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))).distinct())
        for old in (pairs, least, large, below):
            scratch.drop(old)
        pairs = small
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state:  # the same links twice: every node links to its component's smallest
            smallest = pairs.select("lo", "lo").distinct().toDF("hi", "lo")
            return pairs.union(smallest).select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        state = now

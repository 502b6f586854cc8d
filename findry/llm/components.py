"""Connected components of a link table, all in Spark.

Large-star and small-star steps alternate (Kiveris and others, "Connected components in
MapReduce and beyond", 2014) until every node hangs on the least node it can reach.  The rounds
grow with the logarithm of the size of a component.  Neither links nor components reach the
driver; a node with very many links is only ever met by a partial aggregate or by a join that
Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findry.llm.scratch import Scratch


def _shape(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; component is its least node.

    Loops, repeats and either direction are allowed; nodes without a link are not returned.
    """
    links = scratch.keep(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "links")
    before = _shape(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.keep(
            both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
        # Large star: neighbours above a node go to the least node around it.
        large = (links.join(least, links.b == least.a)
                 .select(links.a, F.col("least").alias("b"))
                 .where("a <> b").distinct())
        large = scratch.keep(large, "large")
        # Small star: a node and its neighbours below go to the least of them.
        least = scratch.keep(large.groupBy("a").agg(F.min("b").alias("least")), "least")
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
        links = scratch.keep(
            small.unionByName(least.select("a", F.col("least").alias("b"))).distinct(), "links")
        now = _shape(links)
        if now == before:
            break
        before = now
    scratch.drop("least", "large")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)

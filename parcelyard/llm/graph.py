"""Connected components of links, as joins and aggregates that never gather a component in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b): the smallest node that links reach.

    Alternating large and small stars: each pass hangs neighbours below the smallest node they see, until each
    component is one star. Minima combine on the map side; the joins on a hot node are plain equi-joins,
    which adaptive execution splits. Each pass is stored, so lineage stays short. Self links and nulls add nothing.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    links, before = stage(links, "links"), None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = stage(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)

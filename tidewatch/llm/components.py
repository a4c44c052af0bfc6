"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import settle


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of the nodes in links ``a, b``; the component is its smallest node.

    Every node points to the smallest node it knows. A round tells a node's
    pointer to all its neighbours and to the node it pointed to, and then halves
    the pointers' paths. All steps are aggregations and joins by node, which
    adaptive execution splits where a node has many links.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    edges = settle(both)
    label = settle(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("c")).withColumnRenamed("a", "id"))
    seen = None
    while True:
        told = edges.join(label.withColumnRenamed("id", "b"), "b").select(F.col("a").alias("id"), "c")
        hooked = told.join(label.withColumnRenamed("c", "old"), "id").select(F.col("old").alias("id"), "c")
        every = label.unionByName(told).unionByName(hooked)
        least = every.groupBy("id").agg(F.min("c").alias("c"))
        up = least.select(F.col("id").alias("c"), F.col("c").alias("d"))
        jumped = least.join(up, "c", "left").select("id", F.least("c", F.coalesce("d", "c")).alias("c"))
        label = settle(jumped)
        mark = label.agg(F.sum(F.col("c").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("id", "c"))).first()
        if mark == seen:
            return label.withColumnRenamed("c", "component")
        seen = mark

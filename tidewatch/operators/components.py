"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import settle


def _contract(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of every node on its smallest one.

    ``edges`` has ``a > b``. The large step moves the greater neighbours, the
    small step the lesser ones.
    """
    ways = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        ways = ways.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = ways.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    # both sides lie by node already; adaptive execution sends a small one or splits a hot node
    moved = ways.join(least, "u")
    if large:
        moved = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            moved.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge; the component is its smallest node."""
    stars = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    seen = None
    while True:
        stars = settle(_contract(_contract(stars, True), False))
        mark = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
        if mark == seen:
            break
        seen = mark
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()

"""DBSCAN without all pairs.

Equal rows become one weighted site. Sites fall into cells whose diagonal is at
most eps, so a cell with enough rows is core as a whole and the core sites of a
cell are connected without looking at pairs. What is left is decided between
bounding boxes; points are compared only where boxes leave it open:

* neighbour counts of the sites of thin cells,
* links between cells of different components, after two overlapping grids have
  already joined what shares a cell in either. Open box pairs are cut finer
  until each is within eps or beyond it.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.layout import SALTS, attach, number_rows
from tidewatch.operators.components import components
from tidewatch.session import settle

COARSE_DIMS = 3
FINER = 4


def _square(gap: Column) -> Column:
    return gap * gap


class _Space:
    """Geometry of one call: columns, cell side and distances."""

    def __init__(self, scope: Sequence[str], features: Sequence[str], eps: float):
        self.scope, self.features, self.eps = list(scope), list(features), eps
        # a hair smaller, so that rounding never puts two sites of a cell further apart than eps
        self.side = eps / math.sqrt(len(features)) * (1 - 1e-9)
        self.span = math.ceil(math.sqrt(len(features))) + 2
        self.low = [f"_lo{i}" for i in range(len(features))]
        self.high = [f"_hi{i}" for i in range(len(features))]

    def cell(self, finer: int = 1, shift: float = 0.0) -> Column:
        return F.array(*[F.floor(F.col(f) / F.lit(self.side / finer) + F.lit(shift)) for f in self.features])

    def boxes(self, sites: DataFrame, by: Sequence[str], *extra: Column) -> DataFrame:
        lows = [F.min(f).alias(n) for f, n in zip(self.features, self.low)]
        highs = [F.max(f).alias(n) for f, n in zip(self.features, self.high)]
        return sites.groupBy(*by).agg(*lows, *highs, *extra)

    def coarse(self, near: bool) -> Column:
        """Coarse key of a cell, or the keys of the cells it can reach."""
        key = [F.floor(F.get("cell", F.lit(i)) / F.lit(self.span)) for i in range(min(len(self.features), COARSE_DIMS))]
        if not near:
            return F.array(*key)
        moves = itertools.product((-1, 0, 1), repeat=len(key))
        return F.explode(F.array(*[F.array(*[k + m for k, m in zip(key, move)]) for move in moves]))

    def bounds(self, a: Sequence[tuple[str, str]], b: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
        """Least and greatest squared distance of two boxes, given as (low, high) columns."""
        least, most = F.lit(0.0), F.lit(0.0)
        for (al, ah), (bl, bh) in zip(a, b):
            gap = F.greatest(F.col(al) - F.col(bh), F.col(bl) - F.col(ah), F.lit(0.0))
            reach = F.greatest(F.col(ah) - F.col(bl), F.col(bh) - F.col(al))
            least, most = least + _square(gap), most + _square(reach)
        return least, most


def _reach(space: _Space, points: DataFrame, targets: DataFrame, merge) -> DataFrame:
    """Merge the ``val`` of all target sites within eps of each point ``sid``."""
    scope, features, limit = space.scope, space.features, F.lit(space.eps * space.eps)
    mine = [f"_p{i}" for i in range(len(features))]
    near = points.select(
        *scope, "sid", *[F.col(f).alias(p) for f, p in zip(features, mine)], space.coarse(True).alias("key")
    )
    boxes = space.boxes(targets, [*scope, "cell"], merge("val").alias("val")).withColumn("key", space.coarse(False))
    least, most = space.bounds(list(zip(mine, mine)), list(zip(space.low, space.high)))
    pairs = near.join(boxes, [*scope, "key"]).withColumns({"_least": least, "_most": most}).filter(F.col("_least") <= limit)
    sure = pairs.filter(F.col("_most") <= limit).select(*scope, "sid", "val")
    open_ = pairs.filter(F.col("_most") > limit).select(*scope, "cell", "sid", *mine)
    open_ = open_.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    others = targets.select(*scope, "cell", *features, "val", F.pmod(F.xxhash64("sid"), F.lit(SALTS)).cast("int").alias("_salt"))
    distance = sum((_square(F.col(p) - F.col(f)) for p, f in zip(mine, features)), F.lit(0.0))
    checked = open_.join(others, [*scope, "cell", "_salt"]).filter(distance <= limit).select(*scope, "sid", "val")
    return sure.unionByName(checked).groupBy(*scope, "sid").agg(merge("val").alias("val"))


def core_sites(df: DataFrame, scope: Sequence[str], key: str, features: Sequence[str], eps: float, min_samples: int) -> DataFrame:
    """Distinct rows with their number, first key, cell and whether they are core."""
    space = _Space(scope, features, eps)
    sites = df.groupBy(*scope, *features).agg(F.count("*").alias("w"), F.min(key).alias("first"))
    sites = settle(number_rows(sites, scope, features, rn="sid").withColumn("cell", space.cell()))
    weights = sites.groupBy(*scope, "cell").agg(F.sum("w").alias("_rows"))
    sites = attach(sites, weights, [*scope, "cell"])
    thin = sites.filter(F.col("_rows") < min_samples)
    counts = _reach(space, thin, sites.withColumn("val", F.col("w")), F.sum)
    dense = sites.filter(F.col("_rows") >= min_samples).withColumn("core", F.lit(True))
    thin = thin.join(counts, [*scope, "sid"], "left").withColumn("core", F.col("val") >= min_samples).drop("val")
    return settle(dense.unionByName(thin).drop("_rows"))


def _links(space: _Space, core: DataFrame, labelled: DataFrame) -> DataFrame:
    """Pairs of components with core sites within eps of each other."""
    scope, limit = space.scope, F.lit(space.eps * space.eps)
    boxes = space.boxes(core, [*scope, "cell"]).join(labelled, [*scope, "cell"])
    keyed = boxes.withColumn("key", space.coarse(False))
    around = boxes.withColumn("key", space.coarse(True))
    mixed = around.groupBy(*scope, "key").agg(F.min("component").alias("_a"), F.max("component").alias("_b"))
    mixed = mixed.filter(F.col("_a") != F.col("_b")).select(*scope, "key")
    edges = [*space.low, *space.high]
    one = keyed.join(mixed, [*scope, "key"]).select(*scope, "key", F.col("cell").alias("ca"), F.col("component").alias("a"), *edges)
    two = around.join(mixed, [*scope, "key"]).select(
        *scope, "key", F.col("cell").alias("cb"), F.col("component").alias("b"), *[F.col(c).alias(f"r{c}") for c in edges]
    )
    left = list(zip(space.low, space.high))
    right = [(f"r{lo}", f"r{hi}") for lo, hi in left]
    least, most = space.bounds(left, right)
    pairs = one.join(two, [*scope, "key"]).filter(F.col("a") < F.col("b")).withColumns({"_least": least, "_most": most})
    # the box join is the expensive part and is read twice
    pairs = settle(pairs.filter(F.col("_least") <= limit).select(*scope, "a", "b", "ca", "cb", "_most"))
    found = pairs.filter(F.col("_most") <= limit).select("a", "b").distinct()
    open_ = pairs.filter(F.col("_most") > limit).select(*scope, "a", "b", "ca", "cb", F.col("ca").alias("pa"), F.col("cb").alias("pb"))
    open_ = settle(open_.join(found, ["a", "b"], "left_anti"))
    found, finer = settle(found), 1
    while not open_.isEmpty():
        parent, finer = finer, finer * FINER
        parts = core.withColumns({"_parent": space.cell(parent), "_part": space.cell(finer)})
        parts = space.boxes(parts, [*scope, "cell", "_parent", "_part"])
        mine = parts.select(*scope, F.col("cell").alias("ca"), F.col("_parent").alias("pa"), F.col("_part").alias("na"), *edges)
        theirs = parts.select(
            *scope, F.col("cell").alias("cb"), F.col("_parent").alias("pb"), F.col("_part").alias("nb"), *[F.col(c).alias(f"r{c}") for c in edges]
        )
        pairs = open_.join(mine, [*scope, "ca", "pa"]).join(theirs, [*scope, "cb", "pb"])
        pairs = pairs.withColumns({"_least": least, "_most": most}).filter(F.col("_least") <= limit)
        pairs = settle(pairs.select(*scope, "a", "b", "ca", "cb", "na", "nb", "_most"))
        new = pairs.filter(F.col("_most") <= limit).select("a", "b").distinct()
        found = settle(found.unionByName(new).distinct())
        rest = pairs.filter(F.col("_most") > limit).select(
            *scope, "a", "b", "ca", "cb", F.col("na").alias("pa"), F.col("nb").alias("pb")
        )
        open_ = settle(rest.join(found, ["a", "b"], "left_anti"))
    return found


def dbscan(
    df: DataFrame, scope: Sequence[str], key: str, features: Sequence[str], eps: float = 1.5, min_samples: int = 5
) -> DataFrame:
    """Rows with ``cluster`` (-1 is noise) and ``is_core``; a row counts among its own neighbours.

    Clusters are numbered by their first core row; border rows take the lowest
    cluster they touch.
    """
    scope, features = list(scope), list(features)
    space = _Space(scope, features, eps)
    sites = core_sites(df, scope, key, features, eps, min_samples)
    core = sites.filter("core")
    node = lambda grid, cell: F.struct(*scope, F.lit(grid).alias("grid"), cell.alias("cell"))
    edges = core.select(node(1, space.cell(shift=0.5)).alias("a"), node(0, F.col("cell")).alias("b")).distinct()
    parts = components(edges).filter("node.grid = 0")
    labelled = parts.select(*[F.col(f"node.{c}").alias(c) for c in scope], F.col("node.cell").alias("cell"), "component")
    links = _links(space, core, labelled)
    if not links.isEmpty():
        merged = components(links).select(F.col("node").alias("component"), F.col("component").alias("_to"))
        labelled = attach(labelled, merged, ["component"], how="left").select(
            *scope, "cell", F.coalesce("_to", "component").alias("component")
        )
    core = attach(core, labelled, [*scope, "cell"]).withColumn("_c", F.to_json("component"))
    firsts = core.groupBy(*scope, "_c").agg(F.min("first").alias("_first"))
    ranks = number_rows(firsts, scope, ["_first", "_c"], rn="_rank").select(*scope, "_c", (F.col("_rank") - 1).alias("cluster"))
    core = settle(attach(core, ranks, [*scope, "_c"]).select(*scope, "sid", "cell", *features, "cluster"))
    fringe = sites.filter("NOT core")
    border = _reach(space, fringe, core.withColumn("val", F.col("cluster")), F.min)
    outer = fringe.join(border, [*scope, "sid"], "left").select(
        *scope, *features, F.coalesce("val", F.lit(-1)).alias("cluster"), F.lit(False).alias("is_core")
    )
    labels = core.select(*scope, *features, "cluster", F.lit(True).alias("is_core")).unionByName(outer)
    return attach(df, labels, [*scope, *features])


def eps_neighbours(
    df: DataFrame, scope: Sequence[str], key: str, features: Sequence[str], eps: float = 1.5
) -> DataFrame:
    """Number of rows within eps of each row, itself included."""
    space = _Space(scope, features, eps)
    sites = df.groupBy(*scope, *features).agg(F.count("*").alias("w"))
    sites = settle(number_rows(sites, scope, features, rn="sid").withColumn("cell", space.cell()))
    counts = _reach(space, sites, sites.withColumn("val", F.col("w")), F.sum)
    per_site = sites.join(counts, [*scope, "sid"]).select(*scope, *features, F.col("val").alias("neighbours"))
    return attach(df, per_site, [*scope, *features])


def cluster_sizes(rows: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*scope, "cluster").agg(F.count("*").alias("n"))


def cluster_count(rows: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Clusters without noise, and noise rows."""
    found = F.when(F.col("cluster") >= 0, F.col("cluster"))
    return rows.groupBy(*scope).agg(
        F.count_distinct(found).alias("clusters"), F.count_if(F.col("cluster") < 0).alias("noise")
    )

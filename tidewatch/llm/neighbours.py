"""Near-duplicate vectors by NN-descent.

Equal vectors become one node. Random projection trees give every node a first
neighbour list; then neighbours of neighbours are compared and lists improve.
Edges of at least the threshold make components. A list whose every entry
reaches the threshold is saturated: it may lack links, to its own component and
to others. Nodes with such lists are compared with those of all other
components that the triangle inequality leaves within reach, and components
that a link joins become one. Each component is then compared in blocks, so the
counts of links in a dense cluster are exact however long the lists would be. A
bounded set of rows compared with all rows
audits the recall; while it is too low, further trees and rounds follow, and
if it stays too low, all nodes are compared as the saturated ones are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import vectors
from tidewatch.llm.components import components
from tidewatch.llm.tables import parts
from tidewatch.session import settle

LIST = 10
TREES = 6
LEAF = 128
ROUNDS = 2
BLOCK = 1024
CELLS = 2048
SAMPLE = 4096
AUDIT = 128
AUDIT_MOST = 8192
GROUP = 8192
RECALL = 0.97
ATTEMPTS = 4

_EDGES = "id bigint, other bigint, sim double"


class Tree:
    """Hyperplanes through a sample's medians: ``depth`` bits name a leaf."""

    def __init__(self, sample: np.ndarray, depth: int, rng: np.random.Generator):
        self.planes = rng.normal(size=(depth, sample.shape[1]))
        self.cuts = []
        code = np.zeros(len(sample), np.int64)
        for level in range(depth):
            at = sample @ self.planes[level]
            cut = np.full(1 << level, float(np.median(at)) if len(at) else 0.0)
            for c in np.unique(code):
                cut[c] = np.median(at[code == c])
            self.cuts.append(cut)
            code = code * 2 + (at > cut[code])

    def leaf(self, x: np.ndarray) -> np.ndarray:
        code = np.zeros(len(x), np.int64)
        for plane, cut in zip(self.planes, self.cuts):
            code = code * 2 + (x @ plane > cut[code])
        return code


def best_pairs(ids: np.ndarray, unit: np.ndarray, k: int, floor: np.ndarray | None = None):
    """``id, other, sim`` of the ``k`` most similar others of each row, those above its ``floor`` only."""
    if len(ids) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    sim = unit @ unit.T
    np.fill_diagonal(sim, -2)
    k = min(k, len(ids) - 1)
    top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    row = np.repeat(np.arange(len(ids)), k)
    col = top.ravel()
    value = sim[row, col]
    if floor is not None:
        better = value > floor[row]
        row, col, value = row[better], col[better], value[better]
    return ids[row], ids[col], value


def _depth(count: int) -> int:
    """Levels that a sample's medians cut: leaves of ``LEAF`` rows up to ten levels, then of at most ``GROUP``."""
    levels = [max(0, int(np.ceil(np.log2(max(1, count / rows))))) for rows in (LEAF, GROUP)]
    return max(min(levels[0], 10), levels[1])


def halves(unit: np.ndarray, most: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Row numbers of pieces of at most ``most`` rows: each half of a piece lies on one side of a hyperplane."""
    done, waiting = [], [np.arange(len(unit))]
    while waiting:
        rows = waiting.pop()
        if len(rows) <= most:
            done.append(rows)
            continue
        order = rows[np.argsort(unit[rows] @ rng.normal(size=unit.shape[1]), kind="stable")]
        waiting += [order[: len(order) // 2], order[len(order) // 2 :]]
    return done


def _from_trees(nodes: DataFrame, sample: np.ndarray, count: int, k: int, seed: int, trees: int) -> DataFrame:
    """Candidates from the leaves of some trees. A leaf is halved where it lies until its pieces are small.

    Only rows that no hyperplane of a sample tells apart outgrow a task's share; those are cut by hash.
    """
    rng = np.random.default_rng(seed)
    forest = [Tree(sample, _depth(count), rng) for _ in range(trees)]

    def place(batches):
        for batch in batches:
            x = vectors.unit(vectors.matrix(batch.column(1))) if len(batch) else np.zeros((0, 1))
            for t, tree in enumerate(forest):
                leaf = tree.leaf(x) if len(batch) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf * trees + t)], names=["id", "v", "leaf"])

    kind = nodes.schema["v"].dataType.simpleString()
    placed = nodes.select("id", "v").mapInArrow(place, f"id bigint, v {kind}, leaf bigint")
    sizes = settle(placed.groupBy("leaf").agg(F.ceil(F.count("*") / (8 * GROUP)).alias("n")))
    dealt = placed.join(sizes, "leaf").withColumn("piece", F.pmod(F.xxhash64(F.lit(seed), "leaf", "id"), F.col("n")))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids, unit = pdf["id"].to_numpy(), vectors.unit(vectors.stacked(pdf["v"]))
        pieces = halves(unit, 4 * LEAF, np.random.default_rng([seed, int(pdf["leaf"].iloc[0])]))
        a, b, s = (np.concatenate(x) for x in zip(*(best_pairs(ids[p], unit[p], k) for p in pieces)))
        return pd.DataFrame({"id": a, "other": b, "sim": s})

    return dealt.groupBy("leaf", "piece").applyInPandas(compare, _EDGES)


def _lists(candidates: DataFrame, k: int) -> DataFrame:
    """``id, near``: the ``k`` best distinct candidates of each id, best first."""
    entry = F.struct(F.col("sim"), F.col("other"))
    return candidates.groupBy("id").agg(F.slice(F.sort_array(F.collect_set(entry), asc=False), 1, k).alias("near"))


def _descend(nodes: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """Candidates among the neighbours, forward and backward, of every node."""
    forward = lists.select("id", F.explode("near").alias("n")).select("id", F.col("n.other").alias("other"), F.col("n.sim").alias("sim"))
    backward = _lists(forward.select(F.col("other").alias("id"), F.col("id").alias("other"), "sim"), k)
    backward = backward.select("id", F.explode("near").alias("n")).select("id", F.col("n.other").alias("other"))
    around = forward.select("id", "other").unionByName(backward).unionByName(nodes.select("id", F.col("id").alias("other"))).distinct()
    floor = lists.select(F.col("id").alias("other"), F.when(F.size("near") >= k, F.element_at("near", -1)["sim"]).otherwise(-2.0).alias("floor"))
    known = nodes.select(F.col("id").alias("other"), "v").join(floor, "other", "left")
    joined = around.join(known, "other").withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(16 * parts(nodes.sparkSession))))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(pdf["id"].to_numpy(), kind="stable")
        centre, other = pdf["id"].to_numpy()[order], pdf["other"].to_numpy()[order]
        unit, floors = vectors.unit(vectors.stacked(pdf["v"]))[order], pdf["floor"].fillna(-2.0).to_numpy()[order]
        cuts = np.append(np.append(0, np.flatnonzero(np.diff(centre)) + 1), len(centre))
        found = [best_pairs(other[a:b], unit[a:b], k, floors[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        a, b, s = (np.concatenate(x) for x in zip(*found))
        keep = np.unique(np.stack([a, b], 1), axis=0, return_index=True)[1] if len(a) else np.zeros(0, np.int64)
        return pd.DataFrame({"id": a[keep], "other": b[keep], "sim": s[keep]})

    return joined.groupBy("bucket").applyInPandas(compare, _EDGES)


def _across(nodes: DataFrame, threshold: float, seed: int) -> DataFrame:
    """``a, b``: components of ``id, v, component`` nodes with a link between them, compared exactly.

    Sampled nodes are pivots, and each node lies in the cell of its nearest. With
    angles as distance and ``reach`` the angle of the threshold, a partner's
    angle to its own pivot is at most ``reach`` more than to any pivot near the
    probe, so a probe meets it only in cells whose pivot is within twice ``reach``
    of the distance to the probe's own. Cells are cut into blocks, probes into
    slices; of two linked nodes the one of the lower cell is the probe.
    """
    cells = min(CELLS, max(1, -(-nodes.count() // BLOCK)))
    _, x = vectors.sample(nodes.select("id", "v"), cells, seed)
    pivots = vectors.unit(x) if len(x) else np.zeros((0, 1))
    reach = float(np.arccos(np.clip(threshold, -1, 1)))
    kind = nodes.schema["v"].dataType.simpleString()

    def place(batches):
        for batch in batches:
            if not len(batch):
                continue
            angle = np.arccos(np.clip(vectors.unit(vectors.matrix(batch.column(1))) @ pivots.T, -1, 1))
            home = angle.argmin(1)
            met = angle <= angle[np.arange(len(home)), home][:, None] + 2 * reach + 1e-6
            met &= np.arange(angle.shape[1]) >= home[:, None]
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(met.sum(1))), pa.int32()), pa.array(np.nonzero(met)[1], pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home, pa.int32()), lists], names=["id", "v", "component", "home", "met"])

    placed = settle(nodes.select("id", "v", "component").mapInArrow(place, f"id bigint, v {kind}, component bigint, home int, met array<int>"))
    held = placed.groupBy(F.col("home").alias("cell")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    held = settle(held)
    # a cell of the probe's own component has nothing to tell
    probes = placed.select("id", "component", F.explode("met").alias("cell")).join(held, "cell").filter("lo <> hi OR lo <> component")
    probes = settle(probes.select("id", "component", "cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block")))
    if probes.isEmpty():
        return probes.select(F.col("component").alias("a"), F.col("component").alias("b"))
    load = settle(probes.groupBy("cell", "block").agg(F.ceil(F.count("*") / (4 * BLOCK)).alias("slices")))
    rank = F.xxhash64(F.lit(seed), "id")
    keys = ["cell", "block", "slice"]
    sent = probes.join(load, ["cell", "block"]).withColumn("slice", F.pmod(rank, F.col("slices")))
    sent = sent.join(placed.select("id", "v"), "id").select(*keys, "component", "v")
    there = placed.join(held, F.col("home") == F.col("cell")).withColumn("block", F.pmod(rank, F.col("blocks"))).join(load, ["cell", "block"])
    there = there.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1))).select(*keys, "component", "v")

    def compare(xs: pd.DataFrame, ys: pd.DataFrame) -> pd.DataFrame:
        if not len(xs) or not len(ys):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        a, b = xs["component"].to_numpy(), ys["component"].to_numpy()
        near = vectors.unit(vectors.stacked(xs["v"])) @ vectors.unit(vectors.stacked(ys["v"])).T >= threshold
        row, col = np.nonzero(near & (a[:, None] != b[None, :]))
        return pd.DataFrame({"a": a[row], "b": b[col]}).drop_duplicates()

    sent, there = (df.select(*[F.col(c).alias(c) for c in df.columns]) for df in (sent, there))
    return sent.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInPandas(compare, "a bigint, b bigint").distinct()


def _merged(nodes: DataFrame, belongs: DataFrame, threshold: float, seed: int) -> DataFrame:
    """``belongs`` after components that a link between ``nodes`` joins have become one."""
    own = nodes.select("id", "v").join(belongs, "id", "left").withColumn("component", F.coalesce("component", "id"))
    links = settle(_across(own, threshold, seed))
    if links.isEmpty():
        return belongs
    label = components(links).select(F.col("id").alias("component"), F.col("component").alias("whole"))
    known = belongs.unionByName(own.select("id", "component")).distinct()
    return settle(known.join(label, "component", "left").select("id", F.coalesce("whole", "component").alias("component")))


def _saturated(lists: DataFrame, k: int, threshold: float) -> DataFrame:
    """Ids whose list is full of links: it may lack some."""
    return lists.filter((F.size("near") >= k) & (F.element_at("near", -1)["sim"] >= threshold)).select("id")


def _counts(nodes: DataFrame, belongs: DataFrame, threshold: float) -> DataFrame:
    """``id, links``: vectors (copies counted) of the same component at ``threshold`` or nearer.

    A component of more than ``BLOCK`` nodes is cut into blocks and each pair of
    blocks is a group; smaller ones share groups.
    """
    sizes = settle(belongs.groupBy("component").agg(F.count("*").alias("size")))
    small = sizes.filter(F.col("size") <= BLOCK).agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-small // BLOCK))
    rows = nodes.join(belongs, "id").join(sizes, "component").withColumn("n", F.when(F.col("size") > BLOCK, F.ceil(F.col("size") / BLOCK)).otherwise(0))
    own = F.pmod(F.xxhash64("id"), F.greatest(F.col("n"), F.lit(1)))
    rows = rows.withColumn("own", own).withColumn("partner", F.explode(F.when(F.col("n") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).otherwise(F.array(F.lit(0).cast("bigint")))))
    group = F.when(F.col("n") > 0, F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(buckets)))
    base = rows.select((F.col("n") > 0).alias("large"), group.alias("g"), "component", "own", "partner", "id", "v", "mult")
    left = base.filter("own <= partner").withColumns({"i": F.col("own"), "j": F.col("partner"), "side": F.lit(0)})
    right = base.filter("own > partner").withColumns({"i": F.col("partner"), "j": F.col("own"), "side": F.lit(1)})
    both = left.unionByName(right)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, c in pdf.groupby("component", sort=False):
            unit, mult, ids = vectors.unit(vectors.stacked(c["v"])), c["mult"].to_numpy(), c["id"].to_numpy()
            side = c["side"].to_numpy()
            if (side == 0).all():
                near = unit @ unit.T >= threshold
                np.fill_diagonal(near, False)
                out.append(pd.DataFrame({"id": ids, "links": near @ mult}))
            else:
                a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                near = unit[a] @ unit[b].T >= threshold
                out += [pd.DataFrame({"id": ids[a], "links": near @ mult[b]}), pd.DataFrame({"id": ids[b], "links": near.T @ mult[a]})]
        return pd.concat(out, ignore_index=True)

    return both.groupBy("large", "g", "i", "j").applyInPandas(compare, "id bigint, links bigint").groupBy("id").agg(F.sum("links").alias("links"))


def _audited(nodes: DataFrame, links: DataFrame, threshold: float, seed: int) -> float | None:
    """Mean share of its links that a node has in ``links``, over sampled nodes with any, compared with all rows.

    The sample grows until ``AUDIT`` / 4 of it have links or it holds all nodes;
    None if ``AUDIT_MOST`` are too few for that.
    """
    most = AUDIT
    while True:
        ids, x = vectors.sample(nodes.select("id", "v"), most, seed)
        unit = vectors.unit(x)

        def compare(batches):
            total = np.zeros(len(ids), np.int64)
            for batch in batches:
                if len(batch):
                    near = vectors.unit(vectors.matrix(batch.column(1))) @ unit.T >= threshold
                    near &= batch.column(0).to_numpy()[:, None] != ids[None, :]
                    total += batch.column(2).to_numpy() @ near
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["id", "true"])

        true = nodes.select("id", "v", "mult").mapInArrow(compare, "id bigint, true bigint").groupBy("id").agg(F.sum("true").alias("true"))
        share = F.least(F.coalesce("links", F.lit(0)) / F.col("true"), F.lit(1.0))
        linked, recall = true.filter(F.col("true") > 0).join(links, "id", "left").agg(F.count("*"), F.avg(share)).first()
        if len(ids) < most or 4 * linked >= AUDIT:
            return 1.0 if recall is None else float(recall)
        if most >= AUDIT_MOST:
            return None
        most = min(8 * most, AUDIT_MOST)


def graph(nodes: DataFrame, threshold: float, k: int = LIST, seed: int = 6) -> tuple[DataFrame, DataFrame]:
    """``belongs`` (``id, component``) and ``links`` (``id, links``) of ``id, v, mult`` nodes."""
    count = nodes.count()
    # four rows or more for every cut of the lowest level
    _, x = vectors.sample(nodes.select("id", "v"), max(SAMPLE, 4 << _depth(count)), seed)
    sample = vectors.unit(x) if len(x) else np.zeros((0, 1))
    lists = known = None
    for attempt in range(ATTEMPTS):
        fresh = _from_trees(nodes, sample, count, k, seed + attempt, TREES)
        if lists is not None:
            fresh = fresh.unionByName(_entries(lists))
        lists = settle(_lists(fresh, k))
        for _ in range(ROUNDS):
            lists = settle(_lists(_descend(nodes, lists, k).unionByName(_entries(lists)), k))
        near = _entries(lists).filter(F.col("sim") >= threshold).select(F.col("id").alias("a"), F.col("other").alias("b"))
        # of a link between two components that both lists lack, both ends are saturated
        full = nodes.join(_saturated(lists, k, threshold), "id", "left_semi")
        belongs = _merged(full, components(near), threshold, seed)
        links = settle(_counts(nodes, belongs, threshold))
        recall = _audited(nodes, links, threshold, seed)
        if recall is not None and recall >= RECALL:
            return belongs, links
        # too few links for an audit: fresh trees that find no new one stand for it
        found = links.agg(F.sum("links")).first()[0] or 0
        if recall is None and found == known:
            return belongs, links
        known = found
    belongs = _merged(nodes, belongs, threshold, seed)
    return belongs, settle(_counts(nodes, belongs, threshold))


def _entries(lists: DataFrame) -> DataFrame:
    return lists.select("id", F.explode("near").alias("n")).select("id", F.col("n.other").alias("other"), F.col("n.sim").alias("sim"))


def near_duplicates(table: DataFrame, threshold: float = 0.9, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``table``.

    Rows that are no vectors have no links and are their own component. Equal
    vectors (up to length too, once normalised by their own values) are linked
    with each other. A null id has a null component and is kept; such rows take
    no part. Rows that share an id are judged each by its own vector.
    """
    rows = vectors.valid(table, key, vector)
    # a node is a distinct vector under a number of its own, written once: ids may repeat
    classes = rows.groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("mult"))
    classes = settle(classes.withColumn("id", F.monotonically_increasing_id()))
    if classes.isEmpty():
        lone = classes.select("v", F.lit(0).cast("bigint").alias("links"), F.col("least").alias("component"))
    else:
        belongs, links = graph(classes.select("id", "v", "mult"), threshold)
        named = classes.join(belongs, "id", "left").withColumn("component", F.coalesce("component", "id"))
        lowest = named.groupBy("component").agg(F.min("least").alias("lowest"))
        named = named.join(links, "id", "left").join(lowest, "component")
        lone = named.select("v", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("links"), F.col("lowest").alias("component"))
    taking = F.col(key).isNotNull() & vectors.proper(F.col(vector))
    every = table.select(F.col(key).cast("bigint").alias("vec_id"), F.when(taking, F.col(vector)).alias("_v"))
    found = every.join(lone, F.col("_v") == F.col("v"), "left")
    component = F.coalesce("component", "vec_id")
    return found.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
